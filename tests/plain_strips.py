"""Plain array code that plans over pixels are held against: contrast, two colours, long lines, outer space and crops."""

from __future__ import annotations

import numpy as np

from tests.plain_kernels import components, otsu


def equalised(img: np.ndarray, tiles: int = 8, clip: float = 2.0) -> np.ndarray:
    """Contrast-limited adaptive equalisation (Zuiderveld, 1994): each pixel by the four nearest tiles' clipped distributions.

    The picture is mirrored up to whole tiles; an empty one is returned as it is.
    """
    h, w = img.shape
    if not img.size:
        return img
    th, tw = -(-h // tiles), -(-w // tiles)
    whole = np.pad(img, ((0, th * tiles - h), (0, tw * tiles - w)), mode="symmetric")
    tile = (np.arange(th * tiles) // th)[:, None] * tiles + np.arange(tw * tiles) // tw
    counts = np.bincount((tile * 256 + whole).ravel(), minlength=tiles * tiles * 256).reshape(-1, 256).astype(float)
    most = max(int(clip * th * tw / 256), 1)
    over = np.maximum(counts - most, 0).sum(axis=1, keepdims=True)
    shade = np.minimum(np.rint((np.minimum(counts, most) + over / 256).cumsum(axis=1) * 255 / (th * tw)), 255).reshape(tiles, tiles, 256)

    def between(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The two tiles around each place, by their middles, and the share of the second."""
        at = (np.arange(n) + 0.5) / size - 0.5
        first = np.floor(at).astype(int)
        return np.clip(first, 0, tiles - 1), np.clip(first + 1, 0, tiles - 1), at - first

    (y0, y1, fy), (x0, x1, fx) = between(h, th), between(w, tw)
    fy = fy[:, None]
    upper = shade[y0[:, None], x0, img] * (1 - fx) + shade[y0[:, None], x1, img] * fx
    lower = shade[y1[:, None], x0, img] * (1 - fx) + shade[y1[:, None], x1, img] * fx
    return np.rint(upper * (1 - fy) + lower * fy).astype(np.uint8)


def binarised(img: np.ndarray, share: float = 0.75, least_area: int = 6, least_height: int = 3) -> tuple[np.ndarray, float]:
    """0 and 255 by a share of the best level of the equalised picture, without specks, gaps of one row closed; and the level."""
    even = equalised(img)
    level = share * otsu(even) if img.size else 0.0
    labels, count = components(even > level)
    area = np.bincount(labels.ravel(), minlength=count + 1)
    rows, _ = np.nonzero(labels)
    own = labels[labels > 0]
    top, bottom = np.full(count + 1, img.shape[0]), np.full(count + 1, -1)
    np.minimum.at(top, own, rows)
    np.maximum.at(bottom, own, rows)
    ok = (area >= least_area) & (bottom - top + 1 >= least_height)
    ok[0] = False
    kept = ok[labels]
    kept[1:-1] |= kept[:-2] & kept[2:]
    return kept.astype(np.uint8) * 255, level


def long_rows(mask: np.ndarray, share: float = 0.03, gap: int = 2, margin: int = 5, merge: int = 4) -> list[int]:
    """Rows with a straight horizontal edge of at least a share of the width (15 pixels at least), near ones merged.

    An edge is where a pixel differs from the one above; runs with short gaps stand in for a line transform.
    """
    h, w = mask.shape
    least, found = max(15, int(w * share)), []
    edges = np.diff((mask > 0).astype(np.int8), axis=0) != 0
    for y in range(max(margin, 1), h - margin):
        x = np.flatnonzero(edges[y - 1])
        if len(x) >= least // 2:
            run = np.split(x, np.flatnonzero(np.diff(x) > gap + 1) + 1)
            if max(int(r[-1] - r[0]) + 1 for r in run) >= least:
                found.append(y)
    groups: list[list[int]] = []
    for y in found:
        if groups and y - groups[-1][-1] <= merge:
            groups[-1].append(y)
        else:
            groups.append([y])
    return [round(float(np.mean(g))) for g in groups]


def blanked_outside(img: np.ndarray, rows: list[int], padding: int = 4, split: int | None = None, value: int = 0) -> np.ndarray:
    """The picture with everything above edges of its upper half and below edges of its lower half blank, and the edges too."""
    out = img.copy()
    split = img.shape[0] // 2 if split is None else split
    for row in rows:
        if row < split:
            out[: row + padding + 1] = value
        else:
            out[max(0, row - padding) :] = value
    return out


def bottom(img: np.ndarray, rows: int = 100) -> np.ndarray | None:
    """The last rows of a picture; None if it has fewer."""
    return img[-rows:] if rows > 0 and img.shape[0] >= rows else None


def black_edges(img: np.ndarray, rows: int = 10) -> np.ndarray:
    out = img.copy()
    out[:rows] = 0
    out[max(0, img.shape[0] - rows) :] = 0
    return out


def prepared(img: np.ndarray, strip: int = 100) -> tuple[np.ndarray | None, dict]:
    """The strip of text in two colours, and what was done: status, level, edge_rows, share of foreground."""
    own = bottom(img, strip)
    if own is None:
        return None, {"status": "too short", "level": None, "edge_rows": [], "share": None}
    two, level = binarised(own)
    rows = long_rows(two)
    out = blanked_outside(two, rows)
    return out, {"status": "empty" if not out.any() else "ok", "level": level, "edge_rows": rows, "share": float((out > 0).mean())}
