"""Plain array code on single pictures, which plans over pixels are held against."""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view


def unit_range(x: np.ndarray) -> np.ndarray:
    low, high = float(x.min()), float(x.max())
    return np.zeros(x.shape) if high == low else (x - low) / (high - low)


def bright_limits(img: np.ndarray, axis: int, start: int = 15) -> tuple[int, int] | None:
    """First and last column (axis 0) or row (axis 1) brighter than average, columns only beyond ``start``."""
    if img.size == 0 or img.max() == 0:
        return None
    mean = img.mean(axis=axis)
    level = (mean - mean.min()) / mean.max()
    above = np.flatnonzero(level > level.mean())
    if axis == 0:
        above = above[above > start]
    return (int(above[0]), int(above[-1])) if len(above) else None


def picture_area(img: np.ndarray) -> tuple[int, int, int, int] | None:
    """left, right, top, bottom of the exposed picture."""
    columns, rows = bright_limits(img, 0), bright_limits(img, 1)
    if columns is None or rows is None or columns[0] >= columns[1] or rows[0] >= rows[1]:
        return None
    return columns[0], columns[1], rows[0], rows[1]


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected labels from 1, by runs of rows and union-find."""
    labels, up, prev, count = np.zeros(mask.shape, np.int32), [0], [], 0

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for y, row in enumerate(mask.astype(bool)):
        edge = np.flatnonzero(np.diff(row.astype(np.int8), prepend=0, append=0))
        runs, j = [], 0
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            mine = 0
            while j < len(prev) and prev[j][1] < a:
                j += 1
            k = j
            while k < len(prev) and prev[k][0] <= b:
                other = top(prev[k][2])
                if mine and other != mine:
                    up[max(mine, other)] = min(mine, other)
                    mine = min(mine, other)
                else:
                    mine = other
                k += 1
            if not mine:
                count += 1
                up.append(count)
                mine = count
            labels[y, a:b] = mine
            runs.append((a, b, mine))
        prev = runs
    roots = np.array([top(i) for i in range(count + 1)])
    _, compact = np.unique(roots, return_inverse=True)
    return compact[labels].astype(np.int32), int(compact.max())


def kept_by_size(labels: np.ndarray, count: int, low: int = 50, high: int = 1000) -> np.ndarray:
    """Labels of parts with more than low and fewer than high pixels; the others become 0."""
    size = np.bincount(labels.ravel(), minlength=count + 1)
    ok = (size > low) & (size < high)
    ok[0] = False
    return np.where(ok[labels], labels, 0)


def centroids(mask: np.ndarray, low: int = 50, high: int = 1000) -> tuple[list[tuple[int, int]], float | None]:
    """(x, y) of the kept parts, halves to even, and the median of their areas."""
    labels, count = components(mask)
    labels = kept_by_size(labels, count, low, high)
    own = np.unique(labels[labels > 0])
    if not len(own):
        return [], None
    y, x = np.nonzero(labels)
    k = labels[y, x]
    n = np.bincount(k)
    cx, cy = np.bincount(k, weights=x)[own] / n[own], np.bincount(k, weights=y)[own] / n[own]
    return [(int(round(a)), int(round(b))) for a, b in zip(cx.tolist(), cy.tolist(), strict=True)], float(np.median(n[own]))


def is_dot(mask: np.ndarray, limit: float = 120.0) -> bool | None:
    """Whether marks are dots instead of digits."""
    _, area = centroids(mask)
    return None if area is None else area < limit


def median_blur(img: np.ndarray, k: int = 5) -> np.ndarray:
    r = k // 2
    windows = sliding_window_view(np.pad(img, r, mode="edge"), (k, k))
    return np.median(windows.reshape(*img.shape, k * k), axis=2).astype(img.dtype)


def eroded(img: np.ndarray, k: int = 3) -> np.ndarray:
    return sliding_window_view(np.pad(img, k // 2, constant_values=255), (k, k)).min(axis=(2, 3))


def dilated(img: np.ndarray, k: int = 3) -> np.ndarray:
    return sliding_window_view(np.pad(img, k // 2, constant_values=0), (k, k)).max(axis=(2, 3))


def cleaned_marks(img: np.ndarray) -> np.ndarray:
    return (dilated(eroded(median_blur(img, 5))) > 127).astype(np.uint8) * 255


def peaks(x: np.ndarray, distance: int = 1, prominence: float = 0.0) -> np.ndarray:
    """Middles of local maxima, thinned by distance (the higher stays), with at least a prominence."""
    x = np.asarray(x, dtype=float)
    if len(x) < 3:
        return np.zeros(0, dtype=int)
    found, i = [], 1
    while i < len(x) - 1:
        if x[i - 1] < x[i]:
            j = i
            while j < len(x) - 1 and x[j + 1] == x[i]:
                j += 1
            if j < len(x) - 1 and x[j + 1] < x[i]:
                found.append((i + j) // 2)
            i = j + 1
        else:
            i += 1
    p = np.array(found, dtype=int)
    keep = np.ones(len(p), dtype=bool)
    for k in np.argsort(x[p], kind="stable")[::-1]:
        if keep[k]:
            keep[(np.abs(p - p[k]) < distance) & (np.arange(len(p)) != k)] = False
    p = p[keep]

    def base(k: int, step: int) -> float:
        low, i = x[k], k
        while 0 <= i < len(x) and x[i] <= x[k]:
            low = min(low, x[i])
            i += step
        return low

    return np.array([k for k in p if x[k] - max(base(k, -1), base(k, 1)) >= prominence], dtype=int)


def exactly(x: np.ndarray, wanted: int, distance: int = 30, prominence: float = 0.1, step: float = 0.01, tries: int = 1000) -> np.ndarray:
    """Peaks at the prominence, moved in steps, that gives the wanted number; the last ones if none does."""
    found = peaks(x, distance, prominence)
    for _ in range(tries):
        if len(found) == wanted:
            break
        prominence += step if len(found) > wanted else -step
        if prominence <= 0:
            break
        found = peaks(x, distance, prominence)
    return found


def grid_peaks(stack: np.ndarray, axis: int, distance: int = 5, prominence: float = 0.1) -> np.ndarray:
    """Dark grid lines of a stacked picture: peaks of the inverted median along an axis."""
    return peaks(1 - unit_range(np.median(stack, axis=axis)), distance, prominence)


def stacked(images: list[np.ndarray], pad: int = 1) -> np.ndarray:
    """Sum of equally weighted images, padded to the largest and cut to the median size."""
    h, w = max(i.shape[0] for i in images), max(i.shape[1] for i in images)
    total = np.zeros((h, w))
    for i in images:
        total += np.pad(i.astype(float), ((0, h - i.shape[0]), (0, w - i.shape[1])), constant_values=pad)
    return (len(images) * total)[: int(np.median([i.shape[0] for i in images])), : int(np.median([i.shape[1] for i in images]))]


def histogram_peaks(values: np.ndarray, bins: int = 500, distance: int = 30, prominence: float = 0.2, sigmas: float = 3.0) -> np.ndarray:
    """Places where coordinates gather: peaks of the scaled histogram of values near their mean."""
    v = np.asarray(values, dtype=float)
    if not len(v):
        return v
    v = v[np.abs(v - v.mean()) <= sigmas * v.std()]
    counts, edges = np.histogram(v, bins)
    return edges[peaks(unit_range(counts.astype(float)), distance, prominence)]


def group_limits(img: np.ndarray, axis: int, width: int = 10, cut: int = 20) -> tuple[int, int] | None:
    """First and last group of columns or rows that holds anything, as pixels."""
    sums = img.astype(float).sum(axis=axis)[:-cut]
    sums = sums[: len(sums) // width * width].reshape(-1, width).sum(axis=1)
    on = np.flatnonzero(unit_range(sums) > 0) if len(sums) else []
    return (int(on[0]) * width, (int(on[-1]) + 1) * width) if len(on) else None


def integral(img: np.ndarray) -> np.ndarray:
    return np.pad(img.astype(float).cumsum(0).cumsum(1), ((1, 0), (1, 0)))


def best_window(img: np.ndarray, height: int = 100, width: int = 700, step: int = 10) -> tuple[int, int, int, int]:
    """top, left, height and width of the window with the greatest mean; smaller images shrink it."""
    height, width = min(height, img.shape[0]), min(width, img.shape[1])
    s = integral(img)
    tops, lefts = np.arange(0, img.shape[0] - height + 1, step), np.arange(0, img.shape[1] - width + 1, step)
    mean = s[tops[:, None] + height, lefts + width] - s[tops[:, None], lefts + width] - s[tops[:, None] + height, lefts] + s[tops[:, None], lefts]
    i, j = np.unravel_index(int(mean.argmax()), mean.shape)
    return int(tops[i]), int(lefts[j]), height, width


def trimmed_left(img: np.ndarray, widest: int = 300, step: int = 10) -> tuple[int, int] | None:
    """Rows that hold the marks at the left side; faint sums are dropped until the span is narrow enough."""
    offset = 0
    sums = unit_range(img.astype(float).sum(axis=1))
    while offset < 100:
        on = np.flatnonzero(sums > offset / 100)
        if not len(on):
            return None
        if on[-1] - on[0] <= widest:
            return int(on[0]), int(on[-1])
        offset += step
    return None


def without_lines(img: np.ndarray, rows: list[int], columns: list[int], thickness: int = 5) -> np.ndarray:
    out, r = img.copy(), thickness // 2
    for y in rows:
        out[max(0, y - r) : y + r + 1] = 0
    for x in columns:
        out[:, max(0, x - r) : x + r + 1] = 0
    return out


def dense_parts(mask: np.ndarray, size: int = 100, step: int = 25, times: float = 2.0) -> np.ndarray:
    """The mask inside windows that are denser than some times the whole."""
    out, whole = np.zeros_like(mask), mask.mean()
    for y in range(0, max(1, mask.shape[0] - size + 1), step):
        for x in range(0, max(1, mask.shape[1] - size + 1), step):
            box = mask[y : y + size, x : x + size]
            if box.mean() > times * whole:
                out[y : y + size, x : x + size] = box
    return out


def trace(img: np.ndarray, rows: list[int], columns: list[int], level: int = 200) -> np.ndarray:
    """(x, y) of the echo trace: dark pixels of the blurred picture away from grid lines, in dense parts."""
    dark = without_lines(255 - median_blur(img, 5), rows, columns)
    y, x = np.nonzero(dense_parts((dark > level).astype(np.uint8)))
    return np.column_stack([x, y])


def otsu(img: np.ndarray) -> int:
    """The level that parts dark and bright pixels best."""
    p = np.bincount(img.ravel(), minlength=256) / img.size
    w, m = p.cumsum(), (p * np.arange(256)).cumsum()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.nan_to_num((m[-1] * w - m) ** 2 / (w * (1 - w)))
    return int(between.argmax())


def foreground(img: np.ndarray) -> np.ndarray | None:
    """The rarer colour of a strictly two-coloured image, black on a tie; None for any other image."""
    colours = np.unique(img)
    if not set(colours.tolist()) <= {0, 255}:
        return None
    return img == (255 if (img == 255).sum() < (img == 0).sum() else 0)


def overexposed_share(img: np.ndarray, low: int = 230) -> float:
    """Share of pixels from low on without the brightest level."""
    return float(np.bincount(img.ravel(), minlength=256)[low:255].sum() / img.size)


def noise(img: np.ndarray) -> dict[str, float]:
    """Spread against the median picture (with wrap-around) and the fast Laplacian estimate of noise."""
    h, w = img.shape
    k = sliding_window_view(img.astype(float), (3, 3))
    lap = (k * np.array([[1, -2, 1], [-2, 4, -2], [1, -2, 1]])).sum(axis=(2, 3))
    return {"spread": float((img - median_blur(img, 3)).std()), "laplacian": float(np.sqrt(np.pi / 2) * np.abs(lap).sum() / (6 * (w - 2) * (h - 2)))}


def suppressed(boxes: np.ndarray, scores: np.ndarray, limit: float = 0.5) -> list[int]:
    """Boxes (x1, y1, x2, y2) that stay: from the best on, those that overlap no kept one by the limit or more."""
    order, kept = np.lexsort((np.arange(len(scores)), -scores)), []
    for i in order:
        a = boxes[i]
        for j in kept:
            b = boxes[j]
            both = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
            union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
            if union > 0 and both / union >= limit:
                break
        else:
            kept.append(int(i))
    return kept


def polynomial_fit(x: np.ndarray, y: np.ndarray, highest: int = 9) -> tuple[int, list[float], float]:
    """Degree, coefficients and residual of the best polynomial up to a degree."""
    best = (0, [float(np.mean(y))], float(((y - np.mean(y)) ** 2).sum()))
    for d in range(1, min(highest, len(x) - 1) + 1):
        c = np.polyfit(x, y, d)
        r = float(((np.polyval(c, x) - y) ** 2).sum())
        if r < best[2]:
            best = (d, c.tolist(), r)
    return best


def two_layers(y: np.ndarray, mads: float = 10.0) -> tuple[np.ndarray, int]:
    """Values within some deviations of the median, sorted, and where to split them for the least spread."""
    m = np.median(y)
    mad = np.median(np.abs(y - m))
    kept = np.sort(y[np.abs(y - m) <= mads * mad]) if mad > 0 else np.sort(y)
    cost = [kept[:i].std() + kept[i:].std() for i in range(1, len(kept))]
    return kept, int(np.argmin(cost)) + 1 if cost else len(kept)


def resampled(x: np.ndarray, y: np.ndarray, low: float = 0.0, high: float = 14.0, step: float = 0.01) -> np.ndarray:
    """(x, y) at the x nearest to each place of a grid, each once."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    grid = np.arange(low, high + step / 2, step)
    right = np.clip(np.searchsorted(x, grid), 1, len(x) - 1) if len(x) > 1 else np.zeros(len(grid), int)
    near = np.where(np.abs(x[right - 1] - grid) <= np.abs(x[right] - grid), right - 1, right) if len(x) > 1 else right
    return np.column_stack([x, y])[np.unique(near)]


def grey(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """uint8 picture of Spark's image source (blue, green, red order), by luma."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return a[:, :, 0]
    return np.round(a[:, :, :3].astype(float) @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)
