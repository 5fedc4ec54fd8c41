"""Vectorised word splitting and hashing: words are runs of bytes outside 0x20 and 0x09-0x0D."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 22
_SHINGLE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
_MASK = (1 << 64) - 1
#: bytes of a block and where its words begin and end, to the same of their parts
Refine = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n + 1, _BLOCK // 4)
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers[:] = both
    return _powers[0], _powers[1]


def _block_words(raw: bytes, refine: Refine | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and ends of the words of one block, or of the parts that refine cuts them into."""
    buf = np.frombuffer(raw, dtype=np.uint8)
    if not len(buf):
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[buf]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    if refine:
        start, end = refine(buf, start, end)
    power, inverse = _power_tables(len(buf))
    total = np.empty(len(buf) + 1, dtype=U64)
    total[0] = 0
    np.cumsum(_BYTE[buf] * power[: len(buf)], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    return mix(h + (end - start).astype(U64) * U64(_SHINGLE[0])), start, end


def word_spans(whole: bytes, refine: Refine | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a text, and where each begins and ends.

    Works through blocks of a few MB, so that memory follows the number of words; a block ends
    at white space and a longer word gets a longer block.
    """
    parts, at = [], 0
    while at < len(whole):
        to = min(len(whole), at + _BLOCK // 4)
        if to < len(whole):
            cut = whole.rfind(b"\n", at, to)
            cut = cut if cut > at else whole.rfind(b" ", at, to)
            if cut > at:
                to = cut + 1
            else:
                ends = [e for e in (whole.find(c, to) for c in (b" ", b"\n")) if e >= 0]
                to = min(ends) + 1 if ends else len(whole)
        h, s, e = _block_words(whole[at:to], refine)
        parts.append((h, s + at, e + at))
        at = to
    h, s, e = zip(*parts) if parts else ((np.zeros(0, U64),), (np.zeros(0, np.int64),), (np.zeros(0, np.int64),))
    return np.concatenate(h), np.concatenate(s), np.concatenate(e)


def window_hashes(buf: np.ndarray, width: int) -> np.ndarray:
    """A rolling hash of the width bytes before each place of a block of bytes, of fewer at its begin."""
    power, inverse = _power_tables(len(buf))
    total = np.empty(len(buf) + 1, dtype=U64)
    total[0] = 0
    np.cumsum(_BYTE[buf] * power[: len(buf)], out=total[1:])
    low = np.maximum(np.arange(len(buf)) - width, 0)
    return mix((total[:-1] - total[low]) * inverse[low])


def joined(raws: list[bytes]) -> tuple[bytes, np.ndarray]:
    """All texts with a line end after each, and where each begins (one more entry than texts)."""
    begins = np.zeros(len(raws) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raws], out=begins[1:])
    return b"\n".join([*raws, b""]), begins


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit word hashes of all texts, and where each text's words begin (one more entry than texts)."""
    whole, begins = joined([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    h, s, _ = word_spans(whole.lower() if lower else whole)
    return h, np.searchsorted(s, begins)


def shingle_hashes(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of all k-word windows of one text; of the whole sequence if it is shorter; none without words."""
    n = len(words)
    if not n:
        return words
    width = min(n, k)
    out = np.zeros(n - width + 1, dtype=U64)
    for j in range(width):
        c = _SHINGLE[j] if j < len(_SHINGLE) else ((_SHINGLE[j % 5] * (2 * j + 1)) & _MASK)
        out += words[j : n - width + 1 + j] * U64(c)
    return mix(out + U64(width))


def shingle_sets(texts: list[str | None], k: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted."""
    h, at = word_hashes(texts)
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield np.unique(shingle_hashes(h[a:b], k))


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def sized(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about limit bytes of a text column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(column)
        lengths = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        part = (np.cumsum(lengths) - lengths) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)
