"""A bitmap of fixed size for sets of 64-bit hashes: membership may be wrongly affirmed, never wrongly denied."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import U64

#: bits of a bitmap, as a power of two: 8 MB
BITS = 26


def bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> dict[int, bytes]:
    """Blocks of 32,768 bits, numbered from 1, with the bits of a long column's hashes: at most 2^bits / 8 bytes, whatever their number."""
    place = F.shiftrightunsigned(column, 64 - bits) + 1
    blocks = hashes.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    return {r.block: bytes(r.bits) for r in blocks.collect()}


def flat(blocks: dict[int, bytes], bits: int = BITS) -> np.ndarray:
    out = np.zeros(max(1 << bits >> 3, 4096), np.uint8)
    for block, raw in blocks.items():
        out[(block - 1) * 4096 : block * 4096] = np.frombuffer(raw, np.uint8)
    return out


def maybe(flat_bits: np.ndarray, h: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whether hashes may be in the set."""
    place = (h >> U64(64 - bits)).astype(np.int64)
    return (flat_bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
