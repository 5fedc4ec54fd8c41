"""Product quantisation of vectors in whole numbers: weighted Lloyd rounds over the distinct parts of each position.

Vectors become whole numbers, are cut into equal parts, and equal parts of a position are counted.  Rounds of Lloyd's
method run over those distinct parts with their counts as weights; at last codes and errors are joined
back to the vectors.  All arithmetic is exact, whatever the size of the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .skew import join_distinct

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: parts and labels with more than one row in so many are joined by broadcast: at most that many for each position
SHARE = 1024
#: components within this bound have squared distances that doubles hold exactly
_SMALL = 1 << 20
_LIMB = 30
_LONG = (1 << 63) - 1


def kept_vectors(vectors: DataFrame, vector: str, parts: int, scale: int) -> DataFrame:
    """Rows of finite vectors whose length is a multiple of parts, with components floor(scale * x) as doubles, which hold them exactly."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda c: F.lit(float(scale)) * c)
    whole = vectors.withColumn("scaled", x).where(F.col("scaled").isNotNull() & (F.size("scaled") > 0) & (F.size("scaled") % parts == 0))
    finite = whole.where(F.forall("scaled", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    # whole doubles beyond 2^52 are their own floor; adding zero turns -0 to 0
    floors = F.transform("scaled", lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c).cast("double")).otherwise(c) + F.lit(0.0))
    return finite.withColumn("scaled", floors)


def _packed(values: np.ndarray) -> list[bytes]:
    """Each row's whole numbers as bytes, in the narrowest of three widths that holds them all, so equal rows have equal bytes."""
    top = np.abs(values).max(axis=1)
    narrow, wide = values[top < 1 << 15].astype("<i2").tobytes(), values[top >= 1 << 31].astype("<f8").tobytes()
    middle = values[(top >= 1 << 15) & (top < 1 << 31)].astype("<i4").tobytes()
    sources, size, at, out = (narrow, middle, wide), values.shape[1], [0, 0, 0], []
    for kind in ((top >= 1 << 15).astype(int) + (top >= 1 << 31)).tolist():
        step = size * (2, 4, 8)[kind]
        out.append(sources[kind][at[kind] : at[kind] + step])
        at[kind] += step
    return out


def _unpacked(raws: list[bytes], size: int) -> np.ndarray:
    """Rows of whole numbers as doubles."""
    out = np.empty((len(raws), size))
    width = np.array([len(r) // size for r in raws])
    for w, kind in ((2, "<i2"), (4, "<i4"), (8, "<f8")):
        rows = np.flatnonzero(width == w)
        if len(rows):
            out[rows] = np.frombuffer(b"".join(raws[i] for i in rows.tolist()), kind).reshape(-1, size)
    return out


def _cut(parts: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("scaled").flatten().to_numpy().reshape(batch.num_rows, -1)
            raws = _packed(values.reshape(batch.num_rows * parts, -1))
            row = np.repeat(batch.column("row").to_numpy(), parts)
            place = np.tile(np.arange(parts, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(place), pa.array(raws, pa.binary())], ["row", "place", "part"])

    return run


def nearest_entries(values: np.ndarray, book: list[tuple[int, ...]]) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """For each row the nearest entry, the first of equally near ones, and the squared distance."""
    entries = np.array(book, dtype=float)
    if max(np.abs(values).max(initial=0), np.abs(entries).max(initial=0)) <= _SMALL and values.shape[1] <= 1 << 10 and all(abs(x) <= _SMALL for e in book for x in e):
        far = np.zeros((len(values), len(book)))
        for j in range(values.shape[1]):
            far += (values[:, j, None] - entries[None, :, j]) ** 2
        code = far.argmin(axis=1)
        return code, far[np.arange(len(values)), code].astype(np.int64)
    code, error = np.zeros(len(values), np.int64), []
    for i, row in enumerate(values):
        exact = [int(x) for x in row]
        least = min((sum((x - y) ** 2 for x, y in zip(exact, e, strict=True)), k) for k, e in enumerate(book))
        code[i] = least[1]
        error.append(least[0])
    return code, error


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    """A whole number as signed digits of 30 bits, so that sums of digits stay within 64 bits."""
    sign, total, at = (-1, -total, 0) if total < 0 else (1, total, 0)
    while total:
        yield at, sign * (total & ((1 << _LIMB) - 1))
        total, at = total >> _LIMB, at + 1


def _sums(books: list[list[tuple[int, ...]]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Weights and weighted sums of the distinct parts of a task by position and nearest entry; component -1 holds the weight."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, sums = len(books[0][0]), {}
        for batch in batches:
            place, weight, raws = batch.column("place").to_numpy(), batch.column("weight").to_numpy(), batch.column("part").to_pylist()
            for p in np.unique(place).tolist():
                own = np.flatnonzero(place == p)
                values, w = _unpacked([raws[i] for i in own.tolist()], size), weight[own]
                code, _ = nearest_entries(values, books[p])
                order = np.argsort(code, kind="stable")
                starts = np.flatnonzero(np.diff(code[order], prepend=-1))
                # within these bounds sums of a batch fit into 64 bits
                plain = np.abs(values).max(initial=0) <= _SMALL and float(w.sum()) < 1 << 42
                exact = values.astype(np.int64) if plain else np.array([[int(x) for x in r] for r in values.tolist()], dtype=object)
                weighted = exact * (w if plain else w.astype(object))[:, None]
                columns = np.concatenate([(w if plain else w.astype(object))[:, None], weighted], axis=1)[order]
                for e, total in zip(code[order][starts].tolist(), np.add.reduceat(columns, starts, axis=0).tolist(), strict=True):
                    known = sums.setdefault((p, e), [0] * (size + 1))
                    sums[p, e] = [a + int(b) for a, b in zip(known, total, strict=True)]
        rows = [(p, e, j - 1, at, digit) for (p, e), total in sums.items() for j, t in enumerate(total) for at, digit in _limbs(t)]
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["place", "entry", "component", "limb", "digit"])

    return run


def _codes(books: list[list[tuple[int, ...]]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(books[0][0])
        for batch in batches:
            place, raws = batch.column("place").to_numpy(), batch.column("part").to_pylist()
            code, error = np.zeros(batch.num_rows, np.int32), [0] * batch.num_rows
            for p in np.unique(place).tolist():
                own = np.flatnonzero(place == p).tolist()
                code[own], far = nearest_entries(_unpacked([raws[i] for i in own], size), books[p])
                for i, e in zip(own, far if isinstance(far, list) else far.tolist(), strict=True):
                    error[i] = e if e <= _LONG else None
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("part"), batch.column("weight"), pa.array(code), pa.array(error, pa.int64())], ["place", "part", "weight", "code", "error"])

    return run


def _next_books(distinct: DataFrame, books: list[list[tuple[int, ...]]]) -> list[list[tuple[int, ...]]]:
    """One round: entries move to the floor of the mean of their parts, unused ones stay."""
    digits = distinct.mapInArrow(_sums(books), "place long, entry long, component long, limb long, digit long")
    total: dict[tuple[int, int], dict[int, int]] = {}
    # positions x entries x components x digits, whatever the number of vectors
    for r in digits.groupBy("place", "entry", "component", "limb").agg(F.sum("digit").alias("digit")).collect():
        own = total.setdefault((r.place, r.entry), {})
        own[r.component] = own.get(r.component, 0) + (r.digit << (_LIMB * r.limb))
    return [[tuple(total[p, e].get(j, 0) // total[p, e][-1] for j in range(len(entry))) if (p, e) in total else entry for e, entry in enumerate(book)] for p, book in enumerate(books)]


def compress_vectors(spark: SparkSession, vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[list[tuple[int, ...]]]]:
    """(vec_id, label, codes array<int>, error long) of vectors(vec_id, label, vector) and the codebooks: position, entry, components.

    Null vectors, vectors that hold null, NaN or infinite components, and empty ones drop out, and so do vectors whose length is no multiple
    of parts or differs from that of the kept vector with the smallest vec_id.  Codebooks start as the parts of the vectors with the
    smallest vec_ids (equal ids in the order of their components; null ids never start one), fewer than entries if there are fewer vectors.  Rows that repeat
    are kept and weigh each.  An error beyond 64 bits is null.  Without kept rows, or without ids, there are no rows and no
    codebooks.  Other columns are not looked at.  Components have to stay finite when multiplied by scale.
    """
    scratch = Scratch(spark, "vector-codes")
    kept = kept_vectors(vectors.select("vec_id", "label", F.col(vector).alias("vector")), "vector", parts, scale).select("vec_id", "label", "scaled")
    first = kept.where("vec_id IS NOT NULL").orderBy("vec_id", "scaled").limit(1).collect()
    if not first:
        return kept.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")).limit(0), []
    dims = len(first[0].scaled)
    kept = scratch.keep(kept.where(F.size("scaled") == dims).withColumn("row", F.monotonically_increasing_id()), "kept")
    start = kept.where("vec_id IS NOT NULL").orderBy("vec_id", "scaled").limit(entries).collect()
    size = dims // parts
    books = [[tuple(int(x) for x in r.scaled[p * size : (p + 1) * size]) for r in start] for p in range(parts)]
    pieces = scratch.keep(kept.select("row", "scaled").mapInArrow(_cut(parts), "row long, place int, part binary"), "pieces")
    distinct = scratch.keep(pieces.groupBy("place", "part").agg(F.count("*").alias("weight")), "distinct")
    for _ in range(rounds):
        books = _next_books(distinct, books)
    coded = scratch.keep(distinct.mapInArrow(_codes(books), "place int, part binary, weight long, code int, error long"), "coded")
    n = kept.count()
    found = join_distinct(pieces, coded, ["place", "part"], F.col("weight") * SHARE > n)
    whole = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("c"), F.when(F.count("error") == parts, F.try_sum("error")).alias("error"))
    return kept.select("row", "vec_id", "label").join(whole, "row").select("vec_id", "label", F.col("c.code").alias("codes"), "error"), books


def label_errors(spark: SparkSession, coded: DataFrame) -> DataFrame:
    """Coded rows with label_error, the sum of the errors of their label; null labels are one label, and a sum with an unknown error or beyond 64 bits is null."""
    scratch = Scratch(spark, "label-errors")
    # null labels and labels are told apart by a second key, so that keys are never null
    keyed = scratch.keep(coded.withColumns({"has": F.col("label").isNotNull(), "key": F.coalesce("label", F.lit(0))}), "coded")
    sums = keyed.groupBy("has", "key").agg(F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error"), F.count("*").alias("rows_of_label"))
    n = keyed.count()
    return join_distinct(keyed, sums, ["has", "key"], F.col("rows_of_label") * SHARE > n).drop("has", "key", "rows_of_label")


def books_sha256(books: list[list[tuple[int, ...]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
