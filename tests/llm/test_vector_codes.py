import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from skyfilm.llm import queries, vector_codes


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """rows: (vec_id, label, vector); plain whole numbers all the way."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][2]) // parts
    cut = lambda v, p: tuple(v[p * size : (p + 1) * size])
    start = sorted(((i, v) for i, _, v in kept if i is not None))[:entries]
    books = [[cut(v, p) for _, v in start] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [[] for _ in book]
            for _, _, v in kept:
                own[near(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [tuple(sum(c) // len(xs) for c in zip(*xs, strict=True)) if xs else old for xs, old in zip(own, book, strict=True)]
    out = []
    for i, lab, v in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, lab, tuple(e for _, e in best), sum(d for d, _ in best)))
    return out, books


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>")


def order(rows):
    return sorted(rows, key=str)


def test_codes_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 1, 2]), [rng.gauss(0, 0.3) for _ in range(32)]) for i in range(150)]
    rows += [(1000 + i, 3, [0.0] * 16 + [-0.0] * 16) for i in range(400)]  # one vector with most rows
    rows += [(2000 + i, 3, [rng.choice([0.25, -0.25, 0.1]) for _ in range(32)]) for i in range(60)]
    rows += [(7, 1, [0.5] * 32), (7, 1, [0.5] * 32), (None, 2, [0.3] * 32)]
    bad = [(-1, 1, None), (-2, 1, []), (-3, 1, [None] * 32), (-4, 1, [math.nan] * 32), (-5, 1, [math.inf] + [0.0] * 31), (-6, 1, [0.1] * 31), (3000, 1, [0.1] * 48)]
    coded, books = vector_codes.compress_vectors(spark, frame(spark, rows + bad).repartition(5), parts=8, entries=20, rounds=3)
    want, want_books = brute(rows, 8, 20, 3)
    assert books == want_books
    assert order((r.vec_id, r.label, tuple(r.codes), r.error) for r in coded.collect()) == order(want)
    sums = {}
    for _, lab, _, e in want:
        sums[lab] = sums.get(lab, 0) + e
    assert all(r.label_error == sums[r.label] for r in vector_codes.label_errors(spark, coded).collect())


def test_codes_of_huge_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, i % 2, [rng.choice([1e30, -3e25, 7e5, 1e12, 0.3, -2.0]) * rng.random() for _ in range(4)]) for i in range(80)]
    coded, books = vector_codes.compress_vectors(spark, frame(spark, rows), parts=2, entries=5)
    want, want_books = brute(rows, 2, 5)
    assert books == want_books
    got = order((r.vec_id, r.label, tuple(r.codes), r.error) for r in coded.collect())
    assert got == order((i, lab, c, e if e < 1 << 63 else None) for i, lab, c, e in want)
    assert any(e is None for *_, e in got)
    assert all((r.label_error is None) == any(x.error is None for x in coded.collect() if x.label == r.label) for r in vector_codes.label_errors(spark, coded).collect())


def test_codes_of_few_vectors_and_clashing_columns(spark):
    rows = [(2, None, [0.1] * 16), (1, None, [0.2] * 16)]
    df = frame(spark, rows, "float").withColumns({c: F.lit(0.125) for c in ("row", "place", "part", "weight", "code", "error", "scaled", "n", "has", "key")})
    coded, books = vector_codes.compress_vectors(spark, df)
    assert [len(b) for b in books] == [2] * 16 and books[0] == [(51,), (25,)]
    assert {r.vec_id: (set(r.codes), r.error, r.label_error) for r in vector_codes.label_errors(spark, coded).collect()} == {1: ({0}, 0, 0), 2: ({1}, 0, 0)}
    assert vector_codes.compress_vectors(spark, df.where("vec_id > 5"))[0].count() == 0
    empty, books = vector_codes.compress_vectors(spark, df.withColumn("vec_id", F.lit(None).cast("long")))
    assert books == [] and vector_codes.label_errors(spark, empty).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, books = brute(rows)
    got = queries.op13_vector_codes(spark, sf).collect()
    text = ",".join(str(x) for b in books for e in b for x in e)
    assert {(r.vec_id, r.code, r.error) for r in got} == {(i, "".join(f"{c:02x}" for c in cs), e) for i, _, cs, e in want}
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
