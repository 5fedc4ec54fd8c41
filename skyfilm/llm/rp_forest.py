"""Nearest neighbours by a forest of random-projection trees with one priority queue for all trees.

The trees are fitted on a bounded sample; all rows are dealt to their leaves.  A query walks the trees
best margin first, from one queue, and takes the leaves it reaches; how many is set on the sample so that
its own exact neighbours are found.  The rows of those leaves are then ranked by exact cosine.

Each row travels once for each tree, so few trees and more leaves of each keep the shuffle small.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE_ROWS = 1 << 15
TREES = 4
LEAF_ROWS = 64
PROBES = 128
WANTED = 0.97
GROUP_ROWS = 1 << 14


@dataclass
class Forest:
    """planes: (tree, node, dim); cuts: (tree, node); node i has children 2i+1 and 2i+2; depth 0 is one leaf."""

    planes: np.ndarray
    cuts: np.ndarray
    depth: int
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) leaf numbers."""
        at = np.zeros((len(x), len(self.cuts)), dtype=np.int64)
        trees = np.arange(len(self.cuts))
        for level in range(self.depth):
            for t in trees:
                base = (1 << level) - 1
                margins = x @ self.planes[t, base : 2 * base + 1].T - self.cuts[t, base : 2 * base + 1]
                at[:, t] = 2 * at[:, t] + (margins[np.arange(len(x)), at[:, t]] > 0)
        return at

    def walk(self, q: np.ndarray, most: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order in which the shared queue reaches them."""
        margins = self.planes @ q - self.cuts
        first = (1 << self.depth) - 1
        queue = [(-np.inf, t, 0) for t in range(len(self.cuts))]
        heapq.heapify(queue)
        out = []
        while queue and len(out) < most:
            worst, t, node = heapq.heappop(queue)
            if node >= first:
                out.append((t, node - first))
                continue
            m = margins[t, node]
            heapq.heappush(queue, (max(worst, -m), t, 2 * node + 2))
            heapq.heappush(queue, (max(worst, m), t, 2 * node + 1))
        return out


def fit_forest(sample: np.ndarray, trees: int = TREES, leaf_rows: int = LEAF_ROWS, k: int = 5, wanted: float = WANTED, seed: int = 5) -> Forest:
    """A forest over unit vectors; splits at the median along the difference of two of a node's rows."""
    rng = np.random.default_rng(seed)
    n, dim = sample.shape
    depth = max(0, int(np.log2(max(1, n / leaf_rows))))
    planes, cuts = np.zeros((trees, (1 << depth) - 1, dim)), np.zeros((trees, (1 << depth) - 1))
    for t in range(trees):
        rows = [np.arange(n)]
        for level in range(depth):
            below = []
            for j, own in enumerate(rows):
                plane = rng.normal(size=dim)
                if len(own) > 1:
                    # a random direction in the node's own spread
                    pick = rng.choice(len(own), min(len(own), 16), replace=False)
                    plane = rng.normal(size=len(pick)) @ (sample[own[pick]] - sample[own[pick]].mean(axis=0))
                plane /= max(np.linalg.norm(plane), 1e-12)
                score = sample[own] @ plane
                cut = float(np.median(score)) if len(own) else 0.0
                node = (1 << level) - 1 + j
                planes[t, node], cuts[t, node] = plane, cut
                below += [own[score <= cut], own[score > cut]]
            rows = below
    forest = Forest(planes, cuts, depth, trees << depth)
    if depth:
        forest.leaves = _leaves_needed(forest, sample, k, wanted, rng)
    return forest


def _leaves_needed(forest: Forest, sample: np.ndarray, k: int, wanted: float, rng: np.random.Generator) -> int:
    """How many leaves find the wanted share of the exact neighbours of some rows of the sample."""
    probes = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
    leaf = forest.leaf_of(sample)
    total = len(forest.cuts) << forest.depth
    found = []
    for p in probes:
        score = sample @ sample[p]
        score[p] = -np.inf
        rank = np.full((len(forest.cuts), 1 << forest.depth), total, dtype=np.int64)
        for i, (t, x) in enumerate(forest.walk(sample[p], total)):
            rank[t, x] = i + 1
        found += [rank[np.arange(len(forest.cuts)), leaf[v]].min() for v in np.argpartition(-score, k)[:k]]
    return int(np.quantile(found, wanted, method="higher"))


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(spark: SparkSession, vectors: DataFrame, is_query, k: int = 5, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, leaf_rows: int = LEAF_ROWS, wanted: float = WANTED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by cosine of each row of vectors(vec_id, embedding) that is_query picks.

    Vectors that are null or zero or hold null or non-finite components, rows without vec_id, and vectors
    of another length than most (of equally frequent lengths the smaller counts) take no part, neither as queries.
    A query's own vec_id is no candidate; ties go to the smaller vec_id; a query with fewer
    candidates gets all of them.  Rows that repeat wholly count once.

    Equal vectors are searched and ranked once, with the k + 1 smallest ids of each.  Neighbouring leaves of a
    tree form groups of up to ``GROUP_ROWS`` rows on average; a query ranks the leaves that it visits in a group
    together and keeps k + 1 of them.  Leaves beyond that size are split by a salt.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    ok = "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x != 0)"
    kind = vectors.schema["embedding"].dataType.simpleString()
    if kind not in ("array<float>", "array<double>"):
        vectors, kind = vectors.withColumn("embedding", F.col("embedding").cast("array<double>")), "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), is_query.alias("q")).where(ok)
    size = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if size is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == size["dim"])
    order = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.select("embedding", "vec_id").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    classes = few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))

    sample = _unit([r.embedding for r in classes.orderBy(F.xxhash64(F.lit(3), F.element_at("ids", 1))).limit(sample_rows).select("embedding").collect()])
    forest = spark.sparkContext.broadcast(fit_forest(sample, trees, leaf_rows, k, wanted))
    salts = max(1, -(-size["count"] // (GROUP_ROWS << forest.value.depth)))
    together = min(forest.value.depth, int(np.log2(max(1, (GROUP_ROWS << forest.value.depth) // size["count"]))))

    def to_leaves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = forest.value
            leaf = tree.leaf_of(_unit(batch.column("embedding").to_pylist()))
            key = (leaf + (np.arange(leaf.shape[1]) << tree.depth)).reshape(-1)
            again = pa.array(np.repeat(np.arange(batch.num_rows), leaf.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("embedding").take(again), batch.column("ids").take(again)], ["leaf", "embedding", "ids"])

    def to_visits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree = forest.value
            for i, q in enumerate(_unit(batch.column("embedding").to_pylist()) if batch.num_rows else []):
                seen: dict[int, list[int]] = {}
                for t, x in tree.walk(q, tree.leaves):
                    seen.setdefault(((t << tree.depth) + x) >> together, []).append((t << tree.depth) + x)
                again = pa.array([i] * len(seen))
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.list_(pa.int64())), batch.column("qc").take(again), batch.column("embedding").take(again)], ["grp", "visited", "qc", "embedding"])

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"qc": [], "ids": [], "score": []}
        if len(left) and len(right):
            left = left.sort_values("leaf", kind="stable")
            x = np.array(left["embedding"].to_list(), dtype=np.float64)
            norm, ids = np.sqrt((x * x).sum(axis=1)), left["ids"].to_list()
            first, leaf = np.array([i[0] for i in ids]), left["leaf"].to_numpy()
            for qc, q, visited in zip(right["qc"], right["embedding"], right["visited"], strict=True):
                visited = np.asarray(visited)
                a, b = np.searchsorted(leaf, visited), np.searchsorted(leaf, visited, side="right")
                at = np.concatenate([np.arange(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True)])
                q = np.asarray(q, dtype=np.float64)
                score = (x[at] * q).sum(axis=1) / (norm[at] * np.sqrt((q * q).sum()))
                best = np.lexsort((first[at], -score))[: k + 1]
                out["qc"].append(qc)
                out["ids"].append([ids[i] for i in at[best]])
                out["score"].append(score[best])
        return pd.DataFrame({"qc": np.array(out["qc"], np.int64), "ids": pd.Series(out["ids"], dtype=object), "score": pd.Series(out["score"], dtype=object)})

    salt = F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int")
    leaves = classes.mapInArrow(to_leaves, f"leaf long, embedding {kind}, ids array<long>").withColumns({"salt": salt, "grp": F.shiftright("leaf", together)})
    queries = rows.where("q").select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    asked = queries.groupBy("embedding").agg(F.min("query_id").alias("qc"))
    visits = asked.select("qc", "embedding").repartition("qc").mapInArrow(to_visits, f"grp long, visited array<long>, qc long, embedding {kind}").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = leaves.groupBy("grp", "salt").cogroup(visits.groupBy("grp", "salt")).applyInPandas(rank, "qc long, ids array<array<long>>, score array<double>")
    hits = found.select("qc", F.explode(F.arrays_zip("ids", "score")).alias("h")).select("qc", "h.ids", "h.score")
    best = Window.partitionBy("qc").orderBy(F.desc("score"), F.element_at("ids", 1))
    hits = hits.groupBy("qc", "ids").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    lists = hits.groupBy("qc").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids"))).alias("hits"))
    flat = F.flatten(F.transform("hits", lambda h: F.transform(h["ids"], lambda i: F.struct(h["far"].alias("far"), i.alias("vec_id")))))
    own = asked.join(lists, "qc").join(queries, "embedding").select("query_id", F.slice(F.array_sort(F.filter(flat, lambda c: c["vec_id"] != F.col("query_id"))), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("rank", "c")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), (-F.col("c.far")).alias("score"))
