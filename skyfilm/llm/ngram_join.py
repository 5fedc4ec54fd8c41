"""Exact set-similarity self-join on word shingles by a grouped prefix join.

Texts become sets of distinct 5-word shingles.  Under one total order of shingles, two sets with
Jaccard similarity of at least t share a shingle among their first ``n - ceil(t n) + 1``; sets with
equal size and equal prefix are collapsed into one group, only groups meet in the join, and group
pairs that survive the length and position filters are expanded to members and verified.

The order puts rare shingles first.  Rarity comes from a table of 2**20 counters over all texts, of
fixed size whatever the corpus; any order gives the same result, a good one fewer candidates.

Pairs inside a large group of near copies are never listed.  First every group meets, under each
shared shingle, only the group with the highest mean shingle count there (the text that the copies
come from); what verifies is merged into components.  Then only pairs of groups in different
components are listed, so no link between texts that are not yet connected is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .components import connected_components
from .scratch import Scratch
from .words import U64, digest, mix, shingle_sets, sized

SKETCH_BITS = 20
_BLOCK_BITS = 16
PARTNERS = 256


def _shared_count_table(docs: DataFrame, k: int) -> np.ndarray:
    """For each of 2**20 buckets the rounded 8 * log2(1 + sets with a shingle there), as bytes."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << SKETCH_BITS, dtype=np.uint32), 0
        for batch in sized(batches, "text"):
            sets = list(shingle_sets(batch.column("text").to_pylist(), k))
            if sets:
                total += np.bincount((np.concatenate(sets) & U64((1 << SKETCH_BITS) - 1)).astype(np.int64), minlength=1 << SKETCH_BITS).astype(np.uint32)
            rows += batch.num_rows
        if rows:
            for i, part in enumerate(total.reshape(-1, 1 << _BLOCK_BITS)):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "counts"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = sums.setdefault(i, np.zeros(1 << _BLOCK_BITS, dtype=np.uint64))
                own += np.frombuffer(raw, dtype=np.uint32)
        for i, own in sums.items():
            raw = np.minimum(255, np.round(8 * np.log2(1.0 + own.astype(np.float64)))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([raw.tobytes()], pa.binary())], ["block", "counts"])

    partial = docs.select("text").mapInArrow(count, "block int, counts binary")
    parts = partial.repartition(1 << (SKETCH_BITS - _BLOCK_BITS), "block").mapInArrow(add, "block int, counts binary").collect()
    table = np.zeros((1 << (SKETCH_BITS - _BLOCK_BITS), 1 << _BLOCK_BITS), dtype=np.uint8)
    for r in parts:
        table[r["block"]] = np.frombuffer(r["counts"], dtype=np.uint8)
    return table.reshape(-1)


def _bitmap(values: np.ndarray) -> bytes:
    """Parities of the set over 2**b bits, about two for each shingle: a lower bound of set differences."""
    bits = max(6, int(2 * len(values) - 1).bit_length())
    index = (mix(values ^ U64(0x5851F42D4C957F2D)) & U64((1 << bits) - 1)).astype(np.int64)
    return np.packbits((np.bincount(index, minlength=1 << bits) & 1).astype(np.uint8)).tobytes()


def _least_difference(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        # bit i of packbits is bit i of the set's table; the larger table folds by halves
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _features(docs: DataFrame, keep: list[str], table, percent: int, k: int) -> DataFrame:
    """keep and n, node (digest of the set), g (hash of size and prefix), prefix, bitmap, score."""
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("g", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("bitmap", T.BinaryType()), T.StructField("score", T.FloatType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = table.value
        for batch in sized(batches, "text"):
            n, node, g, prefix, bitmap, score = [], [], [], [], [], []
            for s in shingle_sets(batch.column("text").to_pylist(), k):
                n.append(len(s))
                if not len(s):
                    for x in (node, g, prefix, bitmap, score):
                        x.append(None)
                    continue
                c = counts[(s & U64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                first = len(s) - -(-percent * len(s) // 100) + 1
                order = np.argsort((c.astype(U64) << U64(56)) | (s >> U64(8)), kind="stable")[:first]
                own = s[order]
                node.append(digest(s))
                g.append(int.from_bytes(digest(np.append(own, U64(len(s))))[:8], "little", signed=True))
                prefix.append(own.view(np.int64))
                bitmap.append(_bitmap(s))
                score.append(float(c.mean()))
            arrays = [pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(g, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bitmap, pa.binary()), pa.array(score, pa.float32())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], [*keep, "n", "node", "g", "prefix", "bitmap", "score"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, k: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose sets, built anew from the whole texts, are similar enough."""

    def by_bitmap(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (np.asarray(batch.column(c), dtype=np.int64) for c in ("na", "nb"))
            ma, mb = (batch.column(c).to_pylist() for c in ("ma", "mb"))
            # I = (s - d) / 2 and U = (s + d) / 2 for s = na + nb and d differing shingles
            ok = [100 * (x + y - d) >= percent * (x + y + d) for x, y, d in zip(na.tolist(), nb.tolist(), map(_least_difference, ma, mb), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], ["a", "b"])

    def by_text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        for batch in sized(batches, "ta"):
            ok = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb")), strict=True):
                if len(known) > 64:
                    known.clear()
                for node, text in ((a, ta), (b, tb)):
                    if node not in known:
                        known[node] = next(iter(shingle_sets([text], k)))
                both = len(np.intersect1d(known[a], known[b], assume_unique=True))
                ok.append(100 * both >= percent * (len(known[a]) + len(known[b]) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok, pa.bool_())), batch.column("b").filter(pa.array(ok, pa.bool_()))], ["a", "b"])

    def own_text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "text"):
            ok = pa.array([digest(s) == node for s, node in zip(shingle_sets(batch.column("text").to_pylist(), k), batch.column("node").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("node").filter(ok), batch.column("text").filter(ok)], ["node", "text"])

    slim = nodes.select("node", "n", "bitmap")
    wide = pairs.join(slim.toDF("a", "na", "ma"), "a").join(slim.toDF("b", "nb", "mb"), "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    pairs = scratch.keep(wide.mapInArrow(by_bitmap, "a binary, b binary"), f"{name}-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "doc_id"), "node")
    key = F.coalesce("doc_id", F.lit(-1).cast("long")).alias("doc_key")
    texts = docs.where("text IS NOT NULL").select(key, "text").join(wanted.select(key, "node"), "doc_key").mapInArrow(own_text, "node binary, text string")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    # one text can be the partner of any share of the pairs: its pairs are dealt to several tasks, each with a copy
    loads = pairs.groupBy("b").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("salts"))
    left = pairs.join(loads, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt")).join(texts.toDF("a", "ta"), "a")
    right = texts.toDF("b", "tb").join(loads, "b").select("b", "tb", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    checked = left.join(right, ["b", "salt"]).mapInArrow(by_text, "a binary, b binary")
    return scratch.keep(checked, name)


def similarity_classes(spark: SparkSession, docs: DataFrame, percent: int = 80, k: int = 5, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes) of the join over docs(doc_id, text).

    rows: doc_id, n (set size), node (digest of the set; null for a text without words), one for each
    row of docs.  nodes: node, component (the smallest node reachable by links), doc_id (smallest of the
    rows with that set) and lead_id (smallest doc_id of the component).

    Null or empty texts have no node and link with nothing.  Rows with equal sets are one node however many
    they are.  A null doc_id takes part and never is the smallest, unless a component has no other.  Repeated doc_ids are separate rows.
    """
    scratch = scratch or Scratch(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = spark.sparkContext.broadcast(_shared_count_table(docs, k))
    feats = scratch.keep(_features(docs, ["doc_id"], table, percent, k), "features")
    full = feats.where("n > 0")
    nodes = full.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("g").alias("g"), F.first("bitmap").alias("bitmap"))
    nodes = scratch.keep(nodes, "nodes")

    # collapse equal prefixes of equal size, then post each group under the shingles of its prefix
    groups = full.select("g", "n", "prefix", "score").groupBy("g").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.max("score").alias("score"))
    posts = groups.select(F.posexplode("prefix").alias("pos", "token"), "g", "n", "score")
    under = Window.partitionBy("token")
    posts = posts.withColumns({"size": F.count("*").over(under), "pivot": F.max(F.struct("score", "g", "n", "pos")).over(under)}).where("size > 1")
    posts = scratch.keep(posts.select("token", "g", "n", "pos", F.col("pivot.g").alias("pg"), F.col("pivot.n").alias("pn"), F.col("pivot.pos").alias("pp")), "posts")
    near = f"100 * least(n, pn) >= {percent} * greatest(n, pn) AND {100 + percent} * least(n - pos, pn - pp) >= {percent} * (n + pn)"

    leads = nodes.groupBy("g").agg(F.min("node").alias("lead"))
    members = nodes.select("g", F.col("node").alias("a"))
    met = posts.where(f"g != pg AND {near}").select("g", "pg").distinct()
    by_pivot = met.join(members, "g").join(leads.select(F.col("g").alias("pg"), F.col("lead").alias("b")), "pg").select("a", "b")
    in_group = members.join(leads, "g").select("a", F.col("lead").alias("b")).where("a != b")
    first = _verified(by_pivot.union(in_group).where("a != b"), nodes, docs, percent, k, scratch, "links1")
    parts = scratch.keep(connected_components(first, scratch, "cc1"), "parts1")

    # what is not yet connected: groups of different components under one shingle
    placed = nodes.select("g", "node").join(parts, "node", "left").select("g", "node", F.coalesce("component", "node").alias("component"))
    part_of = placed.groupBy("g").agg(F.min("component").alias("c"), F.max("component").alias("c2"))
    again = posts.select("token", "g", "n", "pos").join(part_of, "g")
    open_tokens = again.groupBy("token").agg(F.min("c").alias("x"), F.max("c2").alias("y")).where("x != y").select("token")
    again = again.join(open_tokens, "token")
    other = again.select("token", F.col("g").alias("pg"), F.col("n").alias("pn"), F.col("pos").alias("pp"), F.col("c").alias("pc"), F.col("c2").alias("pc2"))
    met = again.join(other, "token").where(f"g < pg AND (c != pc OR c2 != pc2 OR c != c2) AND {near}").select("g", "pg").distinct()
    mixed = part_of.where("c != c2").select("g")
    met = met.union(mixed.select("g", F.col("g").alias("pg")))
    left, right = placed.toDF("g", "a", "ca"), placed.toDF("pg", "b", "cb")
    cross = met.join(left, "g").join(right, "pg").where("ca != cb AND (g != pg OR a < b)").select("a", "b")
    second = _verified(cross, nodes, docs, percent, k, scratch, "links2")
    parts = connected_components(first.union(second), scratch, "cc2")

    whole = nodes.select("node", "doc_id").join(parts, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    lead = whole.groupBy("component").agg(F.min("doc_id").alias("lead_id"))
    whole = scratch.keep(whole.join(lead, "component").select("node", "component", "doc_id", "lead_id"), "whole")
    scratch.drop("posts", "links1", "links1-pairs", "links2", "links2-pairs", "parts1", "nodes")
    return feats.select("doc_id", "n", "node"), whole


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable)."""
    rows, nodes = similarity_classes(spark, docs, percent, k)
    joined = rows.join(nodes.select("node", "lead_id"), "node", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("lead_id")).alias("component_id"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """docs with one row of each component: that with the smallest doc_id, one of its repeats.

    Rows without words are kept, as they link with nothing; columns are those of docs.
    """
    scratch = Scratch(spark, "ngram-keep")
    _, nodes = similarity_classes(spark, docs, percent, k, scratch)
    chosen = nodes.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("best")).select("best.doc_id", "best.node")

    columns, schema = docs.columns, docs.schema
    def with_node(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "text"):
            own = [digest(s) if len(s) else None for s in shingle_sets(batch.column("text").to_pylist(), k)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.binary())], [*columns, "__node"])

    marked = docs.mapInArrow(with_node, T.StructType([*schema.fields, T.StructField("__node", T.BinaryType())]))
    chosen = chosen.select(F.col("node").alias("__node"), F.col("doc_id").alias("__doc"))
    kept = marked.where("__node IS NOT NULL").join(chosen, "__node").where(F.col("doc_id").eqNullSafe(F.col("__doc"))).dropDuplicates(["__node"])
    return kept.select(*columns).union(marked.where("__node IS NULL").select(*columns))
