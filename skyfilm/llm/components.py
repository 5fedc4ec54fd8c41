"""Connected components by alternating star contractions (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) for every node of links(a, b); component is the smallest node of its part.

    Each round is one written table, so a lost executor costs one round.  A star's centre can hold
    any share of the rows: it only meets its own minimum, one row, in a join that Spark may split.
    Links of a node with itself and nulls are ignored; no links give an empty table.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = scratch.keep(edges, f"{name}0")
    state, round_no = None, 0
    while True:
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen["n"] == 0 or (seen["n"], seen["s"]) == state:
            break
        state = (seen["n"], seen["s"])
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        round_no += 1
        new = scratch.keep(small, f"{name}{round_no}")
        scratch.drop(f"{name}{round_no - 1}")
        edges = new
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
