"""Reproducible samples, splits, set operations and orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows, first in the order of a hash of the key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def hash_split(key: Column, test: int = 10, validation: int = 15) -> Column:
    """Split name by a hash of the key: test per cent first, then validation per cent of the rest."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.when(h % 100 < test, "test").when((h.cast("double") / 100).cast("long") % 100 < validation, "validation").otherwise("train")


def union_by_name(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def every_input_once(inputs: DataFrame, read: DataFrame, failed: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """Inputs as read, failed or excluded, in this order of precedence; missing ones are marked so."""
    marked = union_by_name(*[f.select(key).distinct().withColumn("rank", F.lit(i)) for i, f in enumerate((read, failed, excluded))])
    best = marked.groupBy(key).agg(F.min("rank").alias("rank"))
    status = F.when(F.col("rank") == 0, "read").when(F.col("rank") == 1, "failed").when(F.col("rank") == 2, "excluded").otherwise("missing")
    return inputs.join(best, key, "left").withColumn("status", status).drop("rank")


def numbers_first(column: str, last: str = "Blank") -> list[Column]:
    """Order of labels: numbers by size, other texts, then the label that stands for none."""
    number = F.col(column).try_cast("double")
    return [(F.col(column) == last).asc(), number.asc_nulls_last(), F.col(column).asc()]


#: groups that one task may fold
MOST_GROUPS = 20_000


def greedy_group_split(df: DataFrame, group: str, shares: Sequence[tuple[str, float]] = (("train", 0.7), ("validation", 0.2), ("test", 0.1))) -> DataFrame:
    """df with split: whole groups, largest first, to the split that lacks most of its rows.

    Only the group sizes, one row for each group, are folded in one task, as each choice hangs on all before it; the rows then meet
    their group's split.  More than MOST_GROUPS groups are an error: hash_split over the group splits those.
    A split that stays empty takes the smallest group of the one with most groups.
    """
    names = [n for n, _ in shares]
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    if sizes.limit(MOST_GROUPS + 1).count() > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    items = sizes.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), F.col(group).alias("g")))).alias("items"), F.sum("n").alias("total"))
    want = F.array(*[F.lit(float(s)) * F.col("total") for _, s in shares])
    empty = F.array().cast(f"array<struct<g:{dict(df.dtypes)[group]},s:int>>")
    start = F.struct(F.array(*[F.lit(0.0)] * len(shares)).alias("have"), empty.alias("out"))

    def step(acc, x):
        lack = F.zip_with("want", acc["have"], lambda w, h: w - h)
        best = F.array_position(lack, F.array_max(lack)).cast("int") - 1
        have = F.transform(acc["have"], lambda h, i: F.when(i == best, h - x["neg"]).otherwise(h))
        return F.struct(have.alias("have"), F.concat(acc["out"], F.array(F.struct(x["g"].alias("g"), best.alias("s")))).alias("out"))

    plan = items.withColumn("want", want).select(F.aggregate("items", start, step)["out"].alias("out"))
    counts = F.transform(F.array(*[F.lit(i) for i in range(len(names))]), lambda s: F.size(F.filter("out", lambda o: o["s"] == s)))
    plan = plan.withColumn("counts", counts)
    hungry = F.array_position("counts", F.lit(0)).cast("int") - 1
    richest = F.array_position("counts", F.array_max("counts")).cast("int") - 1
    moved = F.array_max(F.transform(F.filter(F.transform("out", lambda o, i: F.struct(i.alias("i"), o["s"].alias("s"))), lambda o: o["s"] == richest), lambda o: o["i"]))
    fixed = F.when((hungry >= 0) & (F.array_max("counts") > 1), F.transform("out", lambda o, i: F.struct(o["g"].alias("g"), F.when(i == moved, hungry).otherwise(o["s"]).alias("s")))).otherwise(F.col("out"))
    flat = plan.select(F.explode(fixed).alias("o")).select(F.col("o.g").alias(group), F.element_at(F.array(*[F.lit(n) for n in names]), F.col("o.s") + 1).alias("split"))
    return df.join(flat, group)


def write_manifests(rows: DataFrame, split: str, order: Sequence[str], path: str) -> None:
    """A folder of files for each split, each file sorted, and all rows together under overall, in the order of splits and rows."""
    ordered = rows.repartitionByRange(split, *order).sortWithinPartitions(split, *order)
    ordered.write.mode("overwrite").partitionBy(split).parquet(f"{path}/splits")
    ordered.write.mode("overwrite").parquet(f"{path}/overall")


def split_sample(boxes: DataFrame, split: str, key: str, each: int, seed: int = 0) -> DataFrame:
    """The same number of rows of each split, first in the order of a hash; Spark keeps no more of a split than those before it shuffles."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return boxes.withColumn("__n", F.row_number().over(Window.partitionBy(split).orderBy(order, key))).where(F.col("__n") <= each).drop("__n")
