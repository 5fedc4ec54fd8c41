"""Window operators: newest rows, islands, conflicts, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key, first in an order that must be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key is not unique."""
    return df.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where("__n > 1").drop("__n")


def with_frequency(df: DataFrame, key: str, name: str = "frequency") -> DataFrame:
    return df.withColumn(name, F.count(key).over(Window.partitionBy(key)))


def off_median(df: DataFrame, group: str, limits: dict[str, float]) -> DataFrame:
    """df with is_outlier: a value further from its group's median than its limit."""
    medians = df.groupBy(group).agg(*[F.median(c).alias(f"__{c}") for c in limits])
    far = F.lit(False)
    for c, limit in limits.items():
        far = far | (F.abs(F.col(c) - F.col(f"__{c}")) > limit)
    return df.join(medians, group).withColumn("is_outlier", far).drop(*[f"__{c}" for c in limits])


def islands(df: DataFrame, keys: Sequence[str], start: Column, end: Column, gap: Column, tie: str, name: str = "island") -> DataFrame:
    """Numbers from 0 of runs whose starts lie within gap of the furthest end so far."""
    w = Window.partitionBy(*keys).orderBy("__a", tie)
    rows = df.withColumns({"__a": start, "__b": end})
    reach = F.max("__b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__new", F.coalesce((F.col("__a") - reach > gap).cast("int"), F.lit(0)))
    return rows.withColumn(name, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__a", "__b", "__new")


def strongest_of_runs(df: DataFrame, keys: Sequence[str], at: str, strength: str, distance: float) -> DataFrame:
    """Rows no further apart than distance merged into the strongest of them, the first of equals."""
    runs = islands(df, keys, F.col(at), F.col(at), F.lit(distance), at)
    best = F.max_by(F.col(at), F.struct(F.col(strength), -F.col(at)))
    return runs.groupBy(*keys, "island").agg(best.alias(at), F.max(strength).alias(strength), F.count("*").alias("n"))


def true_runs(df: DataFrame, keys: Sequence[str], order: str, flag: Column) -> DataFrame:
    """(keys, run, first, last, n) of unbroken runs of rows with the flag; rows are numbered from 0 in the order."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.withColumns({"__i": F.row_number().over(w) - 1, "__f": flag})
    true = rows.where("__f").withColumn("__g", F.col("__i") - F.row_number().over(w))
    out = true.groupBy(*keys, "__g").agg(F.min("__i").alias("first"), F.max("__i").alias("last"), F.count("*").alias("n"))
    return out.drop("__g")


def settle_labels(df: DataFrame, key: str, label: str, order: Sequence[Column], exclude_conflicts: bool = True) -> DataFrame:
    """Newest label of each key, and whether its labels disagree; keys in conflict go if asked for."""
    w = Window.partitionBy(key)
    marked = df.withColumn("conflict", F.size(F.collect_set(label).over(w)) > 1)
    out = newest(marked, [key], order)
    return out.where("NOT conflict") if exclude_conflicts else out


def coverage(df: DataFrame, key: str, day: Column) -> DataFrame:
    """First, last and number of covered days of each key, and the share of days between that are covered."""
    days = df.select(key, day.alias("day")).where("day IS NOT NULL").distinct()
    out = days.groupBy(key).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"))
    span = F.datediff("last_day", "first_day") + 1
    return out.withColumns({"span": span.cast("long"), "covered_pct": F.round(100.0 * F.col("days") / span, 2)})


def uncovered_days(df: DataFrame, key: str, day: Column) -> DataFrame:
    """Days without a row between consecutive covered days: gaps are expanded, covered days are not listed."""
    days = df.select(key, day.alias("day")).where("day IS NOT NULL").distinct()
    before = F.lag("day").over(Window.partitionBy(key).orderBy("day"))
    gaps = days.withColumn("before", before).where("datediff(day, before) > 1")
    return gaps.select(key, F.explode(F.sequence(F.date_add("before", 1), F.date_sub("day", 1))).alias("day"))


def dominant_line(df: DataFrame, group: str, centre: str, tolerance: float) -> DataFrame:
    """Rows near the group's median centre; all rows of a group in which none is."""
    medians = df.groupBy(group).agg(F.median(centre).alias("__m"))
    w = Window.partitionBy(group)
    near = F.abs(F.col(centre) - F.col("__m")) <= tolerance
    rows = df.join(medians, group).withColumn("__near", near)
    return rows.withColumn("__any", F.max("__near").over(w)).where("__near OR NOT __any").drop("__m", "__near", "__any")


def accepted(points: Column, jump: float, after: float) -> Column:
    """Points array<struct<x, y>> by x without those that jump from the last accepted one, beyond ``after``."""
    start = F.slice(points, 1, 1)
    rest = F.slice(points, F.lit(2), F.greatest(F.size(points) - 1, F.lit(0)))
    return F.aggregate(rest, start, lambda kept, p: F.when((F.abs(p["y"] - F.try_element_at(kept, F.lit(-1))["y"]) > jump) & (p["x"] > after), kept).otherwise(F.concat(kept, F.array(p))))


def adjacent_mean(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """(key, mean): mean difference between neighbours among each key's n least values; Spark keeps no more of a key than those before it shuffles."""
    first = rows.where(F.col(value).isNotNull()).select(key, value).withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(value))).where(F.col("__n") <= n)
    ends = first.groupBy(key).agg(F.max(value).alias("b"), F.min(value).alias("a"), F.count("*").alias("c"))
    return ends.select(key, ((F.col("b") - F.col("a")) / F.nullif(F.col("c") - 1, F.lit(0))).alias("mean"))


def resampled(points: DataFrame, key: str, x: str, y: str, low: float = 0.0, high: float = 14.0, step: float = 0.01) -> DataFrame:
    """(key, x, y): the points that are nearest to a place of the grid low, low + step, ..., high, the left one of two equally near ones, each once.

    A point is nearest to the places between the middles to its neighbours, so it stays if one of them is a grid's; of points with equal x the one with the least y counts.
    """
    first = points.where(F.col(x).isNotNull()).groupBy(key, F.col(x).cast("double").alias(x)).agg(F.min(y).alias(y))
    order = Window.partitionBy(key).orderBy(x)
    before, after = (F.lag(x).over(order) + F.col(x)) / 2, (F.lead(x).over(order) + F.col(x)) / 2
    # the first place beyond the left middle, and the last one up to the right middle
    start = F.greatest(F.coalesce(F.floor((before - low) / step) + 1, F.lit(0)), F.lit(0))
    end = F.least(F.coalesce(F.floor((after - low) / step), F.lit(int(round((high - low) / step)))), F.lit(int(round((high - low) / step))))
    return first.withColumns({"__a": start, "__b": end}).where("__a <= __b").drop("__a", "__b")


def best_cluster(df: DataFrame, group: str, cluster: str, score: Sequence[Column]) -> DataFrame:
    """Each group's cluster with the greatest score, compared part by part; the smaller cluster of equals."""
    return df.groupBy(group).agg(F.max_by(F.col(cluster), F.struct(*[s.alias(f"s{i}") for i, s in enumerate(score)], (-F.col(cluster)).alias("c"))).alias(cluster))
