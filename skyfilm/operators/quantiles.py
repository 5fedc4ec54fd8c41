"""Exact quantiles without a task that holds a column: ranges around the wanted ranks are narrowed by counts.

Sketches that merge give a range that holds the wanted rank; counting what lies below and inside it makes the range
certain and the sketch of what lies inside gives the next one.  Each pass leaves about one row in a hundred, so few
passes leave a number of rows that may be sorted in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

#: rows that are sorted in one place; ranges that are broadcast, in rows
SMALL, BROADCAST = 4096, 100_000
_STEPS, _ACCURACY, _MOST_PASSES = 200, 1000, 40


def _sketch(value: Column) -> Column:
    return F.percentile_approx(value, [i / _STEPS for i in range(_STEPS + 1)], _ACCURACY)


def _narrowed(sketch: Column, rank: Column, n: Column) -> tuple[Column, Column]:
    """Places of the sketch on both sides of a rank among n rows, two steps away."""
    at = F.when(n > 1, rank / (n - 1) * _STEPS).otherwise(F.lit(0.0))
    low, high = F.greatest(F.floor(at) - 2, F.lit(0)), F.least(F.ceil(at) + 2, F.lit(_STEPS))
    return F.element_at(sketch, (low + 1).cast("int")), F.element_at(sketch, (high + 1).cast("int"))


def exact_quantiles(rows: DataFrame, value: str | Column, fractions: Sequence[float], by: Sequence[str] = (), small: int = SMALL) -> DataFrame:
    """(by..., fraction, value): quantiles of a numeric column, linear between neighbours, for each group; null and NaN are left out.

    Groups of any size and number: ranges are broadcast only while they are few.
    """
    keys = [f"__by{i}" for i in range(len(by))] or ["__by0"]
    own = [F.col(c) for c in by] or [F.lit(0)]
    column = F.col(value) if isinstance(value, str) else value
    data = rows.select(*[c.alias(k) for c, k in zip(own, keys, strict=True)], column.cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    # equal keys include null ones
    same = lambda a, b: [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    groups = data.groupBy(*keys).agg(F.count("*").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"), _sketch(F.col("__v")).alias("sketch"))
    wanted = groups.select("*", F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction")).withColumn("at", F.col("fraction") * (F.col("n") - 1))
    wanted = wanted.select("*", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"))
    near = _narrowed(F.col("sketch"), F.col("rank"), F.col("n"))
    ranges = stored(wanted.select(*keys, "fraction", "at", "rank", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), "low", "high", near[0].alias("lo"), near[1].alias("hi")), "ranges")

    def joined(open_: DataFrame) -> DataFrame:
        few = open_.count() <= BROADCAST
        return data.alias("a").join((F.broadcast(open_) if few else open_).alias("b"), same("a", "b")).select("b.*", "a.__v")

    for _ in range(_MOST_PASSES):
        wide = (F.col("inside") > small) & (F.col("low") < F.col("high"))
        open_ = ranges.where(wide)
        if open_.isEmpty():
            break
        # [low, high] is certain to hold the rank; lo and hi inside it are tried, and so many equal values may lie at either that they count apart
        v = F.col("__v")
        state = [*keys, "fraction", "at", "rank", "below", "inside", "low", "high", "lo", "hi"]
        zones = {"left": (v >= F.col("low")) & (v < F.col("lo")), "at_lo": v == F.col("lo"), "mid": (v > F.col("lo")) & (v < F.col("hi")), "at_hi": (v == F.col("hi")) & (F.col("lo") < F.col("hi")), "right": (v > F.col("hi")) & (v <= F.col("high"))}
        tried = joined(open_).groupBy(*state).agg(
            *[F.count_if(z).alias(name) for name, z in zones.items()], _sketch(F.when(zones["mid"], v)).alias("sketch"),
            *[f(F.when(zones[name], v)).alias(f"{end}_{name}") for name in ("left", "mid", "right") for end, f in (("min", F.min), ("max", F.max))])
        # the zone that holds the rank becomes the range
        before, new = F.col("below"), {"below": F.lit(None), "inside": F.lit(None), "low": F.lit(None), "high": F.lit(None)}
        ends = {"left": ("min_left", "max_left"), "at_lo": ("lo", "lo"), "mid": ("min_mid", "max_mid"), "at_hi": ("hi", "hi"), "right": ("min_right", "max_right")}
        for name, (low, high) in ends.items():
            here = (F.col("rank") >= before) & (F.col("rank") < before + F.col(name))
            for target, value in (("below", before), ("inside", F.col(name)), ("low", F.col(low)), ("high", F.col(high))):
                new[target] = F.when(here, value).otherwise(new[target])
            before = before + F.col(name)
        done = tried.select(*keys, "fraction", "at", "rank", *[c.alias(n) for n, c in new.items()], "sketch", F.when((F.col("rank") >= F.col("below") + F.col("left") + F.col("at_lo")) & (F.col("rank") < F.col("below") + F.col("left") + F.col("at_lo") + F.col("mid")), True).otherwise(False).alias("sketched"))
        near = _narrowed(F.col("sketch"), F.col("rank") - F.col("below"), F.col("inside"))
        done = done.select(*keys, "fraction", "at", "rank", "below", "inside", "low", "high", F.when(F.col("sketched"), near[0]).otherwise(F.col("low")).alias("lo"), F.when(F.col("sketched"), near[1]).otherwise(F.col("high")).alias("hi"))
        ranges = stored(ranges.where(~wide).unionByName(done), "ranges")
    else:
        raise RuntimeError("ranges did not narrow")
    met = joined(ranges.where("low < high")).where(F.col("__v").between(F.col("low"), F.col("high")))
    sorted_ = met.groupBy(*keys, "fraction", "at", "rank", "below").agg(F.sort_array(F.collect_list("__v")).alias("vs"))
    found = sorted_.select(*keys, "fraction", "at", "rank", F.element_at("vs", (F.col("rank") - F.col("below") + 1).cast("int")).alias("v"))
    found = found.unionByName(ranges.where("low = high").select(*keys, "fraction", "at", "rank", F.col("low").alias("v")))
    ends = found.groupBy(*keys, "fraction", "at").agg(F.min("v").alias("v0"), F.max("v").alias("v1"))
    share = F.col("at") - F.floor("at")
    value_ = F.when(F.col("v0") == F.col("v1"), F.col("v0")).otherwise((1 - share) * F.col("v0") + share * F.col("v1"))
    return ends.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=False)], "fraction", value_.alias("value"))


def medians(rows: DataFrame, value: str | Column, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    """(by..., median) of each group."""
    return exact_quantiles(rows, value, [0.5], by).drop("fraction").withColumnRenamed("value", name)
