"""Two layers in the values of a group, and rows of marks in a picture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import medians
from .windows import islands


def within_mads(rows: DataFrame, by: Sequence[str], value: str, mads: float = 10.0) -> DataFrame:
    """Rows whose value lies within some median deviations of their group's median; all rows of a group whose deviation is 0."""
    centred = rows.join(medians(rows, value, by, "__m"), list(by)).withColumn("__off", F.abs(F.col(value) - F.col("__m")))
    spread = medians(centred, "__off", by, "__mad")
    near = (F.col("__mad") == 0) | (F.col("__off") <= mads * F.col("__mad"))
    return centred.join(spread, list(by)).where(near).drop("__m", "__off", "__mad")


def _spread(n: Column, s: Column, q: Column) -> Column:
    return F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0)))


def two_layers(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., n, cut, lower, cost): the last value of the lower layer, its rows, and the sum of both layers' deviations, which is least, the first of equals.

    Values are counted first; sums of them and of their squares along the sorted values give every cut's cost in one pass.  Groups with one value
    have no cut.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    to = Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    own = {"n": F.col("c").cast("double"), "s": F.col("c") * F.col("v"), "q": F.col("c") * F.col("v") * F.col("v")}
    sums = counts.select(*by, "v", *[F.sum(e).over(w).alias(f"{name}{i}") for name, e in own.items() for i, w in enumerate((to, whole))])
    rest = [F.col(f"{c}1") - F.col(f"{c}0") for c in own]
    cost = _spread(F.col("n0"), F.col("s0"), F.col("q0")) + _spread(*rest)
    best = sums.where("n1 > n0").groupBy(*by).agg(F.max("n1").cast("long").alias("n"), F.min(F.struct(cost.alias("cost"), F.col("v").alias("cut"), F.col("n0").cast("long").alias("lower"))).alias("b"))
    return best.select(*by, "n", "b.cut", "b.lower", "b.cost")


def mark_sequence(found: DataFrame, least_area: int = 8, least_height: Column | int = 2, widest: float = 2.5, least_marks: int = 11, expected: int = 15, gap_heights: float = 6.0, least_gap: float = 20.0, span_heights: float = 10.0) -> DataFrame:
    """(k, x1, y1, x2, y2, marks, span, area): the row of marks of each picture, from its connected parts; right and bottom are exclusive.

    Parts that are small, low or much wider than high are noise.  Marks whose gaps are no larger than some median heights form a cluster; of clusters with enough
    marks and span the one counts that covers most of the expected marks, then is nearest to them in number, spans most, has
    most pixels, and lies furthest left.  Pictures without such a cluster have no row.
    """
    height, width = F.col("bottom") - F.col("top") + 1, F.col("right") - F.col("left") + 1
    least = least_height if isinstance(least_height, Column) else F.lit(least_height)
    marks = found.where((F.col("area") >= least_area) & (height >= least) & (width / height <= widest))
    marks = marks.select("k", "label", "area", F.col("left").alias("x1"), F.col("top").alias("y1"), (F.col("right") + 1).alias("x2"), (F.col("bottom") + 1).alias("y2"))
    typical = marks.groupBy("k").agg(F.median(F.col("y2") - F.col("y1")).alias("typical"))
    gap = F.greatest(F.lit(float(least_gap)), F.col("typical") * gap_heights)
    runs = islands(marks.join(typical, "k"), ["k"], F.col("x1"), F.col("x2"), gap, "label")
    span = (F.max("x2") - F.min("x1")).alias("span")
    clusters = runs.groupBy("k", "island", "typical").agg(F.count("*").alias("marks"), span, F.sum("area").alias("area"), *[f(c).alias(c) for c, f in (("x1", F.min), ("y1", F.min), ("x2", F.max), ("y2", F.max))])
    plausible = clusters.where((F.col("marks") >= least_marks) & (F.col("span") >= F.col("typical") * span_heights))
    score = F.struct(F.least("marks", F.lit(expected)), -F.abs(F.col("marks") - expected), "span", "area", -F.col("island"))
    best = plausible.groupBy("k").agg(F.max_by(F.struct("x1", "y1", "x2", "y2", "marks", "span", "area"), score).alias("b"))
    return best.select("k", "b.*")
