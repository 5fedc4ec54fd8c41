"""Aggregations: funnels, histograms, proportions with intervals, accuracies, column statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

Z95 = 1.96


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """Part of a whole in per cent, null for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole.cast("double"), F.lit(0.0)), places)


def roll_funnel(inventory: DataFrame, results: DataFrame, key: str, images: str, cls: str, classes: Sequence[str]) -> DataFrame:
    """One row for each roll of the inventory with its results by class, yield and loss in per cent."""
    counts = results.groupBy(key).agg(F.count("*").alias("processed"), *[count_where(F.col(cls) == c).alias(f"n_{c}") for c in classes])
    out = inventory.join(counts, key, "left").fillna(0, ["processed", *[f"n_{c}" for c in classes]])
    return out.withColumns({"yield_pct": percent(F.col("processed"), F.col(images)), **{f"{c}_pct": percent(F.col(f"n_{c}"), F.col("processed")) for c in classes}})


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """Values with their counts and shares."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def argmax_ties(df: DataFrame, value: str) -> DataFrame:
    """All rows with the greatest and all with the least value, marked max and min."""
    ends = df.agg(F.max(value).alias("hi"), F.min(value).alias("lo"))
    return df.join(ends, (F.col(value) == F.col("hi")) | (F.col(value) == F.col("lo"))).withColumn("which", F.when(F.col(value) == F.col("hi"), "max").otherwise("min")).drop("hi", "lo")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts in equal bins of [low, high]; the last bin holds its upper edge; values outside are left out."""
    width = (high - low) / bins
    index = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(column).between(low, high)).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))
    return counts.withColumn("left_edge", F.lit(low) + F.col("bin") * width)


def trimmed_histogram(df: DataFrame, column: str, bins: int, sigmas: float = 3.0) -> DataFrame:
    """Equal bins between the extremes of the values within some deviations of the mean."""
    stats = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"))
    kept = df.join(stats).where(F.abs(F.col(column) - F.col("m")) <= sigmas * F.col("s")).select(column)
    ends = kept.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    index = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(column) - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))), F.lit(bins - 1))).cast("int")
    return kept.join(ends).groupBy(index.alias("bin")).agg(F.count("*").alias("n"))


def gathered(df: DataFrame, key: str, column: str, bins: int, sigmas: float = 3.0) -> DataFrame:
    """(key, low, width, counts): counts in equal bins between the extremes of each group's values near their mean, empty bins too."""
    stats = df.groupBy(key).agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"))
    kept = df.join(stats, key).where(F.abs(F.col(column) - F.col("m")) <= sigmas * F.col("s")).select(key, column)
    ends = kept.groupBy(key).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    index = F.when(F.col("high") == F.col("low"), 0).otherwise(F.least(F.floor((F.col(column) - F.col("low")) * bins / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))), F.lit(bins - 1))).cast("int")
    counts = kept.join(ends, key).groupBy(key, "low", "high", index.alias("bin")).agg(F.count("*").alias("n"))
    places = counts.groupBy(key, "low", "high").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("n"))
    all_bins = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.try_element_at("n", i), F.lit(0).cast("long")))
    return places.select(key, "low", ((F.col("high") - F.col("low")) / bins).alias("width"), all_bins.alias("counts"))


def tail_share(counts: Column, low: int, skip_top: bool = True) -> Column:
    """Share of an intensity histogram (array of counts) from bin low on; the top bin does not count if skip_top."""
    tail = F.slice(counts, F.lit(low + 1), F.size(counts) - low - (1 if skip_top else 0))
    def total(a):
        return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)

    return F.when(total(counts) > 0, total(tail) / total(counts))


def proportion(ones: Column, n: Column) -> dict[str, Column]:
    """Share, standard error and half-width of the 95 % interval."""
    p = ones / F.nullif(n.cast("double"), F.lit(0.0))
    se = F.sqrt(p * (1 - p) / F.nullif(n.cast("double"), F.lit(0.0)))
    return {"p": p, "se": se, "ci95": Z95 * se}


def pooled(df: DataFrame, ones: str, n: str) -> DataFrame:
    """The share over all batches, its interval, and the variant that adds 1.96 to the error instead."""
    total = df.agg(F.sum(ones).alias("ones"), F.sum(n).alias("n"))
    out = total.withColumns(proportion(F.col("ones"), F.col("n")))
    return out.withColumn("ci95_additive", Z95 + F.col("se"))


def extrapolated(rate: Column, total: Column) -> Column:
    """Expected successes, halves to even."""
    return F.bround(rate * total, 0).cast("long")


def binary_accuracy(cls: Column, x: Column, y: Column, option: str = "both") -> Column:
    """Share of right readings: of both axes, one of them at least, x or y; class 2 is left out; -1 without rows."""
    right = {"both": x & y, "one": x | y, "x": x, "y": y}[option]
    return F.coalesce(F.avg(F.when(cls != 2, right.cast("double"))), F.lit(-1.0))


def reclassified(cls: Column, dx: Column, dy: Column, x_limit: float = 1.0, y_limit: float = 100.0) -> Column:
    """Class 1 for readings of class 0 within the limits of both axes; A, B and C name what is off."""
    near_x, near_y = F.abs(dx) <= x_limit, F.abs(dy) <= y_limit
    return F.when(cls == 2, "2").when(near_x & near_y, "1").when(~near_x & near_y, "A").when(near_x & ~near_y, "B").otherwise("C")


def described(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, mean, sample deviation, extremes and exact quartiles; one row for each column, from values stacked by column."""
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.*")
    stats = values.groupBy("column_name").agg(F.count("v").cast("double").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"), F.min("v").alias("low"), F.max("v").alias("high"))
    q = exact_quantiles(values, "v", [0.25, 0.5, 0.75], ["column_name"])
    wide = q.groupBy("column_name").agg(*[F.max(F.when(F.col("fraction") == f, F.col("value"))).alias(f"q{i}") for i, f in ((1, 0.25), (2, 0.5), (3, 0.75))])
    return stats.join(wide, "column_name", "left")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson's r of all pairs of columns, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs])).alias("x")).select("x.*")


def split_counts(df: DataFrame, column: str, separator: str) -> DataFrame:
    """Counts of the parts of a separated text."""
    part = F.explode(F.split(F.col(column), separator)).alias("part")
    return df.where(F.col(column).isNotNull()).select(part).where("part != ''").groupBy("part").agg(F.count("*").alias("n"))


def character_accuracy(truth: Column, read: Column) -> Column:
    """Characters that agree in place, over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(truth), F.length(read))
    same = F.size(F.filter(F.sequence(F.lit(1), F.greatest(longest, F.lit(1))), lambda i: (i <= F.length(truth)) & (i <= F.length(read)) & (F.substring(truth, i, F.lit(1)) == F.substring(read, i, F.lit(1)))))
    return F.when(longest == 0, 1.0).otherwise(same / longest)


def confusion(df: DataFrame, truth: str, read: str) -> DataFrame:
    return df.groupBy(truth, read).agg(F.count("*").alias("n"))


def data_dictionary(df: DataFrame) -> DataFrame:
    """Declared type, count, nulls, and extremes (of lengths for text) of every column, from one pass."""
    parts, rows = [], []
    for c, t in df.dtypes:
        measure = F.length(F.col(c)) if t == "string" else F.col(c)
        number = measure.cast("double") if t in ("string", "int", "bigint", "double", "float") else F.lit(None).cast("double")
        parts += [F.count(c).alias(f"{c}__n"), F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), F.min(number).alias(f"{c}__lo"), F.max(number).alias(f"{c}__hi")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit("text" if t == "string" else "number" if t in ("int", "bigint", "double", "float") else "time").alias("data_type"), *[F.col(f"{c}__{k}").alias(k) for k in ("n", "nulls", "lo", "hi")]))
    return df.agg(*parts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def by_label(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Least, greatest and mean value of each column for each label."""
    return df.groupBy(label).agg(F.count("*").alias("n"), *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])


def usual_values(mapped: DataFrame, label: str, value: str, within: float = 0.75) -> DataFrame:
    """(label, usual, n): the mean place of each label over all rolls, without places off by more than a share of the labels' mean gap from the label's first mean."""
    first = mapped.groupBy(label).agg(F.avg(value).alias("__mean"))
    gap = first.agg((F.max("__mean") - F.min("__mean")).alias("span"), F.count("*").alias("labels")).select((F.col("span") / F.greatest(F.col("labels") - 1, F.lit(1))).alias("__gap"))
    near = mapped.join(first, label).join(F.broadcast(gap)).where(F.abs(F.col(value) - F.col("__mean")) <= within * F.col("__gap"))
    return near.groupBy(label).agg(F.avg(value).alias("usual"), F.count("*").alias("n"))


# fixed values: what a data dictionary may say; other units and types become the first, other types of numbers the first of numbers
UNITS = ("none", "degrees", "kilometres", "megahertz", "pixels", "seconds")
TYPES = {"text": ("string",), "number": ("bigint", "int", "double", "float"), "time": ("timestamp_ntz", "timestamp", "date")}


def declared(fields: DataFrame, unit: str = "unit", kind: str = "type") -> DataFrame:
    """A data dictionary's fields with unit and type from the lists of known ones: (…, family) and the first of its family for a type that only begins like one."""
    known = F.trim(F.lower(F.col(unit)))
    name = F.trim(F.lower(F.col(kind)))
    family, exact = F.lit("text"), F.lit(TYPES["text"][0])
    for f, types in TYPES.items():
        hit = name.isin(*types)
        near = F.lit(False)
        for t in types:
            near = near | F.startswith(name, F.lit(t[:3]))
        family = F.when(hit | near, F.lit(f)).otherwise(family)
        exact = F.when(hit, name).when(near, F.lit(types[0])).otherwise(exact)
    return fields.withColumns({unit: F.when(known.isin(*UNITS), known).otherwise(UNITS[0]), "family": family, kind: exact})
