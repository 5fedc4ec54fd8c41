"""Joins that Spark has no operator for, from equi-joins and sorted windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: names of at most so many bytes in all, counted first, are broadcast; a row takes some more than its text
BROADCAST_BYTES, NAME_BYTES = 8 << 20, 64


def era_of(year: Column) -> Column:
    """Which station list holds: to 1963, 1964, from 1965."""
    return F.when(year <= 1963, "early").when(year == 1964, "middle").when(year >= 1965, "late")


def era_join(records: DataFrame, lists: DataFrame, year: str, key: str, how: str = "inner") -> DataFrame:
    """One equi-join on the era and the key; lists has the columns era and key."""
    return records.withColumn("era", era_of(F.col(year))).join(lists, ["era", key], how)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str], forward: bool = False, cut: str = "month", width: float = 1e6) -> DataFrame:
    """left with the values of the last right row at or before its time (forward: the first at or after).

    A union sorted by key and time carries the right rows along, so nothing is compared pairwise.  Keys are cut by ranges of time (by width where it is
    a number), and each range begins with the row that the ranges before it leave, so a key with most rows is as many tasks as it has ranges.  Of right
    rows with equal keys and times the greatest values win.  Rows of left with a null time get nulls.
    """
    own = [c for c in left.columns]
    packed = F.struct(F.col(right_time).alias("t"), *[F.col(v) for v in values])
    number = right.schema[right_time].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")
    span = F.floor(F.col("__t") / width) if number else F.date_trunc(cut, "__t")
    dim = right.where(F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).alias("__t")).agg(F.max(packed).alias("__r")).withColumn("__span", span)
    rows = left.withColumn("__t", F.col(left_time)).withColumn("__span", span)
    # what a range leaves to the ones behind it, also to those without right rows
    leaves = dim.groupBy(*keys, "__span").agg((F.min if forward else F.max)("__r").alias("__r"))
    ranges = leaves.unionByName(rows.select(*keys, "__span").distinct(), allowMissingColumns=True).groupBy(*keys, "__span").agg(F.max("__r").alias("__r"))
    before = Window.partitionBy(*keys).orderBy(F.col("__span").desc() if forward else F.col("__span").asc()).rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.select(*keys, "__span", F.last("__r", ignorenulls=True).over(before).alias("__r")).where("__r IS NOT NULL")
    parts = (first.withColumn("__part", F.lit(0)), dim.withColumn("__part", F.lit(1)), rows.withColumn("__part", F.lit(2)))
    union = parts[2].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[0], allowMissingColumns=True)
    t = F.col("__t").desc() if forward else F.col("__t").asc()
    w = Window.partitionBy(*keys, "__span").orderBy((F.col("__part") > 0).asc(), t, "__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = union.withColumn("__hit", F.when(F.col("__t").isNotNull(), F.last("__r", ignorenulls=True).over(w))).where("__part = 2")
    return found.select(*own, F.col("__hit.t").alias(f"{right_time}_hit"), *[F.col(f"__hit.{v}").alias(v) for v in values])


def scd2_intervals(history: DataFrame, key: str, start: str) -> DataFrame:
    """Each record's validity [start, next start)."""
    w = Window.partitionBy(key).orderBy(start)
    return history.withColumn("valid_to", F.lead(start).over(w))


def nearest_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str]) -> DataFrame:
    """left with the values of the right row nearest in time; of equally near ones the earlier."""
    before = asof_join(left, right, keys, left_time, right_time, values)
    names = {f"{right_time}_hit": "__t0"} | {v: f"__0{v}" for v in values}
    both = asof_join(before.withColumnsRenamed(names), right, keys, left_time, right_time, values, forward=True)
    hit = f"{right_time}_hit"
    seconds = [F.abs(F.unix_micros(F.col(c).cast("timestamp")) - F.unix_micros(F.col(left_time).cast("timestamp"))) for c in ("__t0", hit)]
    later = F.coalesce(seconds[1] < seconds[0], F.col("__t0").isNull())
    return both.select(*left.columns, F.when(later, F.col(hit)).otherwise(F.col("__t0")).alias(hit), *[F.when(later, F.col(v)).otherwise(F.col(f"__0{v}")).alias(v) for v in values])


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key: that with the greatest order."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def lookup(rows: DataFrame, table: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left join with a default in place of values that are missing."""
    out = rows.join(table, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def update_join(rows: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str) -> tuple[DataFrame, DataFrame]:
    """(rows with columns overwritten by the last change of their key, changes whose key is not there)."""
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("__new"))
    changed = rows.join(last, list(keys), "left")
    changed = changed.withColumns({c: F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in columns}).drop("__new")
    return changed, changes.join(rows.select(*keys).distinct(), list(keys), "left_anti")


def first_contained(text: Column, words: Sequence[tuple[str, str]]) -> Column:
    """Value of the first (word, value) whose word the text holds."""
    return F.coalesce(*[F.when(F.contains(F.lower(text), F.lit(w.lower())), F.lit(v)) for w, v in words])


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def contained_names(texts: DataFrame, key: str, text: str, names: DataFrame, name: str, order: str, longest: bool = True) -> DataFrame:
    """(key, name, columns of names) of the name that each text holds as whole words; texts without any have no row.

    The longest name wins, of equally long ones that with the smallest order; or always the smallest order.  Every run of words up to
    the length of the longest name is looked up in the table of names, which may have any size: one equi-join, whatever the number of names.
    Names of at most ``BROADCAST_BYTES`` in all are broadcast; beside more of them, runs and names are sorted.  Runs are never broadcast: from the
    files of the texts Spark cannot tell how many there are.
    """
    listed = names.withColumn("__w", _words(F.col(name))).where(F.size("__w") > 0).withColumn("__gram", F.array_join("__w", " ")).withColumn("__n", F.size("__w"))
    rest = [c for c in names.columns]
    listed = listed.groupBy("__gram", "__n").agg(F.min_by(F.struct(*rest), order).alias("__name"), F.min(order).alias("__order"))
    most, held_bytes = listed.agg(F.max("__n"), F.sum(NAME_BYTES + F.octet_length("__gram") + F.octet_length(F.col("__name").cast("string")))).first()
    most = most or 0
    listed = listed.hint("broadcast" if (held_bytes or 0) <= BROADCAST_BYTES else "merge")
    lengths = F.sequence(F.lit(1), F.least(F.lit(most), F.size("__w")))
    grams = F.flatten(F.transform(lengths, lambda k: F.transform(F.sequence(F.lit(1), F.size("__w") - k + 1), lambda i: F.array_join(F.slice("__w", i, k), " "))))
    held = texts.select(F.col(key), _words(F.col(text)).alias("__w")).where((F.size("__w") > 0) & F.lit(most > 0))
    met = held.select(key, F.explode(F.array_distinct(grams)).alias("__gram")).join(listed, "__gram")
    rank = F.struct((F.col("__n") if longest else F.lit(0)), (-F.col("__order")).alias("o"))
    return met.groupBy(key).agg(F.max_by("__name", rank).alias("__name")).select(key, "__name.*")


def under_any(paths: DataFrame, excluded: DataFrame, path: str, prefix: str) -> DataFrame:
    """Rows whose path is an excluded one or lies below it: an equi-join on all of a path's ancestors."""
    parts = F.split(path, "/")
    ups = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    hit = paths.select(path, F.explode(ups).alias(prefix)).join(excluded.select(prefix).distinct(), prefix, "left_semi").select(path).distinct()
    return paths.join(hit, path, "left_semi")


def worklist(everything: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    return everything.join(done, list(keys), "left_anti")
