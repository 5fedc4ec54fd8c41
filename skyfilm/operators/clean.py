"""Row-wise cleaning: clamps, fault tags, class rules, dictionaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clamped(value: Column, low: float, high: float) -> Column:
    """The value, or null outside [low, high]."""
    return F.when(value.between(low, high), value)


# fixed values: what each part of a time may be; the second kind of record lets clocks reach their upper end
TIME_DOMAINS = {
    "strict": {"year": (1962, 1980), "day_of_year": (1, 366), "hour": (0, 23), "minute": (0, 59), "second": (0, 59)},
    "rolling": {"year": (1962, 1980), "day_of_year": (1, 366), "hour": (0, 24), "minute": (0, 60), "second": (0, 60)},
}


def clamp_times(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumns({c: clamped(F.col(c), *limits) for c, limits in TIME_DOMAINS[kind].items() if c in df.columns})


def first_tag(rules: Sequence[tuple[Column, str]]) -> Column:
    """The tag of the first rule that holds, else null."""
    return F.coalesce(*[F.when(cond, F.lit(tag)) for cond, tag in rules])


def time_faults(year: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    return first_tag([(year < 1969, "Year"), (day > 365, "Day>365"), (day < 1, "Day<1"), (hour >= 24, "Hour"), (minute >= 60, "Minute"), (second > 60, "Second")])


def all_tags(rules: Sequence[tuple[Column, str]]) -> Column:
    """Tags of all rules that hold, one after the other."""
    return F.concat(*[F.when(cond, F.lit(tag)).otherwise("") for cond, tag in rules])


def any_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def majority_class(df: DataFrame, group: str, cls: str, nulled: Sequence[str] = ()) -> DataFrame:
    """Within a group: if any row is num2, num and dot become loss; else the rarer of num and dot does.

    Ties stay.  Rows that become loss lose the columns ``nulled``.
    """
    w = Window.partitionBy(group)
    n = {k: F.sum((F.col(cls) == k).cast("int")).over(w) for k in ("num", "dot", "num2")}
    loses = F.when(n["num2"] > 0, F.col(cls).isin("num", "dot")).otherwise(((F.col(cls) == "dot") & (n["num"] > n["dot"])) | ((F.col(cls) == "num") & (n["dot"] > n["num"])))
    out = df.withColumn("__loses", F.coalesce(loses, F.lit(False)))
    out = out.withColumns({c: F.when(~F.col("__loses"), F.col(c)) for c in nulled})
    return out.withColumn(cls, F.when(F.col("__loses"), "loss").otherwise(F.col(cls))).drop("__loses")


def replace_everywhere(df: DataFrame, dictionary: dict[str, str]) -> DataFrame:
    """Whole values of all text columns through a dictionary; values that are not in it stay."""
    table = F.create_map(*[F.lit(x) for pair in dictionary.items() for x in pair])
    return df.select(*[F.coalesce(F.try_element_at(table, F.col(c)), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def tidy_text(text: Column) -> Column:
    """Without no-break spaces and the sign they leave when wrongly decoded, and without blanks around."""
    return F.trim(F.regexp_replace(text, "Â? ", " "))


def outcome(reason: Column, names: dict[str, str], default: str) -> Column:
    """Name of a reason without its trailing number."""
    bare = F.regexp_replace(reason, r"_\d+$", "")
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, bare), F.lit(default))


def satellite_of(label: Column, name: str, legacy: bool = False) -> Column:
    """1 for labels that hold the name and the letter A, else 2; legacy misses the spelling with a hyphen only."""
    pattern = f"(?i){name} A|{name} - A" if legacy else f"(?i){name} ?-? ?A"
    return F.when(F.coalesce(F.rlike(label, F.lit(pattern)), F.lit(False)), 1).otherwise(2)


def by_code(code: Column, value: Column, factors: dict[int, float]) -> Column:
    """value times the factor of its code, 0 for codes without one."""
    out = F.lit(0.0)
    for k, f in factors.items():
        out = F.when(code == k, value * f).otherwise(out)
    return out


def out_of_phase(digits: Column, width: Column, height: Column) -> Column:
    return F.coalesce((digits < 10) & (width / height >= 2.4), F.lit(False))


def problems(digits: Column, aspect: Column) -> Column:
    return all_tags([(digits <= 12, "few digits;"), (digits >= 18, "many digits;"), (aspect < 1.2, "narrow;"), (aspect >= 3, "wide;")])
