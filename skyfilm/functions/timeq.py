"""Dates from days of the year, and timestamps with a graded quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_year_date(year: Column, day: Column, legacy: bool = False) -> Column:
    """The date of a day of the year, null outside the year.

    legacy reads the day in a year of 365 days whatever the year, and day 366 as January 1.
    """
    if legacy:
        plain = F.date_add(F.make_date(F.lit(1900), F.lit(1), F.lit(1)), day - 1)
        found = F.make_date(year, F.month(plain), F.dayofmonth(plain))
        return F.when(day.between(1, 366), found)
    found = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1)
    return F.when((day >= 1) & (F.year(found) == year), found)


def at(date: Column, hour: Column | None = None, minute: Column | None = None, second: Column | None = None) -> Column:
    """The timestamp of clock parts that may roll over (24:60:60); null if a part is null."""
    zero = F.lit(0)
    span = F.make_interval(zero, zero, zero, zero, zero if hour is None else hour, zero if minute is None else minute, zero if second is None else second)
    return date.cast("timestamp_ntz") + span


def time_cascade(year: Column, day: Column, hour: Column, minute: Column, second: Column, legacy: bool = False) -> tuple[Column, Column]:
    """(timestamp, quality): 1 to the second, 2 to the minute, 3 to the hour, 4 to the day, 0 with no timestamp."""
    date = day_of_year_date(year, day, legacy)
    levels = [at(date, hour, minute, second.cast("int")), at(date, hour, minute), at(date, hour), at(date)]
    quality = F.lit(0)
    for i, level in reversed(list(enumerate(levels, 1))):
        quality = F.when(level.isNotNull(), i).otherwise(quality)
    return F.coalesce(*levels), quality


# fixed values: the time quality that each kind of outlier leaves
OUTLIER_QUALITY = {"Second": 2, "Minute": 3, "Hour": 3, "Day": 4, "Year": 5}


def outlier_quality(outlier: Column) -> Column:
    """1 without an outlier, else by the part of the time that is an outlier; 5 for any other."""
    out = F.when(outlier.isNull(), 1)
    for part, q in OUTLIER_QUALITY.items():
        out = out.when(F.startswith(outlier, F.lit(part)), q)
    return out.otherwise(5)


def rendered_time(year: Column, day: Column, hour: Column, minute: Column, second: Column, quality: Column) -> Column:
    """Text of a time to the precision that its quality allows."""
    date = F.date_format(day_of_year_date(year, day), "yyyy-MM-dd")
    clock = [F.lpad(c.cast("string"), 2, "0") for c in (hour, minute, second)]
    return (
        F.when(quality == 1, F.concat(date, F.lit(" "), F.concat_ws(":", *clock)))
        .when(quality == 2, F.concat(date, F.lit(" "), clock[0], F.lit(":"), clock[1], F.lit(":00")))
        .when(quality == 3, F.concat(date, F.lit(" "), clock[0], F.lit(":00:00")))
        .when(quality == 4, F.concat(year.cast("string"), F.lit("-00-00 00:00:00")))
        .otherwise("Low certainty")
    )


def inferred_year(day: Column) -> Column:
    """Year of records without one: the mission's first days are in 1962, the rest in 1963."""
    return F.when((day > 271) & (day < 366), 1962).when((day > 0) & (day <= 271), 1963)


def repaired_year(text: Column) -> Column:
    """Two-digit year whose first digit was misread as 1, as a full year."""
    return F.regexp_replace(text, "^1", "7").try_cast("int") + 1900


def parsed_time(text: Column, fallback: str = "1969-01-30 00:00:00") -> Column:
    return F.coalesce(F.to_timestamp_ntz(F.when(F.rlike(text, F.lit(r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]) ([01]\d|2[0-3]):[0-5]\d:[0-5]\d$")), text), F.lit("yyyy-MM-dd HH:mm:ss")), F.to_timestamp_ntz(F.lit(fallback), F.lit("yyyy-MM-dd HH:mm:ss")))
