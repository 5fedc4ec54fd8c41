"""Joins with a table of distinct keys, some of which hold a large share of the other side's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_distinct(rows: DataFrame, keyed: DataFrame, on: list[str], heavy: Column) -> DataFrame:
    """Inner join of a stored table of rows with a table that has each key once.

    heavy is a condition over keyed that a number of its rows bounded by a parameter meets, those of the keys with
    most rows.  They are broadcast, so that their rows stay where they are; all others meet their key in a shuffle.
    """
    hot = F.broadcast(keyed.where(heavy))
    return rows.join(hot, on).unionByName(rows.join(hot.select(on), on, "left_anti").join(keyed.where(~heavy), on))
