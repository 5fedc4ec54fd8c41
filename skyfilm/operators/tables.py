"""Tables written to the folder that the cluster shares, which cut the lineage of steps that run in rounds, and tables dealt by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.streams import shared_folder

#: rows that a task gets, and rows of one key up to which a table is dealt by it
ROWS_A_TASK, MOST_OF_KEY = 1 << 17, 1 << 20


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once below the session's spark.checkpoint.dir and read from there."""
    spark = rows.sparkSession
    path = shared_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def tasks_of(rows: DataFrame, key: str = "k") -> int | None:
    """How many tasks rows are dealt to by key; None if one key has so many rows that steps had better deal its parts."""
    total, most = rows.groupBy(key).count().agg(F.sum("count"), F.max("count")).first()
    if (most or 0) > MOST_OF_KEY:
        return None
    few = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-(total or 0) // ROWS_A_TASK), min(few, -(-(total or 0) * 16 // ROWS_A_TASK)), 1)


def dealt(rows: DataFrame, key: str = "k") -> DataFrame:
    """The rows dealt by key, so that steps over a key's parts need no further exchange and no task grows with the table.

    Rows with a key of more than ``MOST_OF_KEY`` rows stay as they are: their steps deal lines and places instead.
    """
    n = tasks_of(rows, key)
    return rows.repartition(n, key) if n else rows
