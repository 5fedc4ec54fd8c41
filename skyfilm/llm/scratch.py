"""Tables written to the folder that the cluster shares, to cut lineage without local state."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def scratch_root(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where that is unset, a folder of this machine, in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return base or "file://" + os.path.join(tempfile.gettempdir(), "skyfilm-scratch")


#: bytes of a batch that Spark hands to Python
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limit for batches that travel between Spark and Python, of which a task holds several copies on both sides.

    It stays so, as lazily returned results are evaluated later; a lower limit stays as it is.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    jvm = spark.sparkContext._jvm
    now = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def numbered(table: DataFrame, position: str) -> DataFrame:
    """The rows of a table of parquet files with their number from 0, in the order that Spark wrote them in."""
    rows = table.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    before = Window.orderBy(F.regexp_extract("__file", r"^part-(\d+)", 1).cast("long"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("__file").agg(F.count("*").alias("n")).select("__file", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("__start"))
    # a row for each file: as many as the writer had partitions
    return rows.join(F.broadcast(starts), "__file").select(*table.columns, (F.col("__start") + F.col("__row")).alias(position))


class Scratch:
    """A folder for one call of an operator.

    Tables that only intermediate steps read are dropped with ``drop``; those that the
    lazily returned result reads stay until the shared folder is cleaned.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write df once, in folders by a column if one is named, and return the table as read back; the shuffle files behind it go at once."""
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "true")
        try:
            writer = df.write.mode("overwrite")
            (writer.partitionBy(by) if by else writer).parquet(f"{self.path}/{name}")
        finally:
            self.spark.conf.set(key, before)
        # the column of the folders comes last if there are folders, else in its place
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}").select(*[F.col(f"`{c}`") for c in df.columns])

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(conf).delete(path, True)
