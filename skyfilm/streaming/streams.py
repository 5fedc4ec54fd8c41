"""Structured Streaming forms of what the archive's work loops do."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType


def arriving_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_each: int = 1) -> DataFrame:
    """Files of a folder as they come, a few in each batch; a checkpoint replaces the log of work done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).format(fmt).load(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's spark.checkpoint.dir; one of this machine only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or 'file://' + os.path.join(tempfile.gettempdir(), 'skyfilm-streams')).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def drain(stream: DataFrame, mode: str = "append", keys: Sequence[str] = (), folder: str | None = None) -> DataFrame:
    """Run a stream until all files present are read; its result as a table, written batch by batch.

    In ``update`` mode the newest row of each of ``keys`` counts, in ``complete`` mode the last batch.  A folder that is given
    again goes on where it stopped; a batch that is run again replaces what it wrote before.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark, "stream")

    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/data/batch={batch}")

    query = stream.writeStream.foreachBatch(store).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{folder}/data")
    if mode == "update":
        rest = [c for c in stream.columns if c not in keys]
        rows = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("newest")).select(*keys, "newest.*").select(*stream.columns)
    elif mode == "complete":
        rows = rows.join(rows.agg(F.max("batch").alias("batch")), "batch")
    return rows.select(*stream.columns)


def windowed_counts(events: DataFrame, time: str, key: str, size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts by event-time window; timestamps without zone are read as UTC."""
    rows = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    w = F.window("__t", size, slide) if slide else F.window("__t", size)
    return rows.groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    rows = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    return rows.groupBy(F.session_window("__t", gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


FINAL = ("completed", "skipped")


def reservations(log: DataFrame, key: str = "path", hours: float = 24.0, late: str = "1 hour") -> DataFrame:
    """Status of each item of a reservation log(key, status, ts) after each batch that changes or frees it.

    An item is free again after being abandoned, or when a reservation has stood for longer than the limit: at a later event of the item, or,
    without any, once the watermark, which trails the newest event by late, has passed it.  Final states stay.
    """
    limit = hours * 3600

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, since = state.get if state.exists else ("free", 0.0)
        for pdf in batches:
            for at, event in sorted(zip(pdf["ts"].map(pd.Timestamp.timestamp), pdf["status"], strict=True)):
                if status == "reserved" and at - since > limit:
                    status = "free"
                if status in FINAL:
                    continue
                if event == "reserved" and status == "free":
                    status, since = "reserved", at
                elif event in FINAL:
                    status, since = event, at
                elif event == "abandoned":
                    status, since = "free", at
        ends = int((since + limit) * 1000)
        if status == "reserved" and ends < state.getCurrentWatermarkMs():
            status = "free"
        state.update((status, since))
        if status == "reserved":
            state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [k[0]], "status": [status]})

    timed = log.withWatermark("ts", late)
    return timed.groupBy(key).applyInPandasWithState(step, f"{key} string, status string", "status string, since double", "update", GroupStateTimeout.EventTimeTimeout)


def saved_once(rows: DataFrame, keys: Sequence[str], time: str, late: str = "1 hour") -> DataFrame:
    """A stream without rows whose key came before within the time that late rows may take."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def reservation_state(log: DataFrame, key: str, as_of: str, hours: float = 24.0) -> DataFrame:
    """The same from a whole log at one time, with the newest row of each item only."""
    last = log.groupBy(key).agg(F.max_by(F.struct("status", "ts"), F.struct("ts", "status")).alias("r")).select(key, "r.*")
    expired = (F.col("status") == "reserved") & (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp")) > int(hours * 3600e6))
    return last.withColumn("state", F.when(expired | (F.col("status") == "abandoned"), "free").otherwise(F.col("status")))
