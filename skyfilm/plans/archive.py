"""Archive pipelines from operators: recognised records to a master table, station coverage, app export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions import timeq as Q
from ..operators import clean as C
from ..operators import joins as J
from ..operators import windows as W
from .registry import table


def read_records(rows: DataFrame, text: str, layout: str) -> DataFrame:
    """rows with the fields of their record, clamped, and a reason where it cannot be read."""
    fields = P.fixed_width(P.sanitised(F.col(text)), layout)
    out = rows.withColumn("reason", P.rejection_reason(F.col(text))).withColumns(fields)
    return C.clamp_times(out.withColumn("year", F.col("year") + 1900), "rolling").withColumn("class", F.when(F.col("reason").isNull(), "num2").otherwise("loss"))


def master(records: DataFrame, history: DataFrame, stations: DataFrame, legacy: bool = False) -> DataFrame:
    """records with a timestamp and its quality, and the station that their number meant at that time.

    history(station_number, station_code, start_date) is joined as of the time, an equal time included;
    stations(station_code, station_name, lat, lng) adds place and name.  Records without a code are left out.
    """
    t, q = Q.time_cascade(*[F.col(c) for c in ("year", "day_of_year", "hour", "minute", "second")], legacy=legacy)
    timed = records.where("class <> 'loss'").withColumns({"timestamp": t, "time_quality": q})
    coded = J.asof_join(timed, history, ["station_number"], "timestamp", "start_date", ["station_code"]).where("station_code IS NOT NULL")
    return coded.join(stations, "station_code", "left")


def app_export(table_: DataFrame) -> DataFrame:
    """What the public application shows, under its headings."""
    return table_.select(F.sha2(F.concat_ws("/", "directory", "subdirectory", "filename"), 256).alias("ID"), F.col("filename").alias("File name"), F.col("subdirectory").alias("Subdirectory name"), F.col("station_number").alias("Ground station number"), F.col("timestamp").alias("Timestamp"), F.col("station_name").alias("Ground station name"), F.col("station_code").alias("Ground station code"), P.degrees(F.col("lat")).alias("Latitude"), P.degrees(F.col("lng")).alias("Longitude"))


RECORD = "concat('10', lpad(cast(user_id % 30 as string), 2, '0'), cast(62 + event_id % 18 as string), lpad(cast(1 + event_id % 365 as string), 3, '0'), lpad(cast(hour(ts) as string), 2, '0'), lpad(cast(minute(ts) as string), 2, '0'), lpad(cast(second(ts) as string), 2, '0'))"
DAMAGED = f"CASE WHEN event_id % 31 = 0 THEN concat('x', substring({RECORD}, 2, 14)) WHEN event_id % 37 = 0 THEN substring({RECORD}, 1, 13) ELSE {RECORD} END"


def master_from_events(spark, sf: str) -> DataFrame:
    """Events as recognised records, nations as stations whose numbers pass on after 1970."""
    records = read_records(table(spark, sf, "events").selectExpr("event_id", f"{DAMAGED} AS text"), "text", "v1")
    n = table(spark, sf, "nation")
    history = n.select(F.col("n_nationkey").alias("station_number"), F.concat(F.lit("A"), F.col("n_nationkey").cast("string")).alias("station_code"), F.lit("1960-01-01").cast("timestamp_ntz").alias("start_date")).union(n.select("n_nationkey", F.concat(F.lit("B"), F.col("n_nationkey").cast("string")), F.lit("1970-01-01").cast("timestamp_ntz")))
    stations = n.select(F.explode(F.array(F.lit("A"), F.lit("B"))).alias("era"), "n_nationkey", "n_name").select(F.concat("era", F.col("n_nationkey").cast("string")).alias("station_code"), F.concat_ws(" ", "n_name", "era").alias("station_name"))
    out = master(records, history, stations)
    return out.select("event_id", "timestamp", "time_quality", "station_number", "station_code", "station_name")


MASTER_SQL = f"""WITH r AS (SELECT event_id, {DAMAGED} AS text FROM events),
    f AS (SELECT event_id, CAST(substring(text, 3, 2) AS INT) AS station_number, 1900 + CAST(substring(text, 5, 2) AS INT) AS year, CAST(substring(text, 7, 3) AS INT) AS day, CAST(substring(text, 10, 2) AS INT) AS h, CAST(substring(text, 12, 2) AS INT) AS m, CAST(substring(text, 14, 2) AS INT) AS s FROM r WHERE NOT regexp_matches(text, '[a-zA-Z]') AND length(text) = 15),
    t AS (SELECT *, (make_date(year, 1, 1) + day - 1)::TIMESTAMP + to_hours(h) + to_minutes(m) + to_seconds(s) AS "timestamp" FROM f)
    SELECT event_id, "timestamp", 1 AS time_quality, station_number, CASE WHEN "timestamp" >= TIMESTAMP '1970-01-01' THEN 'B' ELSE 'A' END || station_number AS station_code, n_name || ' ' || CASE WHEN "timestamp" >= TIMESTAMP '1970-01-01' THEN 'B' ELSE 'A' END AS station_name
    FROM t JOIN nation ON n_nationkey = station_number WHERE year BETWEEN 1962 AND 1980"""


def availability_from_events(spark, sf: str) -> DataFrame:
    """Covered days of each station of the master table."""
    m = master_from_events(spark, sf).where("time_quality BETWEEN 1 AND 3")
    return W.coverage(m, "station_code", F.to_date("timestamp"))


AVAILABILITY_SQL = f"""WITH m AS ({MASTER_SQL}), d AS (SELECT DISTINCT station_code, "timestamp"::DATE AS d FROM m)
    SELECT station_code, min(d) AS first_day, max(d) AS last_day, count(*) AS days, CAST(max(d) - min(d) + 1 AS BIGINT) AS span, round(100.0::DOUBLE * count(*) / (max(d) - min(d) + 1), 2) AS covered_pct FROM d GROUP BY 1"""
