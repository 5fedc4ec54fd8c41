"""Queries that run models, streams and whole archive pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import windows as W
from . import archive
from .registry import query, table
from .relational import BOX, BOXES


NMS_SQL = f"""WITH RECURSIVE b AS (SELECT l_orderkey AS o, l_partkey AS p, l_linenumber AS l, l_discount AS s, {BOX}, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber, l_partkey, x1, y1, x2, y2) AS i FROM lineitem),
    r(o, i, kept) AS (SELECT DISTINCT o, 0::BIGINT, []::STRUCT(x1 INT, y1 INT, x2 INT, y2 INT, p BIGINT, l INT, s DOUBLE)[] FROM b
        UNION ALL
        SELECT b.o, b.i, CASE WHEN len(list_filter(kept, lambda k: greatest(0, least(b.x2, k.x2) - greatest(b.x1, k.x1)) * greatest(0, least(b.y2, k.y2) - greatest(b.y1, k.y1))
            >= 0.5 * ((b.x2 - b.x1) * (b.y2 - b.y1) + (k.x2 - k.x1) * (k.y2 - k.y1) - greatest(0, least(b.x2, k.x2) - greatest(b.x1, k.x1)) * greatest(0, least(b.y2, k.y2) - greatest(b.y1, k.y1))))) > 0
            THEN kept ELSE list_append(kept, {{'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2, 'p': b.p, 'l': b.l, 's': b.s}}) END
        FROM r JOIN b ON b.o = r.o AND b.i = r.i + 1)
    SELECT o AS l_orderkey, k.p AS l_partkey, k.l AS l_linenumber, k.s AS l_discount FROM (SELECT o, unnest(arg_max(kept, i)) AS k FROM r GROUP BY o)"""


@query("im39_nms", NMS_SQL)
def _(spark, sf):
    b = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_partkey", "l_linenumber", "l_discount", *BOXES)
    box = F.struct((-F.col("l_discount")).alias("worst"), "l_linenumber", "l_partkey", "x1", "y1", "x2", "y2")
    kept = b.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(box)).alias("boxes")).select("l_orderkey", F.explode(G.suppressed("boxes")).alias("k"))
    return kept.select("l_orderkey", "k.l_partkey", "k.l_linenumber", (-F.col("k.worst")).alias("l_discount"))


ACCEPTED_SQL = """WITH RECURSIVE p AS (SELECT l_partkey, l_quantity AS x, l_extendedprice / 1000 AS y, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity, l_extendedprice / 1000) AS i, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem),
    r AS (SELECT l_partkey, i, n, y AS last, 1 AS kept FROM p WHERE i = 1
        UNION ALL
        SELECT p.l_partkey, p.i, p.n, CASE WHEN abs(p.y - last) > 30 AND p.x > 10 THEN last ELSE p.y END, kept + CASE WHEN abs(p.y - last) > 30 AND p.x > 10 THEN 0 ELSE 1 END FROM r JOIN p ON p.l_partkey = r.l_partkey AND p.i = r.i + 1)
    SELECT l_partkey, n::INT AS n, kept::INT AS kept FROM r WHERE i = n"""


@query("wn07_accepted", ACCEPTED_SQL)
def _(spark, sf):
    p = F.struct(F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_list(p)).alias("p"))
    return g.select("l_partkey", F.size("p").alias("n"), F.size(W.accepted(F.col("p"), 30.0, 10.0)).alias("kept"))


def elbow(costs: dict[int, float]) -> int:
    """The number of clusters whose cost lies furthest below the line from the first to the last."""
    ks = sorted(costs)
    fall = (costs[ks[0]] - costs[ks[-1]]) / max(ks[-1] - ks[0], 1)
    return max(ks, key=lambda k: (costs[ks[0]] - fall * (k - ks[0]) - costs[k], -k))


@query("ml01_kmeans")
def _(spark, sf):
    """Vectors in as many clusters as the elbow of the costs of 1 to 10 says; costs are one number each."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    e = table(spark, sf, "embeddings").where("embedding IS NOT NULL").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))
    scaled = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(e).transform(e)
    # one cluster has its centre at 0, as the vectors are scaled
    alone = scaled.agg(F.sum(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0
    models = {k: KMeans(k=k, seed=42, maxIter=10).fit(scaled) for k in range(2, 11)}
    best = elbow({1: alone} | {k: m.summary.trainingCost for k, m in models.items()})
    if best == 1:
        return scaled.select("vec_id", F.lit(0).alias("cluster"), F.lit(1).alias("clusters"))
    return models[best].transform(scaled).select("vec_id", F.col("prediction").alias("cluster"), F.lit(best).alias("clusters"))


@query("ss_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    from ..streaming.streams import arriving_files, drain, windowed_counts

    events = table(spark, sf, "events")
    stream = arriving_files(spark, f"{sf}/events.parquet*", events.schema)
    out = drain(windowed_counts(stream, "ts", "event_type", "1 hour"), "complete")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


STATUS = "CASE event_type WHEN 'click' THEN 'reserved' WHEN 'error' THEN 'abandoned' WHEN 'purchase' THEN 'completed' ELSE event_type END"
RESERVED_SQL = f"""WITH l AS (SELECT user_id, list_sort(list({{'ts': ts, 'status': {STATUS}}})) AS log FROM events GROUP BY 1),
    f AS (SELECT user_id, list_reduce(list_prepend({{'ts': TIMESTAMP '1970-01-01', 'status': 'free'}}, log), lambda a, x:
        CASE WHEN a.status IN ('completed', 'skipped') THEN a
             WHEN x.status = 'reserved' AND (a.status = 'free' OR x.ts - a.ts > INTERVAL 24 HOUR) THEN x
             WHEN x.status IN ('completed', 'skipped') THEN x
             WHEN x.status = 'abandoned' THEN {{'ts': x.ts, 'status': 'free'}}
             WHEN a.status = 'reserved' AND x.ts - a.ts > INTERVAL 24 HOUR THEN {{'ts': a.ts, 'status': 'free'}}
             ELSE a END) AS s FROM l)
    SELECT user_id::VARCHAR AS path, CASE WHEN s.status = 'reserved' AND s.ts + INTERVAL 24 HOUR < (SELECT max(ts) - INTERVAL 1 HOUR FROM events) THEN 'free' ELSE s.status END AS status FROM f"""


@query("ss04_reservations", RESERVED_SQL)
def _(spark, sf):
    from ..streaming.streams import arriving_files, drain, reservations

    events = table(spark, sf, "events")
    stream = arriving_files(spark, f"{sf}/events.parquet*", events.schema)
    log = stream.selectExpr("CAST(user_id AS STRING) AS path", f"{STATUS} AS status", "CAST(ts AS TIMESTAMP) AS ts")
    return drain(reservations(log), "update", ["path"])


@query("ss05_resume", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    """A stream drained twice into one folder: the second run finds nothing left to do."""
    from ..streaming.streams import arriving_files, drain, shared_folder

    schema, folder = table(spark, sf, "events").schema, shared_folder(spark, "resumed")
    for _ in range(2):
        out = drain(arriving_files(spark, f"{sf}/events.parquet*", schema).select("event_id", "event_type"), folder=folder)
    return out


@query("ss06_saved_once", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    """Events of which every one arrives twice, saved once each."""
    from ..streaming.streams import arriving_files, drain, saved_once

    stream = arriving_files(spark, f"{sf}/events.parquet*", table(spark, sf, "events").schema)
    twice = stream.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    return drain(saved_once(twice, ["event_id"], "ts").select("event_id", "event_type"))


@query("ss07_skip_existing", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS run FROM documents")
def _(spark, sf):
    """A second run over all documents does only what the first one left."""
    from ..operators.joins import worklist
    from ..operators.tables import stored

    docs = table(spark, sf, "documents").select("doc_id")
    done = stored(docs.where("doc_id % 3 = 0").withColumn("run", F.lit(1)), "outputs")
    return done.unionByName(worklist(docs, done, ["doc_id"]).withColumn("run", F.lit(2)))


query("p1_master", archive.MASTER_SQL)(archive.master_from_events)
query("flagship", archive.MASTER_SQL)(archive.master_from_events)
query("p2_availability", archive.AVAILABILITY_SQL)(archive.availability_from_events)
