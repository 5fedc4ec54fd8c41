"""Queries of sources, sinks, manifests, defaults and choices that keep something between two steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggs as A
from ..operators import sampling as S
from ..operators import windows as W
from ..sources import files as FS
from ..streaming.streams import shared_folder
from .registry import query, table

_TRACE = ("concat('d', l_suppkey % 7) AS directory", "l_orderkey AS picture", "l_linenumber AS number", "l_quantity AS x", "l_extendedprice AS y")


@query("sc13_traces", f"SELECT {', '.join(_TRACE)} FROM lineitem")
def _(spark, sf):
    """Points written by directory and read back."""
    points = table(spark, sf, "lineitem").selectExpr(*_TRACE)
    path = shared_folder(spark, "traces")
    FS.write_traces(points, path)
    return FS.read_traces(spark, path, points.schema)


@query("sc14_some_traces", f"SELECT * FROM (SELECT {', '.join(_TRACE)} FROM lineitem) WHERE directory IN ('d1', 'd4')")
def _(spark, sf):
    points = table(spark, sf, "lineitem").selectExpr(*_TRACE)
    path = shared_folder(spark, "traces")
    FS.write_traces(points, path)
    return FS.read_traces(spark, path, points.schema, ["d1", "d4"])


@query("sc18_append_once", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    """Two overlapping parts appended one after the other."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = shared_folder(spark, "appended")
    FS.append_once(c.where("c_custkey % 3 <> 0"), ["c_custkey"], path)
    return FS.append_once(c.where("c_custkey % 2 = 0 OR c_custkey % 3 = 0"), ["c_custkey"], path).unionByName(c.where("FALSE"))


@query("sc07_scaled_depth", """WITH p AS (SELECT l_suppkey AS k, l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS BIGINT) AS v FROM lineitem), e AS (SELECT k, min(v) AS lo, max(v) AS hi FROM p GROUP BY 1)
    SELECT k, l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN hi > lo THEN floor((v - lo) * 255 / (hi - lo)) ELSE 0 END AS INT) AS v FROM p JOIN e USING (k)""")
def _(spark, sf):
    p = table(spark, sf, "lineitem").selectExpr("l_suppkey AS k", "l_orderkey", "l_linenumber", "l_partkey", "floor(l_extendedprice) AS v")
    return FS.scaled_to_bytes(p, "k", "v")


@query("ag29_by_label", "SELECT toxic, count(*) AS n, min(n_chars) AS min_n_chars, max(n_chars) AS max_n_chars, round(avg(n_chars), 6) AS mean_n_chars FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return A.by_label(d, "toxic", ["n_chars"]).withColumn("mean_n_chars", F.round("mean_n_chars", 6))


_PLACES = "SELECT l_linenumber AS label, CAST(l_linenumber * 40 + l_quantity AS DOUBLE) AS place FROM lineitem"


@query("ag35_usual_values", f"""WITH m AS ({_PLACES}), f AS (SELECT label, avg(place) AS mean FROM m GROUP BY 1), g AS (SELECT (max(mean) - min(mean)) / greatest(count(*) - 1, 1) AS gap FROM f)
    SELECT label, round(avg(place), 6) AS usual, count(*) AS n FROM m JOIN f USING (label), g WHERE abs(place - mean) <= 0.5 * gap GROUP BY 1""")
def _(spark, sf):
    m = table(spark, sf, "lineitem").selectExpr("l_linenumber AS label", "CAST(l_linenumber * 40 + l_quantity AS DOUBLE) AS place")
    return A.usual_values(m, "label", "place", 0.5).withColumn("usual", F.round("usual", 6))


@query("so05_split_recombine", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'loss' WHEN l_quantity > 25 THEN 'num' ELSE 'dot' END AS class, CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_quantity > 25 THEN l_extendedprice ELSE l_extendedprice * 2 END AS value FROM lineitem")
def _(spark, sf):
    """Classes treated each in its way and put together again."""
    x = table(spark, sf, "lineitem").withColumn("class", F.when(F.col("l_returnflag") == "R", "loss").when(F.col("l_quantity") > 25, "num").otherwise("dot"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "class"]
    branches = (x.where("class = 'num'").select(*keys, F.col("l_extendedprice").alias("value")), x.where("class = 'dot'").select(*keys, (F.col("l_extendedprice") * 2).alias("value")), x.where("class = 'loss'").select(*keys))
    return S.union_by_name(*branches)


_FIELDS = "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'Kilometres ' WHEN 1 THEN 'seconds' WHEN 2 THEN 'furlongs' WHEN 3 THEN 'none' END AS unit, CASE p_size % 7 WHEN 0 THEN 'Integer' WHEN 1 THEN 'string' WHEN 2 THEN 'timestamp_ntz' WHEN 3 THEN 'double' WHEN 4 THEN 'blob' WHEN 5 THEN 'dates' END AS type FROM part"


@query("dt01_declared_fields", f"""WITH f AS ({_FIELDS}) SELECT p_partkey, CASE WHEN unit IN ('Kilometres ', 'seconds', 'none') THEN trim(lower(unit)) ELSE 'none' END AS unit,
    CASE type WHEN 'Integer' THEN 'number' WHEN 'timestamp_ntz' THEN 'time' WHEN 'double' THEN 'number' WHEN 'dates' THEN 'time' ELSE 'text' END AS family,
    CASE type WHEN 'Integer' THEN 'bigint' WHEN 'timestamp_ntz' THEN type WHEN 'double' THEN type WHEN 'dates' THEN 'timestamp_ntz' ELSE 'string' END AS type FROM f""")
def _(spark, sf):
    kinds = "CASE p_size % 7 WHEN 0 THEN 'Integer' WHEN 1 THEN 'string' WHEN 2 THEN 'timestamp_ntz' WHEN 3 THEN 'double' WHEN 4 THEN 'blob' WHEN 5 THEN 'dates' END AS type"
    units = "CASE p_size % 5 WHEN 0 THEN 'Kilometres ' WHEN 1 THEN 'seconds' WHEN 2 THEN 'furlongs' WHEN 3 THEN 'none' END AS unit"
    return A.declared(table(spark, sf, "part").selectExpr("p_partkey", units, kinds))


@query("dt07_manifests", "SELECT o_orderkey, o_orderstatus AS split, 'splits' AS manifest FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, 'overall' FROM orders")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("split"))
    path = shared_folder(spark, "manifests")
    S.write_manifests(rows, "split", ["o_orderkey"], path)
    read = [spark.read.schema(rows.schema).parquet(f"{path}/{name}").select("o_orderkey", "split", F.lit(name).alias("manifest")) for name in ("splits", "overall")]
    return read[0].unionByName(read[1])


@query("dt18_split_sample", "SELECT o_orderkey, split, CAST(row_number() OVER (PARTITION BY split ORDER BY o_orderkey) - 1 AS INT) AS index FROM (SELECT o_orderkey, o_orderstatus AS split FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('0:' || o_orderkey), o_orderkey) <= 50)")
def _(spark, sf):
    """Fifty rows of each split with their index in it."""
    from pyspark.sql import Window

    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("split"))
    some = S.split_sample(rows, "split", "o_orderkey", 50)
    return some.withColumn("index", F.row_number().over(Window.partitionBy("split").orderBy("o_orderkey")) - 1)


@query("im27_resampled", """WITH p AS (SELECT l_partkey AS k, l_quantity AS x, min(l_extendedprice) AS y FROM lineitem GROUP BY 1, 2), g AS (SELECT unnest(range(0, 51, 3))::DOUBLE AS g)
    SELECT DISTINCT k, x, y FROM (SELECT k, x, y, g FROM p, g QUALIFY row_number() OVER (PARTITION BY k, g ORDER BY abs(x - g), x) = 1)""")
def _(spark, sf):
    p = table(spark, sf, "lineitem").selectExpr("l_partkey AS k", "l_quantity AS x", "l_extendedprice AS y")
    return W.resampled(p, "k", "x", "y", 0.0, 48.0, 3.0)


@query("sc08_delimited", "SELECT c_custkey, c_name || ' é' AS c_name, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal FROM customer")
def _(spark, sf):
    """Many delimited files in a western encoding, with a declared schema and a text for null."""
    c = table(spark, sf, "customer").selectExpr("c_custkey", "c_name || ' é' AS c_name", "IF(c_custkey % 7 <> 0, c_acctbal, NULL) AS c_acctbal")
    path = shared_folder(spark, "delimited")
    c.repartition(5).write.option("header", True).option("nullValue", "NA").option("encoding", "ISO-8859-1").csv(path)
    return FS.read_table(spark, path, c.schema, "cp1252", "NA").drop("source_file")


@query("sc09_spaced", "SELECT s_suppkey::VARCHAR AS id, s_nationkey::VARCHAR AS nation FROM supplier")
def _(spark, sf):
    """Files with a preamble and a header over fields that spaces part."""
    rows = table(spark, sf, "supplier").selectExpr("concat(s_suppkey, '   ', s_nationkey) AS value")
    path = shared_folder(spark, "spaced")
    preamble = rows.limit(1).selectExpr("explode(array('these lines say where it is from', 'ID NATION', '')) AS value")
    preamble.unionByName(rows).write.text(path)
    return FS.read_spaced(spark, path, ["id", "nation"])
