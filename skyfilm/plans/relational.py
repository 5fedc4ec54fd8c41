"""Queries of relational operators over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import parse as P
from ..functions import timeq as Q
from ..operators import aggs as A
from ..operators import clean as C
from ..operators import joins as J
from ..operators import quantiles as QU
from ..operators import sampling as S
from ..operators import windows as W
from ..sources import files as FS
from .registry import query, table

# texts that read the same in Spark and DuckDB: records built from events, some of them damaged
CODE = "concat('10', lpad(cast(user_id % 100 as string), 2, '0'), lpad(cast(year(ts) % 100 as string), 2, '0'), lpad(cast(dayofyear(ts) as string), 3, '0'), lpad(cast(hour(ts) as string), 2, '0'), lpad(cast(minute(ts) as string), 2, '0'), lpad(cast(second(ts) as string), 2, '0'))"
READ = f"CASE WHEN event_id % 17 = 0 THEN concat('A', substring({CODE}, 2, 14)) WHEN event_id % 19 = 0 THEN substring({CODE}, 1, 14) WHEN event_id % 23 = 0 THEN concat(substring({CODE}, 1, 2), '.', substring({CODE}, 3, 13)) WHEN event_id % 29 = 0 THEN concat(substring({CODE}, 1, 2), '.', substring({CODE}, 3, 12)) ELSE {CODE} END"
TIMES = (
    "CAST(1960 + event_id % 12 AS INT) AS year",
    "CAST((event_id * 7) % 368 AS INT) AS day",
    "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 25 AS INT) END AS hour",
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 61 AS INT) END AS minute",
    "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST((event_id + user_id) % 62 AS INT) END AS second",
)
TIME = ", ".join(TIMES)
BOXES = (
    "CAST(l_partkey % 40 AS INT) AS x1",
    "CAST(l_suppkey % 30 AS INT) AS y1",
    "CAST(l_partkey % 40 + l_quantity AS INT) AS x2",
    "CAST(l_suppkey % 30 + l_linenumber * 5 AS INT) AS y2",
)
BOX = ", ".join(BOXES)
MD5_ORDER = "md5(concat('0:', cast({k} as string)))"


def codes(spark, sf):
    return table(spark, sf, "events").selectExpr("event_id", f"{READ} AS code")


def times(spark, sf):
    return table(spark, sf, "events").selectExpr("event_id", *TIMES)


def document_files(spark, sf):
    """Documents as files of a scan tree: directory by source, subdirectory by language."""
    kind = "CASE doc_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.PNG' ELSE '.txt' END"
    return table(spark, sf, "documents").selectExpr(f"concat_ws('/', 'archive', source, lang, concat(doc_id, {kind})) AS path")


@query("sc02_inventory", "SELECT source AS directory, lang AS subdirectory, count(*) AS images, concat_ws('_', source, lang) AS subdir_id FROM documents GROUP BY source, lang")
def _(spark, sf):
    return FS.inventory(FS.located(document_files(spark, sf)))


@query("sc03_count_by_extension", "SELECT source AS directory, count(*) FILTER (doc_id % 3 < 2)::BIGINT AS n, count(*) AS n_all FROM documents GROUP BY source")
def _(spark, sf):
    files = FS.located(document_files(spark, sf))
    return files.groupBy("directory").agg(F.count_if(FS.has_extension(F.col("path"), ".png")).alias("n"), F.count("*").alias("n_all"))


@query("sc04_prune_folders", "SELECT url FROM pages WHERE NOT list_has_any(string_split(url, '/'), ['de', 'fr'])")
def _(spark, sf):
    return FS.pruned(table(spark, sf, "pages").select("url", F.col("url").alias("path")), ["de", "fr"])[0].select("url")


@query("sc04_skipped_folders", "SELECT DISTINCT regexp_replace(url, '/[^/]*$', '') AS folder FROM pages WHERE list_has_any(string_split(url, '/'), ['de', 'fr'])")
def _(spark, sf):
    return FS.pruned(table(spark, sf, "pages").select(F.col("url").alias("path")), ["de", "fr"])[1]


@query("sc05_keyword_filter", "SELECT page_id, contains(lower(url), 'blog') OR contains(lower(url), 'www') AS any_of, contains(lower(url), 'example') AND contains(lower(url), 'en') AS all_of FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", FS.names_with(F.col("url"), ["blog", "WWW"]).alias("any_of"), FS.names_with(F.col("url"), ["Example", "en"], every=True).alias("all_of"))


@query("sc06_directory_counts", "SELECT source AS directory, count(DISTINCT lang) AS subdirectories, count(*) AS images FROM documents GROUP BY source")
def _(spark, sf):
    return FS.directory_counts(FS.located(document_files(spark, sf)))


@query("sc22_archive_by_keyword", "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'ring') THEN 'archived' ELSE 'kept' END AS place FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.when(FS.names_with(F.col("p_name"), ["Red", "ring"]), "archived").otherwise("kept").alias("place"))


@query("sc25_exclusions", "SELECT page_id FROM pages p WHERE EXISTS (SELECT 1 FROM (VALUES ('http://tionsh.example.net'), ('http://m.ththst.example.org/en')) x(e) WHERE p.url = e OR starts_with(p.url, e || '/'))")
def _(spark, sf):
    out = spark.createDataFrame([("http://tionsh.example.net",), ("http://m.ththst.example.org/en",)], "prefix string")
    return J.under_any(table(spark, sf, "pages").select("page_id", "url"), out, "url", "prefix").select("page_id")


@query("pf01_select_rename", "SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS total, concat_ws('_', o_orderstatus, cast(o_orderkey AS VARCHAR)) AS key, concat(o_orderstatus, '/', o_orderpriority) AS path, 'archive' AS origin FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "id", "o_custkey": "customer", "o_totalprice": "total"})
    return o.withColumns({"key": F.concat_ws("_", "o_orderstatus", F.col("id").cast("string")), "path": F.concat("o_orderstatus", F.lit("/"), "o_orderpriority"), "origin": F.lit("archive")}).drop("o_orderdate", "o_orderstatus", "o_orderpriority", "no_such_column")


@query("pf05_row_position", "SELECT n_nationkey, row_number() OVER (ORDER BY n_name, n_nationkey) - 1 AS position FROM nation")
def _(spark, sf):
    from pyspark.sql import Window

    # a dimension of fixed size; facts get ids from keys, not from one global order
    return table(spark, sf, "nation").select("n_nationkey", (F.row_number().over(Window.orderBy("n_name", "n_nationkey")).cast("long") - 1).alias("position"))


@query("pf07_membership", "SELECT o_orderkey, o_orderstatus IN ('F', 'O') AS listed, o_orderpriority NOT IN ('1-URGENT', '5-LOW') AS unlisted FROM orders WHERE o_totalprice BETWEEN 1000 AND 400000 AND o_orderdate IS NOT NULL")
def _(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_totalprice").between(1000, 400000) & F.col("o_orderdate").isNotNull())
    return o.select("o_orderkey", F.col("o_orderstatus").isin("F", "O").alias("listed"), (~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).alias("unlisted"))


SAT = "CASE event_id % 5 WHEN 0 THEN 'SAT A' WHEN 1 THEN 'sat-a' WHEN 2 THEN 'SAT - A x' WHEN 3 THEN 'SAT B' END"


@query("pf08_satellite_router", f"SELECT event_id, CASE WHEN coalesce(regexp_matches({SAT}, '(?i)SAT ?-? ?A'), false) THEN 1 ELSE 2 END AS satellite, CASE WHEN coalesce(regexp_matches({SAT}, '(?i)SAT A|SAT - A'), false) THEN 1 ELSE 2 END AS satellite_legacy FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", f"{SAT} AS label")
    return e.select("event_id", C.satellite_of(F.col("label"), "SAT").alias("satellite"), C.satellite_of(F.col("label"), "SAT", legacy=True).alias("satellite_legacy"))


@query("pf10_any_null", f"SELECT event_id, hour IS NULL OR minute IS NULL OR second IS NULL AS is_loss FROM (SELECT event_id, {TIME} FROM events)")
def _(spark, sf):
    return times(spark, sf).select("event_id", C.any_null(["hour", "minute", "second"]).alias("is_loss"))


def _clamp_sql(kind):
    cols = {"year": "year", "day_of_year": "day", "hour": "hour", "minute": "minute", "second": "second"}
    return ", ".join(f"CASE WHEN {c} BETWEEN {a} AND {b} THEN {c} END AS {k}" for (k, (a, b)), c in zip(C.TIME_DOMAINS[kind].items(), cols.values(), strict=True))


for _kind in ("strict", "rolling"):

    @query(f"pf11_clamp_{_kind}", f"SELECT event_id, {_clamp_sql(_kind)} FROM (SELECT event_id, {TIME} FROM events)")
    def _(spark, sf, kind=_kind):
        return C.clamp_times(times(spark, sf).withColumnRenamed("day", "day_of_year"), kind)


TAGS = "CASE WHEN year < 1969 THEN 'Year' WHEN day > 365 THEN 'Day>365' WHEN day < 1 THEN 'Day<1' WHEN hour >= 24 THEN 'Hour' WHEN minute >= 60 THEN 'Minute' WHEN second > 60 THEN 'Second' END"


@query("pf12_first_tag", f"SELECT event_id, {TAGS} AS outlier, CASE WHEN {TAGS} = 'Second' THEN 0 ELSE second END AS second FROM (SELECT event_id, {TIME} FROM events)")
def _(spark, sf):
    t = times(spark, sf).withColumn("outlier", C.time_faults(*[F.col(c) for c in ("year", "day", "hour", "minute", "second")]))
    return t.select("event_id", "outlier", F.when(F.col("outlier") == "Second", 0).otherwise(F.col("second")).alias("second"))


@query("pf13_all_tags", "SELECT l_orderkey, l_linenumber, l_partkey, concat(CASE WHEN d <= 12 THEN 'few digits;' ELSE '' END, CASE WHEN d >= 18 THEN 'many digits;' ELSE '' END, CASE WHEN a < 1.2 THEN 'narrow;' ELSE '' END, CASE WHEN a >= 3 THEN 'wide;' ELSE '' END) AS problems, d < 10 AND a >= 2.4 AS out_of_phase FROM (SELECT *, l_quantity AS d, 1 + l_discount * 30 AS a FROM lineitem)")
def _(spark, sf):
    x = table(spark, sf, "lineitem").withColumns({"d": F.col("l_quantity"), "a": 1 + F.col("l_discount") * 30})
    return x.select("l_orderkey", "l_linenumber", "l_partkey", C.problems(F.col("d"), F.col("a")).alias("problems"), C.out_of_phase(F.col("d"), F.col("a"), F.lit(1.0)).alias("out_of_phase"))


CLS = "CASE WHEN l_returnflag = 'A' THEN 'num' WHEN l_returnflag = 'R' THEN 'dot' WHEN l_linestatus = 'F' AND l_quantity > 45 THEN 'num2' ELSE 'outlier' END"


@query("pf14_majority", f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {CLS} AS cls FROM lineitem),
    w AS (SELECT *, sum((cls = 'num')::INT) OVER p AS n, sum((cls = 'dot')::INT) OVER p AS d, sum((cls = 'num2')::INT) OVER p AS m FROM r WINDOW p AS (PARTITION BY l_orderkey)),
    x AS (SELECT *, CASE WHEN m > 0 THEN cls IN ('num', 'dot') ELSE (cls = 'dot' AND n > d) OR (cls = 'num' AND d > n) END AS loses FROM w)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN NOT loses THEN l_quantity END AS l_quantity, CASE WHEN loses THEN 'loss' ELSE cls END AS cls FROM x""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", f"{CLS} AS cls")
    return C.majority_class(rows, "l_orderkey", "cls", ["l_quantity"])


NAMES = {"AFRICA": "Afrique", "AMERICA": "Amérique", "NATION_0": "Première", "NATION_1": "Deuxième"}


@query("pf17_replace_map", "SELECT n_nationkey, CASE n_name WHEN 'NATION_0' THEN 'Première' WHEN 'NATION_1' THEN 'Deuxième' ELSE n_name END AS n_name, CASE r_name WHEN 'AFRICA' THEN 'Afrique' WHEN 'AMERICA' THEN 'Amérique' ELSE r_name END AS r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return C.replace_everywhere(n.select("n_nationkey", "n_name", "r_name"), NAMES)


@query("pf18_tidy_text", "SELECT p_partkey, trim(regexp_replace(concat(' ', replace(p_name, ' ', chr(160)), 'Â', chr(160)), 'Â?' || chr(160), ' ', 'g')) AS name FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", C.tidy_text(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit(" ")), F.lit("Â "))).alias("name"))


@query("pf19_reasons", "SELECT event_id, coalesce(CASE WHEN event_type = 'error' THEN 'failed_' || event_id % 10 END, CASE WHEN value > 20 THEN 'excluded' END, 'Model Predicted') AS reason FROM events")
def _(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.coalesce(F.when(F.col("event_type") == "error", F.concat(F.lit("failed_"), (F.col("event_id") % 10).cast("string"))), F.when(F.col("value") > 20, "excluded"), F.lit("Model Predicted")).alias("reason"))


@query("pf20_outcome", f"""WITH c AS (SELECT event_id, {READ} AS code FROM events), s AS (SELECT event_id, code, regexp_replace(code, '[^a-zA-Z0-9]', '', 'g') AS k FROM c),
    r AS (SELECT event_id, CASE WHEN regexp_matches(code, '[a-zA-Z]') THEN 'ocr_contains_letters' WHEN length(k) <> 15 THEN CASE WHEN k = code THEN 'invalid_detected_length_' || length(k) ELSE 'invalid_sanitized_length_' || length(k) END END AS reason FROM s)
    SELECT event_id, reason, CASE regexp_replace(reason, '_[0-9]+$', '') WHEN 'ocr_contains_letters' THEN 'letters' WHEN 'invalid_detected_length' THEN 'length' ELSE 'other' END AS outcome FROM r""")
def _(spark, sf):
    c = codes(spark, sf).withColumn("reason", P.rejection_reason(F.col("code")))
    return c.select("event_id", "reason", C.outcome(F.col("reason"), {"ocr_contains_letters": "letters", "invalid_detected_length": "length"}, "other").alias("outcome"))


@query("pf21_overwrite", "SELECT event_id, CASE WHEN value > 10 THEN 20 END AS flag FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.when(F.when(F.col("value") > 10, F.col("value")).isNotNull(), 20).alias("flag"))


@query("pf23_inferred_year", f"SELECT event_id, CASE WHEN day > 271 AND day < 366 THEN 1962 WHEN day > 0 AND day <= 271 THEN 1963 END AS year FROM (SELECT event_id, {TIME} FROM events)")
def _(spark, sf):
    return times(spark, sf).select("event_id", Q.inferred_year(F.col("day")).alias("year"))


@query("pf24_repaired_year", "SELECT event_id, CAST(regexp_replace(lpad(cast(event_id % 100 AS VARCHAR), 2, '0'), '^1', '7') AS INT) + 1900 AS year FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", Q.repaired_year(F.lpad((F.col("event_id") % 100).cast("string"), 2, "0")).alias("year"))


@query("pf25_unit_scale", "SELECT event_id, round(CASE user_id % 3 WHEN 1 THEN value * 217.4 WHEN 2 THEN value * 220.0 ELSE 0.0 END, 4) AS km FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(C.by_code(F.col("user_id") % 3, F.col("value"), {1: 217.4, 2: 220.0}), 4).alias("km"))


@query("pf26_flip_list", "SELECT page_id, contains(url, '/de/') OR contains(url, '/es/') AS flipped FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.exists(F.array(F.lit("/de/"), F.lit("/es/")), lambda p: F.contains(F.col("url"), p)).alias("flipped"))


ERA = "CASE WHEN y <= 1963 THEN 'early' WHEN y = 1964 THEN 'middle' ELSE 'late' END"


@query("jn02_era_join", f"""WITH o AS (SELECT o_orderkey, CAST(o_custkey % 25 AS INT) AS k, CAST(1962 + o_orderkey % 5 AS INT) AS y FROM orders),
    l AS (SELECT 'early' AS era, n_nationkey AS k, 'a ' || n_name AS name FROM nation UNION ALL SELECT 'middle', n_nationkey, 'b ' || n_name FROM nation WHERE n_regionkey > 0 UNION ALL SELECT 'late', n_nationkey, 'c ' || n_name FROM nation WHERE n_regionkey < 3)
    SELECT o_orderkey, y, e.era, o.k, name FROM (SELECT *, {ERA} AS era FROM o) o JOIN l e ON e.era = o.era AND e.k = o.k""")
def _(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_custkey % 25 AS INT) AS k", "CAST(1962 + o_orderkey % 5 AS INT) AS y")
    n = table(spark, sf, "nation")
    lists = S.union_by_name(*[x.select(F.lit(e).alias("era"), F.col("n_nationkey").alias("k"), F.concat(F.lit(p), "n_name").alias("name")) for e, p, x in (("early", "a ", n), ("middle", "b ", n.where("n_regionkey > 0")), ("late", "c ", n.where("n_regionkey < 3")))])
    return J.era_join(o, lists, "y", "k").select("o_orderkey", "y", "era", "k", "name")


@query("jn04_left_two_keys", "SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("jn05_inner_named_keys", "SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "s_name", "n_name", "r_name")


@query("jn07_scd2", """WITH h AS (SELECT l_suppkey AS k, l_shipdate AS d, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2), o AS (SELECT o_orderkey, o_custkey % 100 AS k, o_orderdate FROM orders)
    SELECT o_orderkey, o.k, o_orderdate, h.d AS start_date_hit, h.price FROM o ASOF LEFT JOIN h ON o.k = h.k AND o.o_orderdate >= h.d""")
def _(spark, sf):
    h = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").alias("start_date"), F.col("l_extendedprice").alias("price"))
    o = table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey % 100 AS k", "o_orderdate")
    return J.asof_join(o, h, ["k"], "o_orderdate", "start_date", ["price"])


@query("wn05_intervals", "SELECT p, d, lead(d) OVER (PARTITION BY p ORDER BY d) AS valid_to FROM (SELECT DISTINCT l_partkey AS p, l_shipdate AS d FROM lineitem)")
def _(spark, sf):
    return J.scd2_intervals(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p"), F.col("l_shipdate").alias("d")).distinct(), "p", "d")


@query("jn08_nearest_asof", """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), e AS (SELECT user_id, ts, max(event_id) AS error_id FROM events WHERE event_type = 'error' GROUP BY 1, 2),
    b AS (SELECT p.event_id, p.user_id, p.ts, e.ts AS t0, e.error_id AS e0 FROM p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.ts >= e.ts),
    f AS (SELECT p.event_id, e.ts AS t1, e.error_id AS e1 FROM p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.ts <= e.ts)
    SELECT event_id, user_id, ts, CASE WHEN later THEN t1 ELSE t0 END AS error_ts_hit, CASE WHEN later THEN e1 ELSE e0 END AS error_id
    FROM (SELECT *, coalesce(epoch_us(t1) - epoch_us(ts) < epoch_us(ts) - epoch_us(t0), t0 IS NULL) AS later FROM b JOIN f USING (event_id))""")
def _(spark, sf):
    e = table(spark, sf, "events")
    errors = e.where("event_type = 'error'").select("user_id", F.col("ts").alias("error_ts"), F.col("event_id").alias("error_id"))
    return J.nearest_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), errors, ["user_id"], "ts", "error_ts", ["error_id"])


@query("jn12_worklist_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def _(spark, sf):
    return J.worklist(table(spark, sf, "customer"), table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey", "c_name")


@query("jn13_intersect_except", "SELECT k, 'both' AS side FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT k, 'left' FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)")
def _(spark, sf):
    o, c = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return o.intersect(c).withColumn("side", F.lit("both")).union(c.subtract(o).withColumn("side", F.lit("left")))


@query("jn15_lookup_default", "SELECT o_orderkey, coalesce(s_name, '') AS s_name, coalesce(s_acctbal, 0.0) AS s_acctbal FROM orders LEFT JOIN supplier ON o_custkey % 150 = s_suppkey")
def _(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey % 150 AS s_suppkey")
    return J.lookup(o, table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), "s_suppkey", {"s_name": "", "s_acctbal": 0.0}).drop("s_suppkey")


@query("jn16_lookup_lastwins", "SELECT s_nationkey, max_by(s_name, s_suppkey) AS s_name, max(s_suppkey) AS s_suppkey FROM supplier GROUP BY s_nationkey")
def _(spark, sf):
    s = table(spark, sf, "supplier").select("s_nationkey", "s_name", "s_suppkey")
    return J.last_wins(s, "s_nationkey", "s_suppkey")


@query("jn17_update", """WITH c AS (SELECT doc_id, max_by(text_label, item) AS lang FROM (SELECT conv_id * 3 AS doc_id, role AS text_label, turn AS item FROM conversations) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(c.lang, d.lang) AS lang FROM documents d LEFT JOIN c USING (doc_id)""")
def _(spark, sf):
    c = table(spark, sf, "conversations").selectExpr("conv_id * 3 AS doc_id", "role AS lang", "turn")
    return J.update_join(table(spark, sf, "documents").select("doc_id", "lang"), c, ["doc_id"], ["lang"], "turn")[0]


@query("jn17_not_found", "SELECT conv_id * 3 AS doc_id, role AS lang, turn FROM conversations WHERE conv_id * 3 NOT IN (SELECT doc_id FROM documents)")
def _(spark, sf):
    c = table(spark, sf, "conversations").selectExpr("conv_id * 3 AS doc_id", "role AS lang", "turn")
    return J.update_join(table(spark, sf, "documents").select("doc_id", "lang"), c, ["doc_id"], ["lang"], "turn")[1]


@query("jn20_append_new", "SELECT doc_id, quality FROM labels UNION ALL SELECT doc_id, -1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    old = table(spark, sf, "labels").select("doc_id", "quality")
    new = table(spark, sf, "documents").select("doc_id", F.lit(-1).alias("quality"))
    return S.union_by_name(old, J.worklist(new, old, ["doc_id"]))


@query("jn22_contains", "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') THEN 'R' WHEN contains(lower(p_name), 'small') THEN 'S' WHEN contains(lower(p_name), 'ring') THEN 'G' END AS found FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", J.first_contained(F.col("p_name"), [("Red", "R"), ("small", "S"), ("ring", "G")]).alias("found"))


_TEXTS = "SELECT p_partkey, concat_ws(' ', p_brand, p_type, p_name, 'of', lower(p_type)) AS text FROM part"


@query("pf22_contained_names", f"""WITH t AS ({_TEXTS}), n AS (SELECT name, min(p) AS p FROM (SELECT p_name AS name, p_partkey AS p FROM part WHERE p_partkey < 60 UNION ALL SELECT string_split(p_name, ' ')[2], p_partkey FROM part UNION ALL SELECT p_type, p_partkey + 1000000 FROM part) GROUP BY 1)
    SELECT p_partkey, arg_max(name, len(string_split(name, ' ')) * 100000000 - p) AS name FROM t JOIN n ON contains(' ' || lower(text) || ' ', ' ' || lower(name) || ' ') GROUP BY 1""")
def _(spark, sf):
    """The longest of many names that each text holds; Brand#7 is two words."""
    part = table(spark, sf, "part")
    names = part.where("p_partkey < 60").selectExpr("p_name AS name", "p_partkey AS p").union(part.selectExpr("split(p_name, ' ')[1]", "p_partkey")).union(part.selectExpr("p_type", "p_partkey + 1000000"))
    names = names.groupBy("name").agg(F.min("p").alias("p"))
    texts = part.selectExpr("p_partkey", "concat_ws(' ', p_brand, p_type, p_name, 'of', lower(p_type)) AS text")
    return J.contained_names(texts, "p_partkey", "text", names, "name", "p").select("p_partkey", "name")


@query("jn24_semi", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def _(spark, sf):
    n = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return table(spark, sf, "supplier").join(n, "s_nationkey", "left_semi").select("s_suppkey")


@query("ag01_roll_funnel", f"""WITH l AS (SELECT l_orderkey, {CLS} AS cls FROM lineitem), c AS (SELECT l_orderkey AS o_orderkey, count(*) AS processed, count(*) FILTER (cls = 'num') AS n_num, count(*) FILTER (cls = 'dot') AS n_dot, count(*) FILTER (cls = 'num2') AS n_num2, count(*) FILTER (cls = 'outlier') AS n_outlier FROM l GROUP BY 1),
    j AS (SELECT o.o_orderkey, CAST(o_custkey % 7 + 1 AS BIGINT) AS images, coalesce(processed, 0) AS processed, coalesce(n_num, 0) AS n_num, coalesce(n_dot, 0) AS n_dot, coalesce(n_num2, 0) AS n_num2, coalesce(n_outlier, 0) AS n_outlier FROM orders o LEFT JOIN c USING (o_orderkey))
    SELECT *, round(100.0::DOUBLE * processed / nullif(images, 0), 2) AS yield_pct, {', '.join(f'round(100.0::DOUBLE * n_{k} / nullif(processed, 0), 2) AS {k}_pct' for k in ('num', 'dot', 'num2', 'outlier'))} FROM j""")
def _(spark, sf):
    rolls = table(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_custkey % 7 + 1 AS BIGINT) AS images")
    results = table(spark, sf, "lineitem").selectExpr("l_orderkey AS o_orderkey", f"{CLS} AS cls")
    return A.roll_funnel(rolls, results, "o_orderkey", "images", "cls", ["num", "dot", "num2", "outlier"])


@query("ag03_value_counts", "SELECT l_returnflag, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM lineitem GROUP BY 1")
def _(spark, sf):
    return A.value_counts(table(spark, sf, "lineitem"), "l_returnflag", keep_null=True)


@query("ag05_group_means", "SELECT l_returnflag, count(l_tax) AS n, round(avg(l_quantity), 6) AS q, round(avg(l_discount), 6) AS d, round(median(l_extendedprice), 4) AS m, round(stddev_samp(l_quantity), 6) AS s, round(stddev_pop(l_quantity), 6) AS sp, max(l_quantity) - min(l_quantity) AS spread FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("l_tax").alias("n"), F.round(F.avg("l_quantity"), 6).alias("q"), F.round(F.avg("l_discount"), 6).alias("d"), F.round(F.median("l_extendedprice"), 4).alias("m"), F.round(F.stddev_samp("l_quantity"), 6).alias("s"), F.round(F.stddev_pop("l_quantity"), 6).alias("sp"), (F.max("l_quantity") - F.min("l_quantity")).alias("spread"))


@query("ag08_argmax_ties", "WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1), e AS (SELECT max(n) AS hi, min(n) AS lo FROM c) SELECT c_nationkey, n, CASE WHEN n = hi THEN 'max' ELSE 'min' END AS which FROM c, e WHERE n = hi OR n = lo")
def _(spark, sf):
    return A.argmax_ties(table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")), "n")


@query("ag09_idxmax", "WITH c AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2) SELECT c_mktsegment, arg_max(c_nationkey, n * 1000 - c_nationkey) AS most, arg_min(c_nationkey, n * 1000 + c_nationkey) AS least FROM c GROUP BY 1")
def _(spark, sf):
    c = table(spark, sf, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    return c.groupBy("c_mktsegment").agg(F.max_by("c_nationkey", F.struct("n", -F.col("c_nationkey"))).alias("most"), F.min_by("c_nationkey", F.struct("n", "c_nationkey")).alias("least"))


@query("ag10_distinct", "SELECT l_linestatus, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"))


@query("ag11_weighted_bits", "SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 6 WHEN 'error' THEN 15 ELSE 0 END AS digit FROM events")
def _(spark, sf):
    marks = F.create_map(F.lit("click"), F.array(F.lit(1)), F.lit("view"), F.array(F.lit(2), F.lit(4)), F.lit("error"), F.array(F.lit(1), F.lit(2), F.lit(4), F.lit(8)))
    return table(spark, sf, "events").select("event_id", P.weighted_bits(marks, F.col("event_type")).alias("digit"))


@query("ag12_histogram", "SELECT CAST(least(floor((l_quantity - 0) / 5.0), 9) AS INT) AS bin, count(*) AS n, least(floor(l_quantity / 5.0), 9) * 5.0 AS left_edge FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 GROUP BY ALL")
def _(spark, sf):
    return A.histogram(table(spark, sf, "lineitem"), "l_quantity", 0.0, 50.0, 10)


@query("ag13_hist_trim", """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events), k AS (SELECT value FROM events, s WHERE abs(value - m) <= 3 * d), e AS (SELECT min(value) AS lo, max(value) AS hi FROM k)
    SELECT CAST(least(floor((value - lo) * 50 / (hi - lo)), 49) AS INT) AS bin, count(*) AS n FROM k, e GROUP BY 1""")
def _(spark, sf):
    return A.trimmed_histogram(table(spark, sf, "events"), "value", 50)


@query("ag15_ci", "WITH g AS (SELECT lang, sum(quality)::BIGINT AS ones, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1) SELECT lang, ones, n, round(ones / n, 6) AS p, round(sqrt((ones / n) * (1 - ones / n) / n), 6) AS se, round(1.96 * sqrt((ones / n) * (1 - ones / n) / n), 6) AS ci95 FROM g")
def _(spark, sf):
    g = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").groupBy("lang").agg(F.sum("quality").alias("ones"), F.count("*").alias("n"))
    return g.withColumns({k: F.round(v, 6) for k, v in A.proportion(F.col("ones"), F.col("n")).items()})


@query("ag16_pooled", "WITH g AS (SELECT sum(quality)::BIGINT AS ones, count(*) AS n FROM labels) SELECT ones, n, round(ones / n, 6) AS p, round(sqrt((ones / n) * (1 - ones / n) / n), 6) AS se, round(1.96 * sqrt((ones / n) * (1 - ones / n) / n), 6) AS ci95, round(1.96 + sqrt((ones / n) * (1 - ones / n) / n), 6) AS ci95_additive FROM g")
def _(spark, sf):
    g = table(spark, sf, "labels").groupBy("toxic").agg(F.sum("quality").alias("ones"), F.count("*").alias("n"))
    out = A.pooled(g, "ones", "n")
    return out.select("ones", "n", *[F.round(c, 6).alias(c) for c in ("p", "se", "ci95", "ci95_additive")])


@query("ag17_extrapolated", "SELECT n_nationkey, CAST(round_even(n_nationkey * 0.5, 0) AS BIGINT) AS estimate FROM nation")
def _(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", A.extrapolated(F.lit(0.5), F.col("n_nationkey")).alias("estimate"))


RE = "CASE WHEN l_linenumber = 2 THEN '2' WHEN abs(l_discount * 20 - 1) <= 1.0 AND abs(l_quantity * 6 - 120) <= 100 THEN '1' WHEN abs(l_discount * 20 - 1) > 1.0 AND abs(l_quantity * 6 - 120) <= 100 THEN 'A' WHEN abs(l_discount * 20 - 1) <= 1.0 THEN 'B' ELSE 'C' END"


@query("ag20_reclass", f"SELECT {RE} AS cls, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, sf):
    cls = A.reclassified(F.col("l_linenumber"), F.col("l_discount") * 20 - 1, F.col("l_quantity") * 6 - 120)
    return table(spark, sf, "lineitem").groupBy(cls.alias("cls")).agg(F.count("*").alias("n"))


@query("ag19_binacc", "SELECT l_returnflag, round(coalesce(avg(CASE WHEN l_linenumber <> 2 THEN (l_tax > 0.02 AND l_discount > 0.02)::INT END), -1.0), 6) AS both_, round(coalesce(avg(CASE WHEN l_linenumber <> 2 THEN (l_tax > 0.02 OR l_discount > 0.02)::INT END), -1.0), 6) AS one, round(coalesce(avg(CASE WHEN l_linenumber <> 2 THEN (l_tax > 0.02)::INT END), -1.0), 6) AS x, round(coalesce(avg(CASE WHEN l_linenumber <> 2 THEN (l_discount > 0.02)::INT END), -1.0), 6) AS y FROM lineitem GROUP BY 1")
def _(spark, sf):
    args = (F.col("l_linenumber"), F.col("l_tax") > 0.02, F.col("l_discount") > 0.02)
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(*[F.round(A.binary_accuracy(*args, o), 6).alias("both_" if o == "both" else o) for o in ("both", "one", "x", "y")])


@query("ag21_describe", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c})::DOUBLE AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS q2, round(quantile_cont({c}, 0.75), 4) AS q3 FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def _(spark, sf):
    d = A.described(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return d.select("column_name", "n", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"), "low", "high", *[F.round(q, 4).alias(q) for q in ("q1", "q2", "q3")])


@query("ag22_corr", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in (("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount"))))
def _(spark, sf):
    return A.correlations(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("r", F.round("r", 6))


@query("ag23_split_count", "SELECT part, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS part FROM part) WHERE part <> '' GROUP BY 1")
def _(spark, sf):
    return A.split_counts(table(spark, sf, "part"), "p_name", " ")


@query("ag26_median_group", "SELECT c_mktsegment, round(median(c_acctbal), 4) AS m FROM customer GROUP BY 1")
def _(spark, sf):
    m = QU.medians(table(spark, sf, "customer"), "c_acctbal", ["c_mktsegment"], "m")
    return m.select("c_mktsegment", F.round("m", 4).alias("m"))


@query("ag27_confidence", "SELECT l_orderkey, round(avg(l_discount), 6) AS mean, min(l_discount) AS low, max(l_discount) AS high FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(F.avg("l_discount"), 6).alias("mean"), F.min("l_discount").alias("low"), F.max("l_discount").alias("high"))


@query("ag28_split_summary", "SELECT o_orderstatus AS split, count(*) AS n, count(DISTINCT o_custkey) AS groups, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM orders GROUP BY 1")
def _(spark, sf):
    from pyspark.sql import Window

    g = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("split")).agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("groups"))
    return g.withColumn("pct", A.percent(F.col("n"), F.sum("n").over(Window.partitionBy())))


@query("ag30_dictionary", " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n, count(*) - count({c}) AS nulls, min({e})::DOUBLE AS lo, max({e})::DOUBLE AS hi FROM customer" for c, t, e in (("c_custkey", "number", "c_custkey"), ("c_name", "text", "length(c_name)"), ("c_nationkey", "number", "c_nationkey"), ("c_acctbal", "number", "c_acctbal"), ("c_mktsegment", "text", "length(c_mktsegment)"))))
def _(spark, sf):
    return A.data_dictionary(table(spark, sf, "customer"))


@query("ag32_char_accuracy", """WITH p AS (SELECT a.item_id, a.text AS t, b.text AS r FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1),
    c AS (SELECT item_id, t, r, unnest(range(1, greatest(length(t), length(r)) + 1)) AS i FROM p) SELECT item_id, round(sum((i <= length(t) AND i <= length(r) AND t[i] = r[i])::INT) / greatest(max(length(t)), max(length(r))), 6) AS accuracy, max(t) = max(r) AS exact FROM c GROUP BY 1""")
def _(spark, sf):
    b = table(spark, sf, "benchmark")
    pair = b.selectExpr("item_id", "text AS t").join(b.selectExpr("item_id - 1 AS item_id", "text AS r"), "item_id")
    return pair.select("item_id", F.round(A.character_accuracy(F.col("t"), F.col("r")), 6).alias("accuracy"), (F.col("t") == F.col("r")).alias("exact"))


@query("ag33_confusion", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def _(spark, sf):
    return A.confusion(table(spark, sf, "labels"), "quality", "toxic")


@query("ag34_distance", "SELECT round(avg(sqrt(l_tax * l_tax + l_discount * l_discount)), 6) AS mean, round(median(sqrt(l_tax * l_tax + l_discount * l_discount)), 6) AS median FROM lineitem")
def _(spark, sf):
    d = F.sqrt(F.col("l_tax") ** 2 + F.col("l_discount") ** 2)
    x = table(spark, sf, "lineitem").select(d.alias("d"))
    return x.agg(F.round(F.avg("d"), 6).alias("mean")).join(QU.medians(x, "d")).select("mean", F.round("median", 6).alias("median"))


@query("wn01_latest_log", "SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def _(spark, sf):
    return W.newest(table(spark, sf, "events").select("user_id", "event_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query("wn02_duplicates", "SELECT s_suppkey, s_nationkey FROM (SELECT *, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier) WHERE n > 1")
def _(spark, sf):
    return W.repeated(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), ["s_nationkey"])


@query("wn03_frequency", "SELECT event_id, count(user_id) OVER (PARTITION BY user_id) AS frequency FROM events")
def _(spark, sf):
    return W.with_frequency(table(spark, sf, "events").select("event_id", "user_id"), "user_id").drop("user_id")


@query("wn04_size_outlier", "WITH m AS (SELECT l_suppkey, median(l_quantity) AS q, median(l_extendedprice) AS p FROM lineitem GROUP BY 1) SELECT l_suppkey, count(*) AS n, sum((abs(l_quantity - q) > 15 OR abs(l_extendedprice - p) > 30000)::INT)::BIGINT AS outliers FROM lineitem JOIN m USING (l_suppkey) GROUP BY 1")
def _(spark, sf):
    x = W.off_median(table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice"), "l_suppkey", {"l_quantity": 15.0, "l_extendedprice": 30000.0})
    return x.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if("is_outlier").alias("outliers"))


ISLE = "sum((coalesce(a - reach > {gap}, false))::INT) OVER (PARTITION BY {k} ORDER BY a, {tie} ROWS UNBOUNDED PRECEDING)::BIGINT"


@query("wn08_islands", f"""WITH b AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS a, epoch_us(ts) / 1000000.0 + value * 60 AS e FROM events),
    r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b)
    SELECT user_id, event_id, {ISLE.format(gap=7200, k='user_id', tie='event_id')} AS island FROM r""")
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0).alias("a"), "value")
    return W.islands(e, ["user_id"], F.col("a"), F.col("a") + F.col("value") * 60, F.lit(7200), "event_id").select("user_id", "event_id", "island")


@query("wn09_merge_rows", """WITH b AS (SELECT l_suppkey AS k, CAST(l_partkey AS DOUBLE) AS a, max(l_quantity) AS s FROM lineitem GROUP BY 1, 2), r AS (SELECT *, lag(a) OVER (PARTITION BY k ORDER BY a) AS reach FROM b),
    i AS (SELECT *, sum((coalesce(a - reach > 4, false))::INT) OVER (PARTITION BY k ORDER BY a ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM r)
    SELECT k, island, arg_max(a, s * 1e6 - a) AS a, max(s) AS s, count(*) AS n FROM i GROUP BY 1, 2""")
def _(spark, sf):
    b = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("k"), F.col("l_partkey").cast("double").alias("a")).agg(F.max("l_quantity").alias("s"))
    return W.strongest_of_runs(b, ["k"], "a", "s", 4.0)


@query("wn10_runs", """WITH b AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, value > 8 AS f FROM events), t AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS g FROM b WHERE f)
    SELECT user_id, min(i)::BIGINT AS first, max(i)::BIGINT AS last, count(*) AS n FROM t GROUP BY user_id, g""")
def _(spark, sf):
    r = W.true_runs(table(spark, sf, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", F.col("value") > 8)
    return r.select("user_id", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"), "n")


@query("wn11_registry", "WITH l AS (SELECT user_id, max_by(event_type, concat(cast(ts AS VARCHAR), '#', lpad(cast(event_id AS VARCHAR), 12, '0'))) AS status, max(ts) AS ts FROM events GROUP BY 1) SELECT user_id, status, ts, CASE WHEN (status = 'click' AND ts < TIMESTAMP '2024-01-30 00:00:00') OR status = 'error' THEN 'free' ELSE status END AS state FROM l")
def _(spark, sf):
    from ..streaming.streams import reservation_state

    log = table(spark, sf, "events").select("user_id", F.when(F.col("event_type") == "click", "reserved").when(F.col("event_type") == "error", "abandoned").otherwise(F.col("event_type")).alias("status"), "ts")
    out = reservation_state(log, "user_id", "2024-01-31 00:00:00")
    back = {"reserved": "click", "abandoned": "error"}
    return out.select("user_id", *[F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in back.items() for x in p]), c), F.col(c)).alias(c) for c in ("status", "state")], "ts").select("user_id", "status", "ts", "state")


@query("wn12_label_conflict", "SELECT conv_id, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n, count(DISTINCT role) OVER (PARTITION BY conv_id) AS k FROM conversations) WHERE n = 1 AND k = 1")
def _(spark, sf):
    return W.settle_labels(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", "role", [F.desc("turn")]).select("conv_id", "role")


@query("wn13_adjacent_mean", "SELECT c_nationkey, round(avg(gap), 6) AS mean FROM (SELECT c_nationkey, row_number() OVER w AS n, c_acctbal - lag(c_acctbal) OVER w AS gap FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal)) WHERE n <= 5 GROUP BY 1")
def _(spark, sf):
    return W.adjacent_mean(table(spark, sf, "customer"), "c_nationkey", "c_acctbal", 5).withColumn("mean", F.round("mean", 6))


@query("wn14_dominant_line", "WITH m AS (SELECT l_orderkey, median(l_quantity) AS q FROM lineitem GROUP BY 1), r AS (SELECT l.*, abs(l_quantity - q) <= 5 AS near FROM lineitem l JOIN m USING (l_orderkey)), a AS (SELECT *, bool_or(near) OVER (PARTITION BY l_orderkey) AS any_ FROM r) SELECT l_orderkey, l_partkey, l_quantity FROM a WHERE near OR NOT any_")
def _(spark, sf):
    return W.dominant_line(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey", "l_quantity", 5.0)


@query("fn18_coverage", "WITH d AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events) SELECT user_id, min(d) AS first_day, max(d) AS last_day, count(*) AS days, CAST(max(d) - min(d) + 1 AS BIGINT) AS span, round(100.0::DOUBLE * count(*) / (max(d) - min(d) + 1), 2) AS covered_pct FROM d GROUP BY 1")
def _(spark, sf):
    return W.coverage(table(spark, sf, "events"), "user_id", F.to_date("ts"))


@query("wn06_gap_days", "WITH d AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events), s AS (SELECT user_id, min(d) AS lo, max(d) AS hi FROM d GROUP BY 1), a AS (SELECT user_id, unnest(range(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM s) SELECT user_id, day FROM a WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.user_id = a.user_id AND d.d = a.day)")
def _(spark, sf):
    return W.uncovered_days(table(spark, sf, "events"), "user_id", F.to_date("ts"))


@query("st03_best_cluster", "WITH c AS (SELECT o_custkey % 50 AS g, o_orderpriority AS p, count(*) AS n, round(sum(o_totalprice), 2) AS s FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, s DESC) AS k FROM c) SELECT g, CAST(left(p, 1) AS INT) AS cluster FROM r WHERE k = 1")
def _(spark, sf):
    c = table(spark, sf, "orders").selectExpr("o_custkey % 50 AS g", "CAST(left(o_orderpriority, 1) AS INT) AS cluster", "o_totalprice").groupBy("g", "cluster").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("s"))
    return W.best_cluster(c, "g", "cluster", [F.col("n"), F.col("s")])


@query("st04_sample", f"SELECT o_orderkey FROM orders ORDER BY {MD5_ORDER.format(k='o_orderkey')}, o_orderkey LIMIT 100")
def _(spark, sf):
    return S.sample_rows(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 100)


@query("st05_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()


@query("st07_numbers_first", "SELECT label, CAST(row_number() OVER (ORDER BY label = 'Blank', TRY_CAST(label AS DOUBLE) NULLS LAST, label) AS INT) AS place FROM (SELECT DISTINCT CASE WHEN p_size % 7 = 0 THEN 'Blank' WHEN p_size % 5 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END AS label FROM part)")
def _(spark, sf):
    from pyspark.sql import Window

    labels = table(spark, sf, "part").selectExpr("CASE WHEN p_size % 7 = 0 THEN 'Blank' WHEN p_size % 5 = 0 THEN p_brand ELSE CAST(p_size AS STRING) END AS label").distinct()
    return labels.withColumn("place", F.row_number().over(Window.orderBy(*S.numbers_first("label"))))


@query("st09_hash_split", "WITH h AS (SELECT o_orderkey, ('0x' || substring(md5(cast(o_orderkey AS VARCHAR)), 1, 8))::BIGINT AS h FROM orders) SELECT o_orderkey, CASE WHEN h % 100 < 10 THEN 'test' WHEN (h // 100) % 100 < 15 THEN 'validation' ELSE 'train' END AS split FROM h")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.hash_split(F.col("o_orderkey")).alias("split"))


GROUP_SPLIT = """WITH RECURSIVE s AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
    o AS (SELECT source, n, row_number() OVER (ORDER BY n DESC, source) AS i, sum(n) OVER () AS t FROM s),
    r AS (SELECT 0::BIGINT AS i, NULL::VARCHAR AS source, NULL::INT AS pick, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c
          UNION ALL
          SELECT i, source, pick, a + CASE pick WHEN 0 THEN n ELSE 0 END, b + CASE pick WHEN 1 THEN n ELSE 0 END, c + CASE pick WHEN 2 THEN n ELSE 0 END
          FROM (SELECT o.i, o.source, o.n, a, b, c, CASE WHEN 0.7 * t - a >= 0.2 * t - b AND 0.7 * t - a >= 0.1 * t - c THEN 0 WHEN 0.2 * t - b >= 0.1 * t - c THEN 1 ELSE 2 END AS pick FROM r JOIN o ON o.i = r.i + 1))
    SELECT doc_id, d.source, ['train', 'validation', 'test'][pick + 1] AS split FROM documents d JOIN r ON r.source = d.source"""


@query("st08_group_split", GROUP_SPLIT)
def _(spark, sf):
    return S.greedy_group_split(table(spark, sf, "documents").select("doc_id", "source"), "source").select("doc_id", "source", "split")


@query("so01_union_by_name", "SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal, NULL::VARCHAR AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    return S.union_by_name(c, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit("supplier").alias("segment")))


@query("so02_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("so06_every_input", "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'read' WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 'failed' WHEN lang = 'de' THEN 'excluded' ELSE 'missing' END AS status FROM documents")
def _(spark, sf):
    d, lab = table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels")
    return S.every_input_once(d.select("doc_id"), lab.where("quality = 1"), lab.where("quality = 0"), d.where("lang = 'de'"), "doc_id")


def _width_sql(layout):
    fields = ", ".join(f"CASE WHEN ok AND regexp_matches(substring(code, {a}, {n}), '^[0-9]+$') THEN TRY_CAST(substring(code, {a}, {n}) AS INT) END AS {k}" for k, a, n in P.LAYOUTS[layout] if k != "prefix")
    ok = "length(code) = 15" + (" AND starts_with(code, '10')" if layout == "v1" else "")
    return f"SELECT event_id, {fields} FROM (SELECT *, {ok} AS ok FROM (SELECT event_id, {READ} AS code FROM events))"


for _layout in P.LAYOUTS:

    @query(f"fn01_fixed_width_{_layout}", _width_sql(_layout))
    def _(spark, sf, layout=_layout):
        return codes(spark, sf).select("event_id", *[c.alias(n) for n, c in P.fixed_width(F.col("code"), layout).items()])


@query("fn04_sanitise", f"SELECT event_id, regexp_replace(code, '[^a-zA-Z0-9]', '', 'g') AS text, regexp_matches(code, '[a-zA-Z]') AS letters FROM (SELECT event_id, {READ} AS code FROM events)")
def _(spark, sf):
    return codes(spark, sf).select("event_id", P.sanitised(F.col("code")).alias("text"), P.has_letters(F.col("code")).alias("letters"))


@query("fn05_assemble", "SELECT l_orderkey, replace(string_agg(w, '' ORDER BY x, w), 'o', '0') AS text, sum(CASE WHEN low THEN length(regexp_replace(w, '[^0-9]', '', 'g')) ELSE 0 END)::INT AS digits, bool_or(contains(w, 'f')) AS says_f FROM (SELECT l_orderkey, l_partkey AS x, concat(lower(l_linestatus), cast(l_linenumber AS VARCHAR)) AS w, l_quantity > 40 AND l_quantity + 2 > 40 AS low FROM lineitem) GROUP BY 1")
def _(spark, sf):
    def corner(y):
        return F.struct(F.col("l_partkey").cast("double").alias("x"), y.cast("double").alias("y"))

    word = F.struct(F.col("l_partkey").alias("x"), F.concat(F.lower("l_linestatus"), F.col("l_linenumber").cast("string")).alias("text"), F.array(corner(F.col("l_quantity")), corner(F.col("l_quantity") + 2)).alias("box"))
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(word).alias("w"))
    return g.select("l_orderkey", P.assembled(F.col("w")).alias("text"), P.digits_in_strip(F.col("w"), F.lit(50.0)).alias("digits"), P.says(F.col("w"), "F").alias("says_f"))


@query("fn07_digits", f"SELECT event_id, CASE WHEN hour IS NOT NULL AND minute IS NOT NULL THEN CAST(concat(hour, minute) AS INT) END AS joined, lpad(cast(day AS VARCHAR), 3, '0') AS filled, CAST(substring(lpad(cast(day AS VARCHAR), 3, '0'), 1, 1) AS INT) AS d1, CAST(substring(lpad(cast(day AS VARCHAR), 3, '0'), 3, 1) AS INT) AS d3 FROM (SELECT event_id, {TIME} FROM events)")
def _(spark, sf):
    d = P.digit_columns(F.col("day"), 3)
    return times(spark, sf).select("event_id", P.joined_digits(F.col("hour"), F.col("minute")).alias("joined"), P.zero_filled(F.col("day"), 3).alias("filled"), d[0].alias("d1"), d[2].alias("d3"))


HEMI = "concat(cast(user_id % 90 AS string), '.', cast(event_id % 10 AS string), CASE event_id % 6 WHEN 0 THEN 'N' WHEN 1 THEN 'S' WHEN 2 THEN 'E' WHEN 3 THEN 'W' WHEN 4 THEN 'n' ELSE 'x' END)"


@query("fn08_hemisphere", f"SELECT event_id, CASE WHEN upper(right({HEMI}, 1)) IN ('N', 'E') THEN 1 WHEN upper(right({HEMI}, 1)) IN ('S', 'W') THEN -1 END * CAST(regexp_extract({HEMI}, '^[0-9.]+') AS DOUBLE) AS degrees, CASE WHEN upper(right({HEMI}, 1)) IN ('N', 'E') THEN 1 WHEN upper(right({HEMI}, 1)) IN ('S', 'W') THEN -1 END * CAST(regexp_extract({HEMI}, '^[0-9]+') AS DOUBLE) AS whole FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", f"{HEMI} AS t")
    return e.select("event_id", P.degrees(F.col("t")).alias("degrees"), P.degrees(F.col("t"), integer_only=True).alias("whole"))


@query("fn09_doy_legacy", f"SELECT event_id, CASE WHEN day BETWEEN 1 AND 366 THEN make_date(year, month(DATE '1900-01-01' + day - 1), dayofmonth(DATE '1900-01-01' + day - 1)) END AS d FROM (SELECT event_id, {TIME} FROM events)")
def _(spark, sf):
    return times(spark, sf).select("event_id", Q.day_of_year_date(F.col("year"), F.col("day"), legacy=True).alias("d"))


TRUE_DAY = "CASE WHEN day >= 1 AND year(make_date(year, 1, 1) + day - 1) = year THEN make_date(year, 1, 1) + day - 1 END"


@query("fn10_doy_true", f"SELECT event_id, {TRUE_DAY} AS d, strftime({TRUE_DAY}, '%-m/%-d/%Y') AS text FROM (SELECT event_id, {TIME} FROM events)")
def _(spark, sf):
    d = Q.day_of_year_date(F.col("year"), F.col("day"))
    return times(spark, sf).select("event_id", d.alias("d"), F.date_format(d, "M/d/yyyy").alias("text"))


def _cascade_sql():
    ts = [f"({TRUE_DAY})::TIMESTAMP" + "".join(f" + to_{u}s({u})" for u in units) for units in (("hour", "minute", "second"), ("hour", "minute"), ("hour",), ())]
    quality = "CASE " + " ".join(f"WHEN {t} IS NOT NULL THEN {i}" for i, t in enumerate(ts, 1)) + " ELSE 0 END"
    return f"SELECT event_id, coalesce({', '.join(ts)}) AS t, {quality} AS quality FROM (SELECT event_id, {TIME} FROM events)"


@query("fn11_time_cascade", _cascade_sql())
def _(spark, sf):
    t, q = Q.time_cascade(*[F.col(c) for c in ("year", "day", "hour", "minute", "second")])
    return times(spark, sf).select("event_id", t.alias("t"), q.alias("quality"))


QUAL = f"CASE {TAGS} WHEN 'Second' THEN 2 WHEN 'Minute' THEN 3 WHEN 'Hour' THEN 3 WHEN 'Day>365' THEN 4 WHEN 'Day<1' THEN 4 WHEN 'Year' THEN 5 ELSE 1 END"


@query("fn12_outlier_quality", f"SELECT event_id, {QUAL} AS quality, CASE {QUAL} WHEN 1 THEN concat(strftime({TRUE_DAY}, '%Y-%m-%d'), ' ', lpad(cast(hour AS VARCHAR), 2, '0'), ':', lpad(cast(minute AS VARCHAR), 2, '0'), ':', lpad(cast(second AS VARCHAR), 2, '0')) WHEN 2 THEN concat(strftime({TRUE_DAY}, '%Y-%m-%d'), ' ', lpad(cast(hour AS VARCHAR), 2, '0'), ':', lpad(cast(minute AS VARCHAR), 2, '0'), ':00') WHEN 3 THEN concat(strftime({TRUE_DAY}, '%Y-%m-%d'), ' ', lpad(cast(hour AS VARCHAR), 2, '0'), ':00:00') WHEN 4 THEN concat(cast(year AS VARCHAR), '-00-00 00:00:00') ELSE 'Low certainty' END AS text FROM (SELECT event_id, year, day, coalesce(hour, 1) AS hour, coalesce(minute, 2) AS minute, coalesce(second, 3) AS second FROM (SELECT event_id, {TIME} FROM events))")
def _(spark, sf):
    t = times(spark, sf).fillna({"hour": 1, "minute": 2, "second": 3})
    parts = [F.col(c) for c in ("year", "day", "hour", "minute", "second")]
    t = t.withColumn("quality", Q.outlier_quality(C.time_faults(*parts)))
    return t.select("event_id", "quality", Q.rendered_time(*parts, F.col("quality")).alias("text"))


@query("fn16_issues", f"SELECT event_id, CASE WHEN hour IS NULL AND minute IS NULL AND second IS NULL THEN 'hour, minute, second' WHEN hour IS NULL AND minute IS NULL THEN 'hour, minute' WHEN hour IS NULL AND second IS NULL THEN 'hour, second' WHEN minute IS NULL AND second IS NULL THEN 'minute, second' WHEN hour IS NULL THEN 'hour' WHEN minute IS NULL THEN 'minute' WHEN second IS NULL THEN 'second' ELSE 'None' END AS issue FROM (SELECT event_id, {TIME} FROM events)")
def _(spark, sf):
    return times(spark, sf).select("event_id", P.issue_list({c: F.col(c).isNull() for c in ("hour", "minute", "second")}).alias("issue"))


@query("fn20_parse_time", "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN TIMESTAMP '1969-01-30 00:00:00' ELSE date_trunc('second', ts) END AS t FROM events")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 9 == 0, "Low certainty").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("t"))
    return e.select("event_id", Q.parsed_time(F.col("t")).alias("t"))


@query("fn21_paths", "SELECT page_id, regexp_replace(string_split(regexp_replace(url, '/+', '/', 'g'), '/')[-1], '[.][^.]*$', '') AS stem, string_split(regexp_replace(url, '/+', '/', 'g'), '/')[-2] AS folder, regexp_matches(regexp_replace(url, '/+', '/', 'g'), '(^/)|(^|/)[.][.](/|$)|^[A-Za-z]:') AS unsafe FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", P.stem(F.col("url")).alias("stem"), P.path_part(F.col("url"), 2).alias("folder"), P.unsafe_path(F.col("url")).alias("unsafe"))


@query("fn22_rotated_label", "SELECT p_partkey, CASE WHEN length(p_name) > 2 THEN concat(right(p_name, 2), left(p_name, length(p_name) - 2)) ELSE p_name END AS label FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", P.rotated_label(F.col("p_name")).alias("label"))


@query("fn24_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", P.loose_json(F.translate("props", '"', "'"), "k bigint")["k"].alias("k"))


POINT = "CASE WHEN event_id % 7 = 0 THEN 'NA' ELSE concat('(', cast(user_id as string), ', ', cast(event_id % 100 as string), ')') END"


@query("fn25_tuple", "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id::DOUBLE END AS x, CASE WHEN event_id % 7 <> 0 THEN (event_id % 100)::DOUBLE END AS y FROM events")
def _(spark, sf):
    p = P.point(F.col("t"))
    return table(spark, sf, "events").selectExpr("event_id", f"{POINT} AS t").select("event_id", p["x"].alias("x"), p["y"].alias("y"))


@query("fn26_category", "SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'BUILDING' THEN 3 END AS code FROM customer")
def _(spark, sf):
    m = F.create_map(F.lit("HOUSEHOLD"), F.lit(1), F.lit("MACHINERY"), F.lit(2), F.lit("BUILDING"), F.lit(3))
    return table(spark, sf, "customer").select("c_custkey", F.try_element_at(m, F.col("c_mktsegment")).alias("code"))


@query("fn27_yolo", f"SELECT l_orderkey, l_partkey, l_linenumber, round((x1 + x2) / 2 / 100, 6) AS cx, round((y1 + y2) / 2 / 100, 6) AS cy, round((x2 - x1) / 100, 6) AS w, round((y2 - y1) / 100, 6) AS h FROM (SELECT *, {BOX} FROM lineitem)")
def _(spark, sf):
    b = table(spark, sf, "lineitem").selectExpr("*", *BOXES)
    box = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    return b.select("l_orderkey", "l_partkey", "l_linenumber", *[F.round(v, 6).alias(n) for n, v in zip(("cx", "cy", "w", "h"), G.yolo_box(box, F.lit(100), F.lit(100)), strict=True)])


@query("fn27_yolo_decode", f"SELECT l_orderkey, l_partkey, l_linenumber, CAST(trunc(greatest(0, least(x1, 100))) AS INT) AS x1, CAST(greatest(0, least(y2, 100)) AS INT) AS y2 FROM (SELECT *, {BOX} FROM lineitem)")
def _(spark, sf):
    b = table(spark, sf, "lineitem").selectExpr("*", *BOXES)
    w = F.lit(100)
    return b.select("l_orderkey", "l_partkey", "l_linenumber", G.pixel_box(((F.col("x1") + 0.5) / 128, F.lit(0.5), F.lit(1 / 128), F.lit(1.0)), F.lit(128), w)[0].alias("x1"), F.greatest(F.lit(0), F.least(F.col("y2"), w)).alias("y2"))


@query("fn28_iou_pairs", f"""WITH b AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i, x1, y1, x2, y2 FROM (SELECT *, {BOX} FROM lineitem)),
    p AS (SELECT a.l_orderkey, a.i AS i, b.i AS j, greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) AS both_, (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS s FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.i < b.i)
    SELECT l_orderkey, i, j, round(both_ / (s - both_), 6) AS iou FROM p""")
def _(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    b = table(spark, sf, "lineitem").selectExpr("*", *BOXES).select("l_orderkey", F.row_number().over(w).alias("i"), "x1", "y1", "x2", "y2")
    names = ("x1", "y1", "x2", "y2")
    other = b.select("l_orderkey", F.col("i").alias("j"), *[F.col(c).alias(f"{c}b") for c in names])
    iou = G.iou(tuple(F.col(c) for c in names), tuple(F.col(f"{c}b") for c in names))
    return b.join(other, "l_orderkey").where("i < j").select("l_orderkey", F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.round(iou, 6).alias("iou"))


GRID = [(0.0, 0.5), (10.0, 1.5), (25.0, 2.0), (40.0, 5.0)]


def _grid():
    return F.array(*[F.struct(F.lit(x).alias("x"), F.lit(v).alias("v")) for x, v in GRID])


_PIECES = " ".join(f"WHEN q < {b[0]} THEN {a[1]} + ({b[1]} - {a[1]}) * (q - {a[0]}) / ({b[0]} - {a[0]})" for a, b in zip(GRID[:-1], GRID[1:], strict=True))


@query("fn29_piecewise", f"SELECT l_orderkey, l_partkey, l_linenumber, round(CASE WHEN q < 0 OR q > 40 THEN NULL {_PIECES} ELSE 5.0 END, 6) AS mhz, round(CASE WHEN q < 0 OR q > 40 THEN NULL WHEN q IN (0, 10, 25, 40) THEN 0.0 {_PIECES} END, 6) AS mhz_legacy, round(100 + (q - 55) * 100 / 55, 6) AS km FROM (SELECT *, l_quantity AS q FROM lineitem)")
def _(spark, sf):
    q = F.col("l_quantity")
    km = G.by_two_anchors(q, F.lit(55.0), 100.0, F.lit(110.0), 200.0)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.round(G.piecewise(q, _grid()), 6).alias("mhz"), F.round(G.piecewise(q, _grid(), legacy=True), 6).alias("mhz_legacy"), F.round(km, 6).alias("km"))


_BACK = " ".join(f"WHEN v < {b[1]} THEN {a[0]} + ({b[0]} - {a[0]}) * (v - {a[1]}) / ({b[1]} - {a[1]})" for a, b in zip(GRID[:-1], GRID[1:], strict=True))


@query("fn30_inverse", f"SELECT event_id, round(CASE WHEN v < 0.5 OR v > 5 THEN NULL {_BACK} ELSE 40.0 END, 6) AS x, round(CASE WHEN v IN (0.5, 1.5, 2.0, 5.0) THEN v WHEN v < 0.5 OR v > 5 THEN NULL {_BACK} END, 6) AS x_legacy FROM (SELECT event_id, (event_id % 60) / 10.0::DOUBLE AS v FROM events)")
def _(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", "CAST(event_id % 60 AS DOUBLE) / 10.0D AS v")
    return e.select("event_id", F.round(G.inverse_piecewise(F.col("v"), _grid()), 6).alias("x"), F.round(G.inverse_piecewise(F.col("v"), _grid(), legacy=True), 6).alias("x_legacy"))


@query("fn31_tiles", "SELECT o_orderkey, CASE WHEN w <= 512 THEN [0] ELSE list_append(range(0, w - 512, 384), w - 512) END::INT[]::VARCHAR AS starts FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 100) AS INT) AS w FROM orders)")
def _(spark, sf):
    starts = G.tile_starts(F.floor(F.col("o_totalprice") / 100).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("["), F.array_join(starts.cast("array<string>"), ", "), F.lit("]")).alias("starts"))


@query("fn32_letterbox", "SELECT p_partkey, CAST(trunc(w * s) AS INT) AS width, CAST(trunc(h * s) AS INT) AS height, CAST(floor((320 - trunc(w * s)) / 2) AS INT) AS left_, CAST(floor((32 - trunc(h * s)) / 2) AS INT) AS top FROM (SELECT *, least(320.0::DOUBLE / w, 32.0::DOUBLE / h) AS s FROM (SELECT p_partkey, 100 + p_size * 10 AS w, 10 + p_size AS h FROM part))")
def _(spark, sf):
    box = G.letterbox(100 + F.col("p_size") * 10, 10 + F.col("p_size"), 320, 32)
    return table(spark, sf, "part").select("p_partkey", box["width"].alias("width"), box["height"].alias("height"), box["left"].alias("left_"), box["top"].alias("top"))


@query("fn33_curves", "SELECT p_partkey, round((1 + 2.0 * x) / (1 + 0.5 * x), 6) AS rational, round(2 * exp(0.01 * x) + 1, 6) AS exponential, round(2 * ln(1.5 * x) + 1, 6) AS logarithm, round(2 * pow(x, 0.5) + 1, 6) AS power, round(2 / (1 + exp(-0.1 * (x - 20))), 6) AS logistic FROM (SELECT p_partkey, p_size::DOUBLE AS x FROM part) WHERE x > 0")
def _(spark, sf):
    x = F.col("p_size").cast("double")
    args = {"rational": (1, 2.0, 0.5), "exponential": (2, 0.01, 1), "logarithm": (2, 1.5, 1), "power": (2, 0.5, 1), "logistic": (2, 0.1, 20)}
    return table(spark, sf, "part").where(x > 0).select("p_partkey", *[F.round(f(x, *args[n]), 6).alias(n) for n, f in G.CURVES.items()])


@query("fn36_validate", f"SELECT event_id, regexp_matches(code, '^[0-9]+$') AS digits FROM (SELECT event_id, {READ} AS code FROM events)")
def _(spark, sf):
    return codes(spark, sf).select("event_id", P.only_digits(F.col("code")).alias("digits"))


@query("jn09_nearest_label", "SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'a' WHEN p_size <= 25 THEN 'b' WHEN p_size <= 38 THEN 'c' ELSE 'd' END AS label FROM part")
def _(spark, sf):
    labels = F.array(*[F.struct(F.lit(x).alias("at"), F.lit(n).alias("label")) for x, n in ((5, "a"), (15, "b"), (35, "c"), (41, "d"))])
    return table(spark, sf, "part").select("p_partkey", G.nearest_label(F.col("p_size"), labels).alias("label"))


@query("im03_largest_margin", "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN greatest(a, b, c, d) = a THEN 'left' WHEN greatest(b, c, d) = b THEN 'right' WHEN greatest(c, d) = c THEN 'top' ELSE 'bottom' END AS side FROM (SELECT *, l_quantity * 100 AS a, (120 - l_quantity) * 100 - 5000 AS b, l_linenumber * 120 AS c, 100 * 120 - 95 * 120 AS d FROM lineitem)")
def _(spark, sf):
    side = G.largest_margin(F.lit(100.0), F.lit(120.0), F.col("l_quantity"), F.col("l_quantity") + 50, F.col("l_linenumber").cast("double"), F.lit(95.0))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", side.alias("side"))


@query("im22_fmin_depth", "SELECT l_partkey, min(l_quantity) FILTER (l_extendedprice > 5000) AS fmin, max(l_extendedprice) FILTER (l_extendedprice > 5000) AS max_depth FROM lineitem GROUP BY 1")
def _(spark, sf):
    deep = F.col("l_extendedprice") > 5000
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.min(F.when(deep, F.col("l_quantity"))).alias("fmin"), F.max(F.when(deep, F.col("l_extendedprice"))).alias("max_depth"))


@query("im25_mad", """WITH m AS (SELECT l_suppkey, median(l_quantity) AS m FROM lineitem GROUP BY 1), d AS (SELECT l_suppkey, median(abs(l_quantity - m)) AS mad FROM lineitem JOIN m USING (l_suppkey) GROUP BY 1)
    SELECT l_suppkey, m, mad, count(*) FILTER (abs(l_quantity - m) > 1.5 * mad) AS far FROM lineitem JOIN m USING (l_suppkey) JOIN d USING (l_suppkey) GROUP BY 1, 2, 3""")
def _(spark, sf):
    x = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    x = x.join(QU.medians(x, "l_quantity", ["l_suppkey"], "m"), "l_suppkey")
    off = F.abs(F.col("l_quantity") - F.col("m"))
    x = x.join(QU.medians(x, off, ["l_suppkey"], "mad"), "l_suppkey")
    return x.groupBy("l_suppkey", "m", "mad").agg(F.count_if(off > 1.5 * F.col("mad")).alias("far"))


@query("im28_maxdepth", """WITH a AS (SELECT l_partkey, avg(l_quantity) AS q FROM lineitem GROUP BY 1)
    SELECT l_partkey, max(l_extendedprice) AS depth, min(l_quantity) FILTER (l_extendedprice = d) AS at FROM (SELECT l.*, max(l_extendedprice) OVER (PARTITION BY l_partkey) AS d FROM lineitem l JOIN a USING (l_partkey) WHERE l_quantity > q) GROUP BY 1""")
def _(spark, sf):
    from pyspark.sql import Window

    x = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    x = x.withColumn("q", F.avg("l_quantity").over(Window.partitionBy("l_partkey"))).where("l_quantity > q")
    return x.groupBy("l_partkey").agg(F.max("l_extendedprice").alias("depth"), F.max_by("l_quantity", F.struct("l_extendedprice", -F.col("l_quantity"))).alias("at"))


@query("im38_tile_box", f"SELECT l_orderkey, l_partkey, l_linenumber, CAST(greatest(0, floor((x1 + 384) / 1.6)) AS BIGINT) AS x1, CAST(greatest(least(400, ceil((x2 + 384) / 1.6)), greatest(0, floor((x1 + 384) / 1.6)) + 1) AS BIGINT) AS x2 FROM (SELECT *, {BOX} FROM lineitem)")
def _(spark, sf):
    b = table(spark, sf, "lineitem").selectExpr("*", *BOXES)
    out = G.tile_box(tuple(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.lit(384), F.lit(1.6), F.lit(400), F.lit(80))
    return b.select("l_orderkey", "l_partkey", "l_linenumber", out[0].cast("long").alias("x1"), out[2].cast("long").alias("x2"))


@query("or05_orbit_qa", "SELECT CAST(l_quantity > 25 AS INT) AS flag, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd FROM lineitem GROUP BY 1")
def _(spark, sf):
    from pyspark.sql import Window

    g = table(spark, sf, "lineitem").groupBy((F.col("l_quantity") > 25).cast("int").alias("flag")).agg(F.count("*").alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.round(F.stddev_samp("l_extendedprice"), 4).alias("sd"))
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("dt02_flagged_report", "SELECT round(100.0::DOUBLE * count(*) FILTER (toxic = 1) / count(*), 2) AS pct_rows, count(DISTINCT CASE WHEN toxic = 1 THEN source END) AS flagged_rolls, count(DISTINCT source) AS rolls FROM documents JOIN labels USING (doc_id)")
def _(spark, sf):
    x = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id")
    flagged = F.col("toxic") == 1
    return x.agg(A.percent(F.count_if(flagged), F.count("*")).alias("pct_rows"), F.countDistinct(F.when(flagged, F.col("source"))).alias("flagged_rolls"), F.countDistinct("source").alias("rolls"))


@query("dt03_distribution", "SELECT round(avg(a), 6) AS mean, round(median(a), 6) AS median, round(stddev_samp(a), 6) AS sd, round(100.0::DOUBLE * count(*) FILTER (a < 1.2) / count(*), 2) AS narrow, round(100.0::DOUBLE * count(*) FILTER (a >= 3) / count(*), 2) AS wide FROM (SELECT 1 + l_discount * 30 AS a FROM lineitem)")
def _(spark, sf):
    x = table(spark, sf, "lineitem").select((1 + F.col("l_discount") * 30).alias("a"))
    out = x.agg(F.round(F.avg("a"), 6).alias("mean"), F.round(F.stddev_samp("a"), 6).alias("sd"), A.percent(F.count_if(F.col("a") < 1.2), F.count("*")).alias("narrow"), A.percent(F.count_if(F.col("a") >= 3), F.count("*")).alias("wide"))
    return out.join(QU.medians(x, "a")).withColumn("median", F.round("median", 6))


@query("dt05_valid_labels", "SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL AND trim(lower(CASE WHEN toxic = 0 THEN ' Completed' ELSE 'abandoned' END)) = 'completed'")
def _(spark, sf):
    state = F.when(F.col("toxic") == 0, " Completed").otherwise("abandoned")
    return table(spark, sf, "labels").where(F.col("quality").isNotNull() & (F.trim(F.lower(state)) == "completed")).select("doc_id", "quality")


@query("dt06_routing", "SELECT d.doc_id, CASE WHEN d.doc_id % 50 = 0 THEN 'unsafe' WHEN l.doc_id IS NULL THEN 'missing' WHEN d.n_chars < 100 THEN 'empty' ELSE 'ok' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)")
def _(spark, sf):
    path = F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("../"), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("a/"), F.col("doc_id").cast("string")))
    d = table(spark, sf, "documents").select("doc_id", "n_chars", path.alias("path"))
    there = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("there")).distinct()
    return d.join(there, "doc_id", "left").select("doc_id", F.when(P.unsafe_path(F.col("path")), "unsafe").when(F.col("there").isNull(), "missing").when(F.col("n_chars") < 100, "empty").otherwise("ok").alias("reason"))


@query("dt09_last_completed", "SELECT user_id, max_by(event_id, concat(cast(ts AS VARCHAR), lpad(cast(event_id AS VARCHAR), 12, '0'))) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1")
def _(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'purchase'").select("user_id", "event_id", "ts")
    return W.newest(e, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id")


@query("dt12_digit_station", "SELECT event_id, n_name FROM (SELECT event_id, CAST(concat(user_id % 3, event_id % 10) AS INT) AS k FROM events) JOIN nation ON n_nationkey = k")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", P.joined_digits(F.col("user_id") % 3, F.col("event_id") % 10).alias("n_nationkey"))
    return e.join(table(spark, sf, "nation"), "n_nationkey").select("event_id", "n_name")


@query("dt15_depth_frequency", "SELECT l_partkey, max(l_extendedprice) AS depth, arg_max(l_quantity, l_extendedprice * 1e6 - l_quantity) AS at, min(l_quantity) AS fmin, max(l_quantity) AS fmax FROM lineitem GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max("l_extendedprice").alias("depth"), F.max_by("l_quantity", F.struct("l_extendedprice", -F.col("l_quantity"))).alias("at"), F.min("l_quantity").alias("fmin"), F.max("l_quantity").alias("fmax"))


@query("ag14_tail_share", "WITH b AS (SELECT l_suppkey, CAST(l_quantity AS INT) AS q FROM lineitem) SELECT l_suppkey, round(count(*) FILTER (q BETWEEN 40 AND 49) / count(*), 6) AS tail FROM b GROUP BY 1")
def _(spark, sf):
    q = F.col("l_quantity").cast("int")
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.array(*[F.count_if(q == i) for i in range(51)]).alias("counts"))
    return g.select("l_suppkey", F.round(A.tail_share(F.col("counts"), 40), 6).alias("tail"))


@query("st01_ordering", "SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 0 THEN c_acctbal END NULLS FIRST, c_custkey) AS INT) AS place FROM customer")
def _(spark, sf):
    from pyspark.sql import Window

    c = table(spark, sf, "customer").withColumn("b", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    w = Window.partitionBy("c_nationkey").orderBy(F.asc_nulls_first("b"), "c_custkey")
    return c.select("c_custkey", F.row_number().over(w).alias("place"))


@query("jn18_update_two_keys", """WITH c AS (SELECT l_orderkey AS k, l_linenumber AS n, max_by(l_quantity, l_extendedprice * 1000 + l_partkey) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(c.q, l_quantity) AS l_quantity FROM lineitem LEFT JOIN c ON k = l_orderkey AND n = l_linenumber""")
def _(spark, sf):
    x = table(spark, sf, "lineitem")
    changes = x.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") * 1000 + F.col("l_partkey")).alias("o"))
    rows = x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return J.update_join(rows, changes, ["l_orderkey", "l_linenumber"], ["l_quantity"], "o")[0]


@query("dt08_failed_split", "SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus)")
def _(spark, sf):
    failed = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"))
    return J.worklist(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), failed, ["o_orderkey", "o_orderstatus"])
