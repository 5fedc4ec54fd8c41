"""Queries of grid lines and left-side labels, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import grids as R
from .registry import query, table

# peaks of a roll: places derived from a customer's orders
PEAKS = "WITH p AS (SELECT o_custkey AS roll, list_sort(list_distinct(list(CAST({place} AS INT)))) AS p FROM orders GROUP BY 1)"
COLUMNS, ROWS, FIELDS = "o_orderkey * 7 % 1500", "o_orderkey * 3 % 260", "o_orderkey * 11 % 720"
WEIGHT_PLACES = "o_orderkey * 13 % 200"
_AXES = ("digit", "digit_f")


def peaks(spark, sf, place: str):
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("roll")).agg(F.array_sort(F.collect_set(F.expr(f"CAST({place} AS INT)"))).alias("p"))


def _values(*columns) -> str:
    return "(VALUES " + ", ".join(f"({i + 1}, {', '.join(repr(v) for v in row)})" for i, row in enumerate(zip(*columns, strict=True))) + ")"


@query("im14_frequency_lines", f"""{PEAKS.format(place=COLUMNS)}, u(i, f, d) AS {_values(R.FREQUENCIES, R.USUAL_COLUMNS)},
    l AS (SELECT i, f, d, coalesce((d + lag(d) OVER (ORDER BY i)) / 2.0, {R.OUTERMOST[0]}) AS low, coalesce((d + lead(d) OVER (ORDER BY i)) / 2.0, {R.OUTERMOST[1]}) AS high FROM u)
    SELECT roll, CAST(f AS DOUBLE) AS frequency, CAST(CASE WHEN len(p) = 13 OR (len(p) > 13 AND p[i] BETWEEN low AND high) THEN p[i] ELSE d END AS INT) AS x FROM p, l""")
def _(spark, sf):
    lines = R.frequency_lines(F.col("p"), F.slice("p", 1, len(R.FREQUENCIES)))
    return peaks(spark, sf, COLUMNS).select("roll", F.explode(lines).alias("g")).select("roll", F.col("g.v").alias("frequency"), F.col("g.x").alias("x"))


@query("im14_depth_lines", f"""{PEAKS.format(place=ROWS)}, q AS (SELECT roll, list_filter(p, lambda y: y > {R.LEAST_ROW}) AS p FROM p), u(i, depth, d) AS {_values(tuple(R.USUAL_ROWS), tuple(R.USUAL_ROWS.values()))}
    SELECT roll, CAST(depth AS INT) AS depth, CAST(CASE WHEN len(p) >= 2 AND abs(p[i] - d) <= 55 THEN p[i] ELSE d END AS INT) AS y FROM q, u""")
def _(spark, sf):
    return peaks(spark, sf, ROWS).select("roll", F.explode(R.depth_lines(F.col("p"))).alias("g")).select("roll", F.col("g.v").alias("depth"), F.col("g.x").alias("y"))


def _fields_sql(kind: str, roll: str) -> str:
    gap, first, last = R.FIELD_AXIS[kind]
    a, b = (f"CASE WHEN abs({at} - {usual}) <= {0.75 * gap} THEN {at} ELSE {usual} END::DOUBLE" for at, usual in (("p[1]", first), ("p[-1]", last)))
    return f"SELECT roll, i, f, {a} AS a, {b} AS b FROM p, u WHERE {roll}"


@query("im18_field_axis", f"""{PEAKS.format(place=FIELDS)}, u(i, f) AS {_values(R.DIGIT_FIELDS)}, e AS ({_fields_sql('digit', 'roll % 2 = 0')} UNION ALL {_fields_sql('digit_f', 'roll % 2 = 1')})
    SELECT roll, f AS field, CAST(round_even(a + (b - a) / 12 * (i - 1), 0) AS INT) AS place FROM e""")
def _(spark, sf):
    own, other = (R.field_axis(F.col("p"), R.DIGIT_FIELDS, kind) for kind in _AXES)
    axis = F.when(F.col("roll") % 2 == 0, own).otherwise(other)
    return peaks(spark, sf, FIELDS).select("roll", F.explode(axis).alias("g")).select("roll", F.col("g.label").alias("field"), F.col("g.at").alias("place"))


def _weights_sql(legacy: bool) -> str:
    gap, first, distance = R.WEIGHT_AXIS["digit"]
    return f"""{PEAKS.format(place=WEIGHT_PLACES)}, u(i, w) AS {_values(R.WEIGHTS)}, m AS (SELECT roll, p, len(p) >= {4 if legacy else 2} AS there, (p[least(len(p), 4)] - p[1]) / nullif(least(len(p), 4) - 1, 0)::DOUBLE AS mean FROM p),
    e AS (SELECT roll, CASE WHEN there AND abs(p[1] - {first}) <= {0.75 * gap} THEN p[1] ELSE {first} END::DOUBLE AS a, CASE WHEN there AND abs(mean - {gap}) <= {0.75 * distance} THEN mean ELSE {gap} END::DOUBLE AS gap FROM m)
    SELECT roll, CAST(w AS INT) AS weight, CAST(round_even(a + gap * (i - 1), 0) AS INT) AS place FROM e, u"""


def _weights(spark, sf, legacy: bool):
    return peaks(spark, sf, WEIGHT_PLACES).select("roll", F.explode(R.weight_axis(F.col("p"), "digit", legacy=legacy)).alias("g")).select("roll", F.col("g.label").alias("weight"), F.col("g.at").alias("place"))


@query("im18_weight_axis", _weights_sql(False))
def _(spark, sf):
    return _weights(spark, sf, False)


@query("im18_weight_axis_legacy", _weights_sql(True))
def _(spark, sf):
    return _weights(spark, sf, True)


_USUAL_FIELDS = tuple(R.FIELD_AXIS["digit"][1] + R.FIELD_AXIS["digit"][0] * i for i in range(len(R.DIGIT_FIELDS)))
_USUAL_WEIGHTS = tuple(R.WEIGHT_AXIS["digit"][1] + R.WEIGHT_AXIS["digit"][0] * i for i in range(len(R.WEIGHTS)))


@query("im19_left_side", f"""WITH c AS (SELECT event_id, user_id, event_id * 37 % 720 AS x, (event_id + user_id) * 13 % 200 AS y FROM events), f(i, field, place) AS {_values(R.DIGIT_FIELDS, _USUAL_FIELDS)}, w(i, weight, place) AS {_values(R.WEIGHTS, _USUAL_WEIGHTS)},
    m AS (SELECT user_id, event_id, (SELECT arg_min(field, abs(place - x) * 100 + i) FROM f) AS field, (SELECT arg_min(weight, abs(place - y) * 100 + i) FROM w) AS weight FROM c)
    SELECT user_id, field, CAST(sum(DISTINCT weight) AS BIGINT) AS digit FROM m GROUP BY 1, 2""")
def _(spark, sf):
    marks = table(spark, sf, "events").selectExpr("user_id", "event_id * 37 % 720 AS x", "(event_id + user_id) * 13 % 200 AS y")
    none = F.array().cast("array<int>")
    fields, weights = R.field_axis(none, R.DIGIT_FIELDS, "digit"), R.weight_axis(none, "digit")
    read = marks.select("user_id", G.nearest_label(F.col("x"), fields).alias("field"), G.nearest_label(F.col("y"), weights).alias("weight"))
    return read.groupBy("user_id", "field").agg(F.sum_distinct("weight").cast("long").alias("digit"))


# three readings of a line item: a box, sometimes missing or without area
_SEQUENCE, _FAST, _FALLBACK = "l_linenumber >= 4", "l_partkey % 3 <> 0", "l_suppkey % 2 = 0"
_READ_BOX = "CAST(l_partkey % 40 AS INT) AS x1, CAST(l_suppkey % 30 AS INT) AS y1, CAST(l_partkey % 40 + l_quantity - 5 AS INT) AS x2, CAST(l_suppkey % 30 + l_linenumber AS INT) AS y2"


@query("im41_region_decision", f"""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_READ_BOX} FROM lineitem),
    d AS (SELECT *, CASE WHEN {_SEQUENCE} AND x2 > x1 THEN 'foreground_sequence' WHEN {_FAST} AND x2 > x1 + 10 THEN 'detector' WHEN {_FALLBACK} THEN 'foreground_fallback' ELSE 'failure' END AS source FROM b)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, source, CAST(CASE source WHEN 'foreground_sequence' THEN x1 WHEN 'detector' THEN x1 + 10 WHEN 'foreground_fallback' THEN 0 END AS INT) AS x1,
    CASE WHEN source = 'failure' THEN 'no usable region' END AS reason FROM d""")
def _(spark, sf):
    b = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *_READ_BOX.split(", "))

    def box(when: str, left: str, right: str = "x2"):
        return F.expr(f"IF({when}, named_struct('x1', CAST({left} AS INT), 'y1', y1, 'x2', CAST({right} AS INT), 'y2', y2), NULL)")

    chosen = G.first_usable({"foreground_sequence": box(_SEQUENCE, "x1"), "detector": box(_FAST, "x1 + 10"), "foreground_fallback": box(_FALLBACK, "0", "100")})
    return b.select("*", chosen.alias("roi")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "roi.source", "roi.box.x1", "roi.reason")


@query("dt10_sample_then_drop", "WITH s AS (SELECT doc_id FROM documents ORDER BY md5(concat('0:', cast(doc_id AS VARCHAR))) LIMIT 200) SELECT doc_id FROM s WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL)")
def _(spark, sf):
    """200 documents to label, less those that have a label: fewer than asked for, as the sample is drawn first."""
    drawn = table(spark, sf, "documents").select("doc_id").orderBy(F.md5(F.concat(F.lit("0:"), F.col("doc_id").cast("string")).cast("binary"))).limit(200)
    return drawn.join(table(spark, sf, "labels").where("quality IS NOT NULL").select("doc_id"), "doc_id", "left_anti")
