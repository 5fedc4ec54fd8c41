"""Queries over pictures made of line items: pixels, runs, parts, profiles, lines and levels, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layers as L
from ..operators import peaks as PK
from ..operators import pixels as PX
from ..operators import runs as R
from ..operators import strips as ST
from ..operators.tables import dealt, stored
from .registry import query, table

# a picture of each supplier: quantity against part number, brighter where more lines meet
_PIXEL = ("l_suppkey AS k", "CAST(l_quantity AS INT) - 1 AS y", "CAST(l_partkey % 60 AS INT) AS x", "l_linenumber * 40 AS light")
_PX = f"px AS (SELECT k, y, x, CAST(least(255, sum(light)) AS INT) AS v FROM (SELECT {', '.join(_PIXEL)} FROM lineitem) GROUP BY ALL), size AS (SELECT k, max(y) + 1 AS height, max(x) + 1 AS width FROM px GROUP BY 1)"
_ROLLS = 10
_ROLL_PX = _PX.replace("px AS", "own AS").replace("size AS", "own_size AS").replace("FROM px", "FROM own") + f", px AS (SELECT k % {_ROLLS} AS k, y, x, v FROM own), size AS (SELECT k % {_ROLLS} AS k, height, width FROM own_size)"


def pixels(spark, sf):
    return dealt(table(spark, sf, "lineitem").selectExpr(*_PIXEL)).groupBy("k", "y", "x").agg(F.least(F.lit(255), F.sum("light")).cast("int").alias("v"))


def sized(spark, sf):
    """Pixels, and sizes as a stored table, which the line items tell without their sums."""
    return pixels(spark, sf), stored(PX.sizes(table(spark, sf, "lineitem").selectExpr(*_PIXEL)), "sizes")


def rolls(spark, sf):
    """Pixels and sizes of the pictures of each roll."""
    p = pixels(spark, sf)
    roll = F.col("k") % _ROLLS
    return p.withColumn("k", roll), PX.sizes(p).withColumn("k", roll)


_LABELS = """r AS (SELECT k, y, min(x) AS a, max(x) AS b, y * 4294967296 + min(x) AS id FROM (SELECT *, x - row_number() OVER (PARTITION BY k, y ORDER BY x) AS g FROM px) GROUP BY k, y, g),
    e AS (SELECT p.k, p.id AS u, q.id AS v FROM r p JOIN r q ON p.k = q.k AND abs(p.y - q.y) = 1 AND p.a <= q.b + 1 AND q.a <= p.b + 1),
    reach(k, n, m) AS (SELECT k, id, id FROM r UNION SELECT z.k, n, v FROM reach z JOIN e ON e.k = z.k AND e.u = m),
    lab AS (SELECT k, n, min(m) AS label FROM reach GROUP BY 1, 2),
    parts AS (SELECT r.k, label, sum(b - a + 1)::BIGINT AS area, min(a) AS "left", max(b) AS "right", min(y) AS top, max(y) AS bottom, sum((b - a + 1) * (a + b) // 2)::BIGINT AS sum_x, sum((b - a + 1) * y)::BIGINT AS sum_y
              FROM r JOIN lab ON lab.k = r.k AND n = id GROUP BY 1, 2)"""
_PARTS = f"{_PX}, {_LABELS}"


@query("im04_components", f"WITH RECURSIVE {_PARTS} SELECT k, label, area, \"left\", \"right\", top, bottom FROM parts WHERE area > 2 AND area < 60")
def _(spark, sf):
    return R.of_size(R.parts(pixels(spark, sf)), 2, 60).select("k", "label", "area", "left", "right", "top", "bottom")


@query("im16_centroids", f"""WITH RECURSIVE {_PARTS}, m AS (SELECT k, median(area) AS median_area FROM parts WHERE area > 2 AND area < 60 GROUP BY 1)
    SELECT k, label, CAST(round_even(sum_x / area, 0) AS INT) AS x, CAST(round_even(sum_y / area, 0) AS INT) AS y, median_area, CASE WHEN median_area < 5 THEN 'dot' ELSE 'num' END AS kind FROM parts JOIN m USING (k) WHERE area > 2 AND area < 60""")
def _(spark, sf):
    found = R.of_size(R.parts(pixels(spark, sf)), 2, 60)
    return R.with_centres(found).join(R.marks_of(found, 5.0), "k").select("k", "label", "x", "y", "median_area", "kind")


_FEATURES = {"area": "area", "height": "(bottom - top + 1)", "width": "(\"right\" - \"left\" + 1)", "box": "((bottom - top + 1) * (\"right\" - \"left\" + 1))"}


@query("dt11_size_features", f"WITH RECURSIVE {_PARTS} SELECT k, count(*) AS n, {', '.join(f'round(avg({e}), 6) AS mean_{c}, median({e}) AS median_{c}' for c, e in _FEATURES.items())} FROM parts GROUP BY 1")
def _(spark, sf):
    f = R.size_features(R.parts(pixels(spark, sf)))
    return f.withColumns({f"mean_{c}": F.round(f"mean_{c}", 6) for c in _FEATURES})


@query("im40_mark_sequence", f"""WITH RECURSIVE {_PARTS}, m AS (SELECT k, label, area, "left" AS x1, top AS y1, "right" + 1 AS x2, bottom + 1 AS y2 FROM parts WHERE area >= 3 AND bottom - top + 1 >= 2 AND ("right" - "left" + 1) / (bottom - top + 1) <= 2.5),
    t AS (SELECT k, median(y2 - y1) AS typical FROM m GROUP BY 1),
    s AS (SELECT *, coalesce((x1 - max(x2) OVER (PARTITION BY k ORDER BY x1, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > greatest(0.0, typical * 0.25))::INT, 0) AS fresh FROM m JOIN t USING (k)),
    c AS (SELECT k, island, typical, count(*) AS marks, max(x2) - min(x1) AS span, sum(area)::BIGINT AS area, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM (SELECT *, sum(fresh) OVER (PARTITION BY k ORDER BY x1, label ROWS UNBOUNDED PRECEDING) AS island FROM s) GROUP BY 1, 2, 3)
    SELECT k, x1, y1, x2, y2, marks, span, area FROM c WHERE marks >= 4 AND span >= typical * 1.5 QUALIFY row_number() OVER (PARTITION BY k ORDER BY least(marks, 15) DESC, abs(marks - 15), span DESC, area DESC, island) = 1""")
def _(spark, sf):
    return L.mark_sequence(R.parts(pixels(spark, sf)), 3, 2, least_marks=4, gap_heights=0.25, least_gap=0.0, span_heights=1.5)


def _sums(axis: str, length: str) -> str:
    return f"(SELECT s.k, i, coalesce(sum(v), 0)::BIGINT AS s FROM (SELECT k, unnest(range({length}))::INT AS i FROM size) s LEFT JOIN px ON px.k = s.k AND px.{axis} = i GROUP BY 1, 2)"


_AREA = f"""{_PX}, c AS {_sums('x', 'width')}, w AS {_sums('y', 'height')},
    lc AS (SELECT k, min(i) AS l, max(i) AS h FROM (SELECT *, sum(s) OVER (PARTITION BY k) AS t, count(*) OVER (PARTITION BY k) AS n FROM c) WHERE s * n > t AND i > 4 GROUP BY 1),
    lr AS (SELECT k, min(i) AS l, max(i) AS h FROM (SELECT *, sum(s) OVER (PARTITION BY k) AS t, count(*) OVER (PARTITION BY k) AS n FROM w) WHERE s * n > t GROUP BY 1),
    area AS (SELECT k, CASE WHEN ok THEN lc.l END AS "left", CASE WHEN ok THEN lc.h END AS "right", CASE WHEN ok THEN lr.l END AS top, CASE WHEN ok THEN lr.h END AS bottom, ok
             FROM (SELECT k, coalesce(lc.l < lc.h AND lr.l < lr.h, false) AS ok FROM size LEFT JOIN lc USING (k) LEFT JOIN lr USING (k)) LEFT JOIN lc USING (k) LEFT JOIN lr USING (k))"""


@query("im01_segment", f"WITH {_AREA} SELECT k, \"left\", \"right\", top, bottom, CASE WHEN ok THEN 'picture' ELSE 'loss' END AS class, CASE WHEN NOT ok THEN 'no picture found' END AS details FROM area")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.exposed_area(p, PX.sizes(p), 4)


@query("im02_crop", f"WITH {_AREA} SELECT k, CAST(y - top AS INT) AS y, CAST(x - \"left\" AS INT) AS x, v FROM px JOIN area USING (k) WHERE x >= \"left\" AND x < \"right\" AND y >= top AND y < bottom")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.cropped(p, PX.exposed_area(p, PX.sizes(p), 4))


@query("im05_group_limits", f"""WITH {_PX}, c AS {_sums('x', 'width')}, u AS (SELECT *, (count(*) OVER (PARTITION BY k) - 20) // 10 * 10 AS usable FROM c), g AS (SELECT k, i // 10 AS g, sum(s) AS s FROM u WHERE i < usable GROUP BY 1, 2)
    SELECT k, min(g)::BIGINT * 10 AS low, (max(g)::BIGINT + 1) * 10 AS high FROM (SELECT *, min(s) OVER (PARTITION BY k) AS least FROM g) WHERE s > least GROUP BY 1""")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.grouped_limits(PX.line_sums(p, PX.sizes(p), "x"))


@query("im06_trim_left", f"""WITH {_PX}, c AS {_sums('y', 'height')}, e AS (SELECT *, min(s) OVER (PARTITION BY k) AS lo, max(s) OVER (PARTITION BY k) AS hi FROM c),
    t AS (SELECT k, o AS "offset", min(i) AS low, max(i) AS high FROM e, (SELECT unnest(range(0, 100, 10))::INT AS o) WHERE hi > lo AND (s - lo) * 100 > o * (hi - lo) GROUP BY 1, 2)
    SELECT k, low, high, "offset" FROM t WHERE high - low <= 36 QUALIFY row_number() OVER (PARTITION BY k ORDER BY "offset") = 1""")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.narrowed_limits(PX.line_sums(p, PX.sizes(p), "y"), 36)


@query("im07_densest_window", f"""WITH {_PX}, t AS (SELECT k, least(10, height) AS height, least(21, width) AS width, height AS h, width AS w FROM size),
    n AS (SELECT *, unnest(range(0, h - height + 1, 3)) AS top FROM t), m AS (SELECT *, unnest(range(0, w - width + 1, 3)) AS "left" FROM n),
    s AS (SELECT m.k, top, "left", height, width, coalesce(sum(v), 0)::BIGINT AS total FROM m LEFT JOIN px ON px.k = m.k AND y >= top AND y < top + height AND x >= "left" AND x < "left" + width GROUP BY ALL)
    SELECT k, top, "left", height, width, total FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY total DESC, top, "left") = 1""")
def _(spark, sf):
    p = pixels(spark, sf)
    size = PX.sizes(p)
    return PX.densest_window(PX.dense(p, size), size, 10, 21, 3)


_STACK = f"""{_ROLL_PX}, st AS (SELECT k, count(*) AS n, floor(median(height))::INT AS height, floor(median(width))::INT AS width FROM size GROUP BY 1),
    grid AS (SELECT k, n, y, unnest(range(width))::INT AS x FROM (SELECT *, unnest(range(height))::INT AS y FROM st)),
    reached AS (SELECT g.k, y, x, n, count(s.k) AS c FROM grid g LEFT JOIN size s ON s.k = g.k AND s.height > y AND s.width > x GROUP BY ALL),
    total AS (SELECT k, y, x, sum(v) AS s FROM px GROUP BY ALL),
    stack AS (SELECT k, y, x, (n * (coalesce(s, 0) + n - c))::BIGINT AS v FROM reached LEFT JOIN total USING (k, y, x))"""


def _stack(spark, sf):
    return PX.stacked(*rolls(spark, sf))


@query("ag24_stack", f"WITH {_STACK} SELECT k, y, x, v FROM stack")
def _(spark, sf):
    return _stack(spark, sf)


_MEDIANS = f"{_STACK}, med AS (SELECT k, x AS i, median(v) AS m FROM stack GROUP BY 1, 2)"


@query("ag25_line_medians", f"WITH {_MEDIANS} SELECT k, i, m FROM med")
def _(spark, sf):
    return PX.line_medians(_stack(spark, sf), "x")


def _peaks_sql(profile: str, distance: int) -> str:
    """Peaks as rows, found with windows, correlated searches and a fold over lists."""
    bound = {side: f"(SELECT min(x.v) FROM lv x WHERE x.k = t.k AND x.j BETWEEN {low} AND {high})" for side, low, high in (("l", "coalesce(lj, 0) + 1", "t.j"), ("r", "t.j", "coalesce(rj, 1000000) - 1"))}
    return f"""{profile}, lv AS (SELECT k, v, min(i) AS a, max(i) AS b, row_number() OVER (PARTITION BY k ORDER BY min(i)) AS j FROM (SELECT *, i - row_number() OVER (PARTITION BY k, v ORDER BY i) AS g FROM prof) GROUP BY k, v, g),
        tops AS (SELECT k, j, v, (a + b) // 2 AS at_ FROM (SELECT *, lag(v) OVER w AS pv, lead(v) OVER w AS nv FROM lv WINDOW w AS (PARTITION BY k ORDER BY j)) WHERE v > pv AND v > nv),
        sides AS (SELECT t.k, t.j, t.v, t.at_, max(z.j) FILTER (z.j < t.j) AS lj, min(z.j) FILTER (z.j > t.j) AS rj FROM tops t LEFT JOIN lv z ON z.k = t.k AND z.v > t.v GROUP BY ALL),
        pk AS (SELECT k, v, at_, v - greatest({bound['l']}, {bound['r']}) AS p FROM sides t),
        kept AS (SELECT k, unnest(list_reduce(list([{{'at_': at_, 'v': v, 'p': p}}] ORDER BY v DESC, at_ DESC), lambda acc, x: CASE WHEN len(list_filter(acc, lambda q: abs(q.at_ - x[1].at_) < {distance})) > 0 THEN acc ELSE list_concat(acc, x) END)) AS q FROM pk GROUP BY k)"""


_PROFILE = f"{_MEDIANS}, prof AS (SELECT k, i, CASE WHEN hi = lo THEN 1.0 ELSE 1.0::DOUBLE - (m - lo) / (hi - lo) END AS v FROM (SELECT *, min(m) OVER (PARTITION BY k) AS lo, max(m) OVER (PARTITION BY k) AS hi FROM med))"


def _profiles(spark, sf, axis="x"):
    """Dark lines of the rolls' stacks stand high."""
    m = PX.line_medians(_stack(spark, sf), axis)
    a = m.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("p")).select("k", F.transform("p", lambda s: s["m"]).alias("p"))
    return a.select("k", F.transform(PK.unit_range(F.col("p")), lambda v: 1 - v).alias("p"))


@query("im12_peaks", f"WITH {_peaks_sql(_PROFILE, 5)} SELECT k, CAST(q.at_ AS INT) AS at_, round(q.v, 9) AS height, round(q.p, 9) AS prominence FROM kept WHERE q.p >= 0.1")
def _(spark, sf):
    found = _profiles(spark, sf).select("k", F.explode(F.filter(PK.peaks(F.col("p"), 5), lambda q: q["prominence"] >= 0.1)).alias("q"))
    return found.select("k", F.col("q.at").alias("at_"), F.round("q.height", 9).alias("height"), F.round("q.prominence", 9).alias("prominence"))


@query("im13_exact_peaks", f"""WITH {_peaks_sql(_PROFILE, 3)}, now AS (SELECT k, count(*) FILTER (q.p >= 0.1) AS now FROM kept GROUP BY 1),
    tried AS (SELECT k, s, 0.1::DOUBLE + s * 0.01::DOUBLE AS t, count(*) FILTER (q.p >= 0.1::DOUBLE + s * 0.01::DOUBLE) AS c FROM kept, (SELECT unnest(range(-9, 1001)) AS s) GROUP BY 1, 2),
    pick AS (SELECT k, t, c FROM tried JOIN now USING (k) WHERE CASE WHEN now > 5 THEN s > 0 AND (c <= 5 OR s = 1000) WHEN now < 5 THEN s < 0 AND (c >= 5 OR s = -9) ELSE s = 0 END QUALIFY row_number() OVER (PARTITION BY k ORDER BY abs(s)) = 1)
    SELECT k, round(t, 9) AS least, c = 5 AS hit, array_to_string(list(CAST(q.at_ AS INT) ORDER BY q.at_) FILTER (q.p >= t), ',') AS places FROM kept JOIN pick USING (k) GROUP BY k, t, c
    UNION ALL SELECT DISTINCT k, 0.01, false, '' FROM prof WHERE k NOT IN (SELECT k FROM kept)""")
def _(spark, sf):
    e = _profiles(spark, sf).select("k", PK.peaks(F.col("p"), 3).alias("f")).select("k", PK.exactly(F.col("f"), 5).alias("e"))
    return e.select("k", F.round("e.least", 9).alias("least"), "e.hit", F.array_join("e.at", ",").alias("places"))


_BINS = 60
_COORD = f"SELECT l_suppkey % {_ROLLS} AS k, CAST((l_partkey * l_linenumber) % 211 + l_quantity AS DOUBLE) AS c FROM lineitem"
_HIST = f"""co AS ({_COORD}), t AS (SELECT k, c FROM (SELECT *, avg(c) OVER (PARTITION BY k) AS m, stddev_pop(c) OVER (PARTITION BY k) AS s FROM co) WHERE abs(c - m) <= 3 * s),
    e AS (SELECT k, min(c) AS lo, max(c) AS hi FROM t GROUP BY 1),
    h AS (SELECT k, least(floor((c - lo) * {_BINS} / (hi - lo)), {_BINS - 1})::INT AS i, count(*) AS n FROM t JOIN e USING (k) GROUP BY 1, 2),
    f AS (SELECT e.k, g.i, lo, hi, coalesce(n, 0) AS n FROM e CROSS JOIN (SELECT unnest(range({_BINS}))::INT AS i) g LEFT JOIN h ON h.k = e.k AND h.i = g.i),
    prof AS (SELECT k, i, (n - min(n) OVER (PARTITION BY k)) / (max(n) OVER (PARTITION BY k) - min(n) OVER (PARTITION BY k))::DOUBLE AS v FROM f)"""


@query("im17_histogram_peaks", f"WITH {_peaks_sql(_HIST, 4)} SELECT k, round(lo + q.at_ * ((hi - lo) / {_BINS}), 6) AS place, round(q.p, 9) AS prominence FROM kept JOIN e USING (k) WHERE q.p >= 0.2")
def _(spark, sf):
    from ..operators.aggs import gathered

    c = table(spark, sf, "lineitem").selectExpr(f"l_suppkey % {_ROLLS} AS k", "CAST((l_partkey * l_linenumber) % 211 + l_quantity AS DOUBLE) AS c")
    h = gathered(c, "k", "c", _BINS).select("k", "low", "width", PK.unit_range(F.col("counts").cast("array<double>")).alias("p"))
    found = h.select("k", "low", "width", F.explode(F.filter(PK.peaks(F.col("p"), 4), lambda q: q["prominence"] >= 0.2)).alias("q"))
    return found.select("k", F.round(F.col("low") + F.col("q.at") * F.col("width"), 6).alias("place"), F.round("q.prominence", 9).alias("prominence"))


_ANGLES = tuple(range(0, 180, 15))
_VOTES = f"""{_PX}, d(angle, c, s) AS (VALUES {', '.join(str(d) for d in PX.directions(_ANGLES))}),
    turned AS (SELECT k, y, x, angle, CAST(floor((x * c + y * s + 512) / 1024) AS BIGINT) AS "offset" FROM px, d),
    votes AS (SELECT k, angle, "offset", count(*) AS votes FROM turned GROUP BY ALL HAVING count(*) >= 18),
    lines AS (SELECT * FROM votes a WHERE votes > coalesce((SELECT max(votes) FROM votes b WHERE b.k = a.k AND b.angle = a.angle AND b."offset" BETWEEN a."offset" - 2 AND a."offset" - 1), 0)
              AND votes >= coalesce((SELECT max(votes) FROM votes b WHERE b.k = a.k AND b.angle = a.angle AND b."offset" BETWEEN a."offset" + 1 AND a."offset" + 2), 0))"""


@query("im35_long_lines", f'WITH {_VOTES} SELECT k, angle, "offset", votes FROM lines')
def _(spark, sf):
    return PX.long_lines(pixels(spark, sf), _ANGLES, 18)


@query("im35_without_lines", f'WITH {_VOTES} SELECT k, y, x, v FROM px WHERE NOT EXISTS (SELECT 1 FROM turned t JOIN lines l ON l.k = t.k AND l.angle = t.angle AND abs(l."offset" - t."offset") <= 1 WHERE t.k = px.k AND t.y = px.y AND t.x = px.x)')
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.without_lines(p, PX.long_lines(p, _ANGLES, 18), _ANGLES, 1)


_LEVELS = f"""{_PX}, own AS (SELECT k, v AS level, count(*) AS n FROM px GROUP BY 1, 2), lit AS (SELECT k, sum(n) AS there FROM own GROUP BY 1),
    h AS (SELECT k, level, sum(n)::BIGINT AS n FROM (SELECT * FROM own UNION ALL SELECT k, 0, height * width - there FROM size JOIN lit USING (k) UNION ALL SELECT k, unnest(range(256))::INT, 0 FROM size) GROUP BY 1, 2),
    c AS (SELECT *, sum(n) OVER w AS n0, sum(n * level) OVER w AS s0, sum(n * n) OVER w AS q0, sum(n) OVER u AS an, sum(n * level) OVER u AS s_, sum(n * n) OVER u AS aq, max(n) OVER u AS most FROM h
          WINDOW w AS (PARTITION BY k ORDER BY level ROWS UNBOUNDED PRECEDING), u AS (PARTITION BY k)),
    m AS (SELECT *, n0::DOUBLE AS d0, (an - n0)::DOUBLE AS d1, s0 / nullif(n0, 0)::DOUBLE AS m0, (s_ - s0) / nullif(an - n0, 0)::DOUBLE AS m1 FROM c),
    ends AS (SELECT k, min(level) AS first_, max(level) AS last_, arg_max(level, n * 1000 - level) AS peak, max(n) AS top FROM h WHERE n > 0 GROUP BY 1),
    tri AS (SELECT h.k, level, top * abs(level - e) - n * abs(peak - e) AS below FROM (SELECT *, peak - first_ >= last_ - peak AS longer, CASE WHEN peak - first_ >= last_ - peak THEN first_ - 1 ELSE last_ + 1 END AS e FROM ends) z JOIN h ON h.k = z.k
            WHERE CASE WHEN longer THEN level BETWEEN first_ AND peak ELSE level BETWEEN peak AND last_ END)"""


def _best(score: str, source: str = "m") -> str:
    return f"(SELECT k, -max({{'s': {score}, 'l': -level}}).l AS t FROM {source} WHERE ({score}) IS NOT NULL GROUP BY 1)"


@query("dt20_thresholds", f"""WITH {_LEVELS} SELECT k, o.t AS otsu, y.t AS yen, t.t AS triangle, i.t AS isodata, h.t AS median FROM {_best("CASE WHEN d0 > 0 AND d1 > 0 THEN d0 * d1 * (m0 - m1) * (m0 - m1) END")} o
    FULL JOIN {_best("CASE WHEN d0 > 0 AND d1 > 0 AND q0 > 0 AND aq > q0 THEN d0 * d1 * d0 * d1 / (q0::DOUBLE * (aq - q0)::DOUBLE) END")} y USING (k) FULL JOIN {_best("below", "tri")} t USING (k)
    FULL JOIN {_best("CASE WHEN d0 > 0 AND d1 > 0 AND level >= floor((m0 + m1) / 2) THEN -level END")} i USING (k) FULL JOIN {_best("CASE WHEN n0 * 2 >= an THEN -level END")} h USING (k)""")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.thresholds(PX.level_counts(p, PX.sizes(p)))


@query("im24_noise", f"""WITH {_PX}, w(dy, dx, w) AS (VALUES {', '.join(str(s) for s in PX._LAPLACE)}), d AS (SELECT k, y + dy AS y, x + dx AS x, sum(v * w) AS d FROM px, w GROUP BY ALL)
    SELECT s.k, coalesce(sum(abs(d)), 0)::BIGINT AS response, round(sqrt(pi() / 2) * coalesce(sum(abs(d)), 0) / (6 * (width - 2) * (height - 2)), 9) AS sigma
    FROM size s LEFT JOIN d ON d.k = s.k AND y > 0 AND x > 0 AND y < height - 1 AND x < width - 1 GROUP BY s.k, width, height""")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.laplacian_noise(p, PX.sizes(p)).withColumn("sigma", F.round("sigma", 9))


@query("im25_two_layers", """WITH v AS (SELECT l_suppkey AS k, l_quantity * l_linenumber AS v FROM lineitem), m AS (SELECT k, median(v) AS m FROM v GROUP BY 1), d AS (SELECT k, median(abs(v - m)) AS mad FROM v JOIN m USING (k) GROUP BY 1),
    kept AS (SELECT k, v::DOUBLE AS v FROM v JOIN m USING (k) JOIN d USING (k) WHERE mad = 0 OR abs(v - m) <= 2 * mad),
    c AS (SELECT k, v, count(*)::DOUBLE AS c FROM kept GROUP BY 1, 2),
    s AS (SELECT *, sum(c) OVER w AS n0, sum(c * v) OVER w AS s0, sum(c * v * v) OVER w AS q0, sum(c) OVER u AS n1, sum(c * v) OVER u AS s1, sum(c * v * v) OVER u AS q1 FROM c WINDOW w AS (PARTITION BY k ORDER BY v ROWS UNBOUNDED PRECEDING), u AS (PARTITION BY k)),
    z AS (SELECT *, sqrt(greatest(q0 / n0 - (s0 / n0) * (s0 / n0), 0)) + sqrt(greatest((q1 - q0) / (n1 - n0) - ((s1 - s0) / (n1 - n0)) * ((s1 - s0) / (n1 - n0)), 0)) AS cost FROM s WHERE n1 > n0)
    SELECT k, n1::BIGINT AS n, v AS cut, n0::BIGINT AS "lower", round(cost, 9) AS cost FROM z QUALIFY row_number() OVER (PARTITION BY k ORDER BY cost, v) = 1""")
def _(spark, sf):
    v = table(spark, sf, "lineitem").selectExpr("l_suppkey AS k", "CAST(l_quantity * l_linenumber AS DOUBLE) AS v")
    return L.two_layers(L.within_mads(v, ["k"], "v", 2.0), ["k"], "v").withColumn("cost", F.round("cost", 9))


_DENSE = f"{_PX}, grid AS (SELECT k, y, unnest(range(width))::INT AS x, height, width FROM (SELECT *, unnest(range(height))::INT AS y FROM size)), dense AS (SELECT g.k, g.y, g.x, height, width, coalesce(v, 0) AS v FROM grid g LEFT JOIN px ON px.k = g.k AND px.y = g.y AND px.x = g.x)"


_AROUND = "s.k = d.k AND s.y = d.y + a.o AND s.x = d.x + b.o GROUP BY ALL"


@query("im08_cleaned_marks", f"""WITH {_STACK}, o AS (SELECT unnest(range(-2, 3))::INT AS o), i AS (SELECT unnest(range(-1, 2))::INT AS o), z AS (SELECT k, max(y) AS my, max(x) AS mx FROM stack GROUP BY 1),
    blur AS (SELECT d.k, d.y, d.x, quantile_disc(s.v, 0.5) AS v FROM stack d JOIN z ON z.k = d.k, o a, o b, stack s WHERE s.k = d.k AND s.y = least(greatest(d.y + a.o, 0), my) AND s.x = least(greatest(d.x + b.o, 0), mx) GROUP BY ALL),
    low AS (SELECT d.k, d.y, d.x, min(s.v) AS v FROM blur d, i a, i b, blur s WHERE {_AROUND}), high AS (SELECT d.k, d.y, d.x, max(s.v) AS v FROM low d, i a, i b, low s WHERE {_AROUND})
    SELECT k, y, x, CAST(CASE WHEN v > 1500 THEN 255 ELSE 0 END AS INT) AS v FROM high""")
def _(spark, sf):
    return PX.cleaned_marks(_stack(spark, sf), 1500)


@query("im10_turned", f"""WITH {_PX}, m AS (SELECT k, y, x, v, height, width, CASE WHEN k % 3 = 0 THEN width - 1 - x ELSE x END AS fx FROM px JOIN size USING (k))
    SELECT k, CAST(CASE WHEN k % 2 = 0 THEN height - 1 - y ELSE y END AS INT) AS y, CAST(CASE WHEN k % 2 = 0 THEN width - 1 - fx ELSE fx END AS INT) AS x, v FROM m""")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.turned(p, PX.sizes(p), F.col("k") % 3 == 0, F.col("k") % 2 == 0)


_MASK = f"{_PX}, mask AS (SELECT k, y, x FROM px WHERE v >= 120 AND NOT (y BETWEEN 9 AND 11) AND NOT (x BETWEEN 29 AND 31))"


@query("im20_trace", f"""WITH {_MASK}, n AS (SELECT *, unnest(range(0, height - least(10, height) + 1, 5)) AS top FROM size), w AS (SELECT *, unnest(range(0, width - least(10, width) + 1, 5)) AS "left" FROM n),
    s AS (SELECT w.k, top, "left", height, width, count(m.y) AS total FROM w LEFT JOIN mask m ON m.k = w.k AND m.y >= top AND m.y < top + 10 AND m.x >= "left" AND m.x < "left" + 10 GROUP BY ALL),
    f AS (SELECT s.k, top, "left" FROM s JOIN (SELECT k, count(*) AS a FROM mask GROUP BY 1) USING (k) WHERE total * height * width > 1.5 * a * least(10, height) * least(10, width))
    SELECT DISTINCT m.k, y, x FROM mask m JOIN f ON f.k = m.k AND y >= top AND y < top + 10 AND x >= "left" AND x < "left" + 10""")
def _(spark, sf):
    """The echo trace: bright pixels off the grid lines, in parts that are denser than the picture."""
    p = pixels(spark, sf)
    return PX.dense_parts(PX.without_grid(p.where("v >= 120"), [10], [30], 3), PX.sizes(p), 10, 5, 1.5)


@query("im31_bottom_strip", f"WITH {_PX} SELECT k, CAST(y - height + 20 AS INT) AS y, x, v FROM px JOIN size USING (k) WHERE height >= 20 AND y - height + 20 BETWEEN 2 AND 17")
def _(spark, sf):
    p = pixels(spark, sf)
    return PX.bottom_strip(p, PX.sizes(p), 20, 2)


@query("im34_foreground", f"""WITH {_PX}, t AS (SELECT k, height * width AS a, (SELECT count(*) FROM px WHERE px.k = size.k AND v >= 40 * (1 + size.k % 2)) AS w FROM size)
    SELECT k, CASE WHEN w < a - w THEN 255 ELSE 0 END AS colour, CAST(least(w, a - w) AS BIGINT) AS pixels FROM t""")
def _(spark, sf):
    p = pixels(spark, sf)
    binary = p.where(F.col("v") >= 40 * (1 + F.col("k") % 2)).withColumn("v", F.lit(255))
    return PX.foreground(PX.level_counts(binary, PX.sizes(p)))


@query("dt21_peak_places", f"WITH {_peaks_sql(_PROFILE, 5)} SELECT CAST(q.at_ AS INT) AS at_, count(*) AS n, round(avg(q.p), 9) AS mean FROM kept WHERE q.p >= 0.05 GROUP BY 1")
def _(spark, sf):
    """Where the rolls' grid lines fall, from which usual places are taken."""
    found = _profiles(spark, sf).select("k", F.explode(PK.peaks(F.col("p"), 5)).alias("q")).where("q.prominence >= 0.05")
    return found.groupBy(F.col("q.at").alias("at_")).agg(F.count("*").alias("n"), F.round(F.avg("q.prominence"), 9).alias("mean"))


# margins as wide as what is left of these small pictures
_SMALL = {"widest": 34, "window": (4, 20, 2), "least": (5, 3)}


def _margin_window() -> str:
    """The fullest window of margins that are not at the left."""
    tall, wide, step = _SMALL["window"]
    return f"""mw AS (SELECT *, least({tall}, h) AS tall, least({wide}, w) AS wide FROM mg WHERE side <> 'left' AND h > 0 AND w > 0), mt AS (SELECT *, unnest(range(0, h - tall + 1, {step})) AS t FROM mw), ml AS (SELECT *, unnest(range(0, w - wide + 1, {step})) AS l FROM mt),
    ms AS (SELECT ml.k, t, l, tall, wide, coalesce(sum(v), 0) AS total FROM ml LEFT JOIN mp ON mp.k = ml.k AND my >= t AND my < t + tall AND mx >= l AND mx < l + wide GROUP BY ALL),
    mb AS (SELECT k, t, t + tall AS b, l, l + wide AS r FROM ms WHERE total > 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY total DESC, t, l) = 1)"""


@query("im11_trimmed_margins", f"""WITH {_AREA}, sd AS (SELECT a.k, height, width, "left", "right", top, bottom, CASE WHEN ok THEN CASE WHEN la >= greatest(ra, ta, ba) THEN 'left' WHEN ra >= greatest(ta, ba) THEN 'right' WHEN ta >= ba THEN 'top' ELSE 'bottom' END END AS side
      FROM (SELECT *, "left" * height AS la, (width - "right") * height AS ra, top * width AS ta, (height - bottom) * width AS ba FROM area JOIN size USING (k)) a),
    mg AS (SELECT k, side, CASE side WHEN 'bottom' THEN bottom ELSE 0 END AS y0, CASE side WHEN 'right' THEN "right" ELSE 0 END AS x0, CASE side WHEN 'top' THEN top WHEN 'bottom' THEN height - bottom ELSE height END AS h, CASE side WHEN 'left' THEN "left" WHEN 'right' THEN width - "right" ELSE width END AS w FROM sd WHERE side IS NOT NULL),
    mp AS (SELECT k, y - y0 AS my, x - x0 AS mx, v FROM px JOIN mg USING (k) WHERE y >= y0 AND y < y0 + h AND x >= x0 AND x < x0 + w),
    lp AS (SELECT mg.k, i.i, coalesce(sum(v), 0) AS s FROM mg JOIN (SELECT unnest(range(50)) AS i) i ON i.i < h LEFT JOIN mp ON mp.k = mg.k AND my = i.i WHERE side = 'left' AND w > 0 GROUP BY 1, 2),
    le AS (SELECT *, min(s) OVER (PARTITION BY k) AS lo, max(s) OVER (PARTITION BY k) AS hi FROM lp),
    lt AS (SELECT k, o, min(i) AS t, max(i) AS b FROM le, (SELECT unnest(range(0, 100, 10)) AS o) WHERE hi > lo AND (s - lo) * 100 > o * (hi - lo) GROUP BY 1, 2),
    lb AS (SELECT k, t, b + 1 AS b, 0 AS l, w AS r FROM lt JOIN mg USING (k) WHERE b - t <= {_SMALL['widest']} QUALIFY row_number() OVER (PARTITION BY k ORDER BY o) = 1), {_margin_window()},
    al AS (SELECT sd.k, sd.side, h, w, t, b, l, r, CASE WHEN sd.side IS NULL THEN 'no picture found' WHEN CASE WHEN sd.side = 'left' THEN w < {_SMALL['least'][0]} ELSE h < {_SMALL['least'][1]} END THEN 'margin too small' WHEN t IS NULL THEN 'margin without marks' END AS details
           FROM sd LEFT JOIN mg USING (k) LEFT JOIN (SELECT * FROM lb UNION ALL SELECT * FROM mb) z ON z.k = sd.k)
    SELECT k, side, CASE WHEN details IS NULL THEN t END::INT AS low, CASE WHEN details IS NULL THEN b END::INT AS high, CASE WHEN details IS NULL THEN l END::INT AS "left", CASE WHEN details IS NULL THEN r END::INT AS "right",
           CASE WHEN side IS NULL THEN 'loss' WHEN details IS NOT NULL THEN 'outlier' ELSE 'label' END AS class, details FROM al""")
def _(spark, sf):
    """The label of every scan, or why it has none: exposed area, largest margin, trimmed margin, size limits."""
    p, size = sized(spark, sf)
    return ST.trimmed_margins(p, size, PX.exposed_area(p, size, 4), **_SMALL)


_STRIP = {"rows": 40, "line": 16, "padding": 1, "part": (1, 60)}
_MASKED = f"""{_PX.replace("px AS", "all_px AS").replace("FROM px", "FROM all_px")}, own AS (SELECT k, {_STRIP['rows']} AS height, width FROM size WHERE height >= {_STRIP['rows']}),
    st AS (SELECT k, y - size.height + {_STRIP['rows']} AS y, x, v FROM all_px JOIN size USING (k) WHERE size.height >= {_STRIP['rows']} AND y >= size.height - {_STRIP['rows']}),
    sv AS (SELECT k, y, x, CAST(floor(v * 255 / max(v) OVER (PARTITION BY k)) AS INT) AS v FROM st),
    gr AS (SELECT k, y, unnest(range(width))::INT AS x FROM (SELECT *, unnest(range(height))::INT AS y FROM own)), dn AS (SELECT gr.k, gr.y, gr.x, coalesce(v, 0) AS v FROM gr LEFT JOIN sv ON sv.k = gr.k AND sv.y = gr.y AND sv.x = gr.x),
    h AS (SELECT k, v AS level, count(*) AS n FROM dn GROUP BY 1, 2), hc AS (SELECT *, sum(n) OVER w AS n0, sum(n * level) OVER w AS s0, sum(n) OVER u AS an, sum(n * level) OVER u AS s_ FROM h WINDOW w AS (PARTITION BY k ORDER BY level ROWS UNBOUNDED PRECEDING), u AS (PARTITION BY k)),
    ot AS (SELECT k, CAST(floor(-max({{'s': n0::DOUBLE * (an - n0)::DOUBLE * (s0 / n0::DOUBLE - (s_ - s0) / (an - n0)::DOUBLE) * (s0 / n0::DOUBLE - (s_ - s0) / (an - n0)::DOUBLE), 'l': -level}}).l * 0.75) AS INT) AS level FROM hc WHERE n0 < an GROUP BY 1),
    br AS (SELECT dn.k, y, x, v > level AS bright FROM dn JOIN ot USING (k)), ra AS (SELECT k, 2 * count(*) FILTER (bright) < count(*) AS rare FROM br GROUP BY 1), mk AS (SELECT k, y, x FROM br JOIN ra USING (k) WHERE bright = rare),
    vt AS (SELECT k, y AS o, count(*) AS n FROM mk GROUP BY 1, 2 HAVING count(*) >= {_STRIP['line']}),
    ln AS (SELECT * FROM vt a WHERE n > coalesce((SELECT max(n) FROM vt b WHERE b.k = a.k AND b.o BETWEEN a.o - 2 AND a.o - 1), 0) AND n >= coalesce((SELECT max(n) FROM vt b WHERE b.k = a.k AND b.o BETWEEN a.o + 1 AND a.o + 2), 0)),
    ed AS (SELECT k, max(o) FILTER (o < {_STRIP['rows'] // 2}) AS above, min(o) FILTER (o >= {_STRIP['rows'] // 2}) AS below FROM ln GROUP BY 1),
    px AS (SELECT mk.k, y, x FROM mk LEFT JOIN ed USING (k) WHERE (above IS NULL OR y > above + {_STRIP['padding']}) AND (below IS NULL OR y < below - {_STRIP['padding']}))"""
_STRIPS = f"""{_MASKED}, {_LABELS}, kp AS (SELECT k, count(*) AS parts, sum(area)::BIGINT AS area FROM parts WHERE area > {_STRIP['part'][0]} AND area < {_STRIP['part'][1]} GROUP BY 1),
    es AS (SELECT k, string_agg(o, ',' ORDER BY o) AS edge_rows FROM ln GROUP BY 1),
    done AS (SELECT k, CASE WHEN height < {_STRIP['rows']} THEN 'too short' WHEN level IS NULL THEN 'one colour' WHEN parts IS NULL THEN 'empty' ELSE 'ok' END AS status, level, coalesce(edge_rows, '') AS edge_rows, coalesce(parts, 0) AS parts, coalesce(area, 0) AS area
             FROM size LEFT JOIN ot USING (k) LEFT JOIN es USING (k) LEFT JOIN kp USING (k))"""


def _strips(spark, sf):
    return ST.prepared_strips(*sized(spark, sf), **_STRIP)


@query("im32_prepared", f"WITH RECURSIVE {_STRIPS} SELECT * FROM done")
def _(spark, sf):
    return _strips(spark, sf)


@query("im33_preparation_summary", f"WITH RECURSIVE {_STRIPS} SELECT status, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM done GROUP BY 1")
def _(spark, sf):
    """A run over what an earlier run has not done, both put together and counted by status."""
    from ..operators.joins import worklist

    p, size = sized(spark, sf)
    first = stored(ST.prepared_strips(p.where("k % 3 = 0"), size.where("k % 3 = 0"), **_STRIP), "strips")
    rest = worklist(p, first, ["k"])
    return ST.summary(first.unionByName(ST.prepared_strips(rest, worklist(size, first, ["k"]), **_STRIP)))


@query("dt19_blank_outside", f"WITH {_MASKED} SELECT k, y, x FROM px")
def _(spark, sf):
    mask, lines, _, own = ST.strip_marks(*sized(spark, sf), _STRIP["rows"], line=_STRIP["line"])
    return ST.blank_outside(mask, lines, own, _STRIP["padding"]).select("k", "y", "x")


@query("im36_tiles", f"""WITH {_PX}, z AS (SELECT k, height, width, greatest(1, CAST(floor(width * 64 / height) AS INT)) AS tw FROM size), t AS (SELECT *, unnest(CASE WHEN tw <= 40 THEN [0] ELSE list_append(range(0, tw - 40, 30), tw - 40) END)::INT AS start FROM z),
    ty AS (SELECT *, unnest(range(64)) AS ty FROM t), g AS (SELECT *, unnest(range(start, least(start + 40, tw))) AS tx FROM ty)
    SELECT g.k, start, ty::INT AS y, (tx - start)::INT AS x, v FROM g JOIN px ON px.k = g.k AND px.y = ty * height // 64 AND px.x = tx * width // tw""")
def _(spark, sf):
    return ST.tiled(*ST.resized(*sized(spark, sf), 64), 40, 10)


@query("im14_picture_grid")
def _(spark, sf):
    """Lines of every roll's own grid, from its stack of pictures to the map of frequencies and depths."""
    from ..functions import grids as GR

    across = _profiles(spark, sf, "y").select("k", PK.prominent(PK.peaks(F.col("p"), 5), 0.1).alias("across"))
    lines = _profiles(spark, sf).select("k", PK.prominent(PK.peaks(F.col("p"), 5), 0.1).alias("found"), PK.exactly(PK.peaks(F.col("p"), 30), len(GR.FREQUENCIES))["at"].alias("adjusted"))
    return lines.join(across, "k").select("k", GR.frequency_lines(F.col("found"), F.col("adjusted")).alias("frequencies"), GR.depth_lines(F.col("across")).alias("depths"))


_TILES = 4
_EQUAL = f"""{_PX}, gr AS (SELECT k, height, width, y, unnest(range(width))::INT AS x FROM (SELECT *, unnest(range(height))::INT AS y FROM size)), dn AS (SELECT gr.*, coalesce(v, 0) AS v, ceil(height / {_TILES})::INT AS th, ceil(width / {_TILES})::INT AS tw FROM gr LEFT JOIN px ON px.k = gr.k AND px.y = gr.y AND px.x = gr.x),
    mi AS (SELECT k, th, tw, v, (CASE WHEN a AND b THEN 2 * height - 1 - y WHEN a THEN 2 * height - 1 - y ELSE y END) AS y, (CASE WHEN b THEN 2 * width - 1 - x ELSE x END) AS x FROM dn, (SELECT unnest([false, true]) AS a), (SELECT unnest([false, true]) AS b)
           WHERE (NOT a OR (2 * height - 1 - y >= height AND 2 * height - 1 - y < th * {_TILES})) AND (NOT b OR (2 * width - 1 - x >= width AND 2 * width - 1 - x < tw * {_TILES}))),
    ct AS (SELECT k, th, tw, y // th AS ty, x // tw AS tx, v AS level, count(*) AS n FROM mi GROUP BY ALL),
    cl AS (SELECT *, sum(greatest(n - greatest(floor(2.0 * th * tw / 256), 1), 0)) OVER (PARTITION BY k, ty, tx) AS over_, least(n, greatest(floor(2.0 * th * tw / 256), 1)) AS m FROM ct),
    al AS (SELECT k, ty, tx, any_value(th) AS th, any_value(tw) AS tw, any_value(over_) AS over_ FROM cl GROUP BY 1, 2, 3), lv AS (SELECT al.*, l.level FROM al, (SELECT unnest(range(256))::INT AS level) l),
    sh AS (SELECT lv.k, lv.ty, lv.tx, lv.level, least(round_even((sum(coalesce(m, 0)) OVER (PARTITION BY lv.k, lv.ty, lv.tx ORDER BY lv.level ROWS UNBOUNDED PRECEDING) + (lv.level + 1) * lv.over_ / 256) * 255 / (lv.th * lv.tw), 0), 255) AS shade
           FROM lv LEFT JOIN cl ON cl.k = lv.k AND cl.ty = lv.ty AND cl.tx = lv.tx AND cl.level = lv.level),
    md AS (SELECT *, (y + 0.5::DOUBLE) / th - 0.5::DOUBLE AS my, (x + 0.5::DOUBLE) / tw - 0.5::DOUBLE AS mx FROM dn),
    ak AS (SELECT k, y, x, v, least(greatest(floor(my) + i, 0), {_TILES - 1}) AS ty, least(greatest(floor(mx) + j, 0), {_TILES - 1}) AS tx, (CASE i WHEN 1 THEN my - floor(my) ELSE 1 - (my - floor(my)) END) * (CASE j WHEN 1 THEN mx - floor(mx) ELSE 1 - (mx - floor(mx)) END) AS w
           FROM md, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j))"""


@query("im32_equalised", f"WITH {_EQUAL} SELECT ak.k, y, x, CAST(round_even(round(sum(w * shade), 9), 0) AS INT) AS v FROM ak JOIN sh ON sh.k = ak.k AND sh.ty = ak.ty AND sh.tx = ak.tx AND sh.level = ak.v GROUP BY ALL")
def _(spark, sf):
    p = pixels(spark, sf)
    size = PX.sizes(p)
    return PX.equalised(PX.dense(p, size), size, _TILES)
