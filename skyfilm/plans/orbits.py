"""Satellite tracks of readings: place, height over a station's horizon, passes, and the check's summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import orbits as O
from .registry import query, table

LINE1 = "1 00424U 62049A   24001.50000000  .00000000  00000-0  00000-0 0  0000"
LINE2 = "2 00424  80.4600 120.0000 0023000  40.0000 320.0000 13.67000000 00000"


def _readings(spark, sf):
    """Events as readings of one satellite: a time, a station, and a time quality from 0 to 5."""
    e = table(spark, sf, "events").selectExpr("event_id", "unix_micros(CAST(ts AS TIMESTAMP)) / 1e6 AS s", "CAST(user_id % 120 - 60 AS DOUBLE) AS lat", "CAST(event_id % 360 - 180 AS DOUBLE) AS lon", "CAST(event_id % 6 AS INT) AS q")
    return e.withColumn("line1", F.lit(LINE1)).withColumn("line2", F.lit(LINE2))


_READINGS = "e AS (SELECT event_id, epoch_us(ts) / 1e6 AS s, (user_id % 120 - 60)::DOUBLE AS lat, (event_id % 360 - 180)::DOUBLE AS lon, (event_id % 6)::INT AS q FROM events)"
# the element set again, as numbers
_SET = f"""k AS (SELECT epoch_us(TIMESTAMP '2024-01-01 12:00:00') / 1e6 AS epoch, radians(80.46::DOUBLE) AS i, radians(120.0::DOUBLE) AS node, 0.0023::DOUBLE AS ecc, radians(40.0::DOUBLE) AS peri, radians(320.0::DOUBLE) AS anom,
        13.67::DOUBLE * 2 * pi() / 86400 AS n, pow({O.MU} / pow(13.67::DOUBLE * 2 * pi() / 86400, 2), 1.0::DOUBLE / 3) AS a),
    c AS (SELECT *, {O.J2}::DOUBLE * pow({O.RADIUS} / (a * (1 - ecc * ecc)), 2) * n AS j FROM k)"""


def _sky(points: str, name: str) -> str:
    """CTEs over points(event_id, s, lat, lon, q, t, ...): the satellite's vector, and its height over the station's horizon, at t."""
    kepler = "m"
    for _ in range(5):  # Kepler's equation by plain repetition: the ellipse is nearly round
        kepler = f"(m + ecc * sin({kepler}))"
    return f"""{name}_m AS (SELECT p.*, c.*, node - 1.5 * j * cos(i) * (t - epoch) AS o, peri + 0.75 * j * (5 * pow(cos(i), 2) - 1) * (t - epoch) AS w,
        anom + n * (t - epoch) + 0.75 * j * sqrt(1 - ecc * ecc) * (3 * pow(cos(i), 2) - 1) * (t - epoch) AS m,
        radians((280.46061837 + 360.98564736629 * (t / 86400 - 10957.5)) % 360) AS sid FROM {points} p, c),
    {name}_e AS (SELECT *, {kepler} AS ea FROM {name}_m),
    {name}_f AS (SELECT *, m + ecc * sin(m + ecc * sin(m + ecc * sin(ea))) AS ec FROM {name}_e),
    {name}_u AS (SELECT *, a * (1 - ecc * cos(ec)) AS r, w + 2 * atan2(sqrt(1 + ecc) * sin(ec / 2), sqrt(1 - ecc) * cos(ec / 2)) AS u FROM {name}_f),
    {name}_x AS (SELECT *, r * (cos(u) * cos(o) - sin(u) * sin(o) * cos(i)) AS x, r * (cos(u) * sin(o) + sin(u) * cos(o) * cos(i)) AS y, r * sin(u) * sin(i) AS z,
        [cos(radians(lat)) * cos(radians(lon) + sid), cos(radians(lat)) * sin(radians(lon) + sid), sin(radians(lat))] AS up, {O.RADIUS} / sqrt(1 - {O.E2} * pow(sin(radians(lat)), 2)) AS g FROM {name}_u),
    {name}_d AS (SELECT *, [x - g * up[1], y - g * up[2], z - g * (1 - {O.E2}) * up[3]] AS d FROM {name}_x),
    {name} AS (SELECT *, sqrt(list_inner_product(d, d)) AS far, degrees(asin(list_inner_product(d, up) / sqrt(list_inner_product(d, d)))) AS alt FROM {name}_d)"""


def _ground() -> str:
    lat = "atan2(z, hypot)"
    steps = []
    for k in range(O.LATITUDE_STEPS):
        last = f"b{k}" if k else "b"
        steps.append(f"b{k + 1} AS (SELECT *, atan2(z + {O.RADIUS * O.E2} * sin(la{k}) / sqrt(1 - {O.E2} * pow(sin(la{k}), 2)), hypot) AS la{k + 1} FROM {last})")
    return f"h AS (SELECT *, sqrt(x * x + y * y) AS hypot FROM sky), b AS (SELECT *, {lat} AS la0 FROM h), " + ", ".join(steps)


_LAST = f"la{O.LATITUDE_STEPS}"
_CHECKED = f"""{_READINGS}, {_SET}, pt AS (SELECT *, s AS t FROM e), {_sky('pt', 'sky')}, {_ground()},
    checked AS (SELECT event_id, q, CASE WHEN q > 4 THEN 0 ELSE degrees({_LAST}) END AS sat_lat,
        CASE WHEN q > 4 THEN 0 ELSE degrees(atan2(sin(atan2(y, x) - sid), cos(atan2(y, x) - sid))) END AS sat_lon,
        CASE WHEN q > 4 THEN 0 ELSE hypot * cos({_LAST}) + z * sin({_LAST}) - {O.RADIUS} * sqrt(1 - {O.E2} * pow(sin({_LAST}), 2)) END AS sat_height,
        CASE WHEN q > 4 THEN 0 ELSE alt END AS station_alt, CASE WHEN q > 4 THEN 0 ELSE far END AS station_distance, CASE WHEN q > 4 OR alt <= 0 THEN 1 ELSE 0 END AS flag FROM b{O.LATITUDE_STEPS})"""
_PLACES = ("sat_lat", "sat_lon", "sat_height", "station_alt", "station_distance")


def _checked(spark, sf):
    return O.orbit_check(_readings(spark, sf), "line1", "line2", "s", "lat", "lon", "q")


@query("or01_orbit_check", f"WITH {_CHECKED} SELECT event_id, q, {', '.join(f'CASE WHEN abs({c}) < 0.0005 THEN 0 ELSE round({c}, 3) END AS {c}' for c in _PLACES)}, flag FROM checked")
def _(spark, sf):
    return _checked(spark, sf).select("event_id", "q", *[F.when(F.abs(c) < 0.0005, 0.0).otherwise(F.round(c, 3)).alias(c) for c in _PLACES], "flag")


@query("or03_passes", f"""WITH {_READINGS}, {_SET}, w(q, lo, hi) AS (VALUES {', '.join(f'({q}, {lo * 86400!r}, {hi * 86400!r})' for q, (lo, hi) in O.WINDOWS.items())}),
    g AS (SELECT e.*, lo, unnest(range(0, ceil((hi - lo) / 60)::BIGINT + 1)) AS step FROM e JOIN w USING (q)), pt AS (SELECT *, s + lo + step * 60 AS t FROM g), {_sky('pt', 'sky')},
    n AS (SELECT event_id, s, lat, lon, q, t, step, alt, lag(alt) OVER v AS before, lead(alt) OVER v AS after FROM sky WINDOW v AS (PARTITION BY event_id ORDER BY step)),
    cr AS (SELECT event_id, s, lat, lon, q, t AS begins, alt < 15 AS rising FROM n WHERE (alt < 15) <> (after < 15)),
    fp AS (SELECT *, begins + part * 0.9375::DOUBLE AS t FROM (SELECT *, unnest(range(0, 64)) AS part FROM cr)), {_sky('fp', 'fine')}
    SELECT event_id, 'culminate' AS event, round(t, 3) AS event_seconds FROM n WHERE alt > before AND alt >= after AND alt >= 15
    UNION ALL SELECT event_id, CASE WHEN rising THEN 'rise' ELSE 'set' END, round(max(t), 3) FROM fine WHERE (alt < 15) = rising GROUP BY event_id, begins, rising""")
def _(spark, sf):
    return O.passes(_readings(spark, sf), "event_id", "line1", "line2", "s", "lat", "lon", "q").withColumn("event_seconds", F.round("event_seconds", 3))


@query("or05_track_qa", f"""WITH {_CHECKED}, n AS (SELECT flag, count(*) AS n FROM checked GROUP BY 1)
    SELECT flag, n, round(n / (SELECT sum(n) FROM n), 6) AS share, CASE WHEN flag = 0 THEN round(avg(station_distance), 3) END AS mean_distance, CASE WHEN flag = 0 THEN round(stddev_samp(station_distance), 3) END AS sd_distance,
        CASE WHEN flag = 0 THEN round(avg(station_alt), 3) END AS mean_alt, CASE WHEN flag = 0 THEN round(stddev_samp(station_alt), 3) END AS sd_alt FROM checked JOIN n USING (flag) GROUP BY flag, n""")
def _(spark, sf):
    from pyspark.sql import Window

    def seen(value):
        return F.when(F.col("flag") == 0, F.round(value, 3))

    by_flag = _checked(spark, sf).groupBy("flag").agg(
        F.count("*").alias("n"), F.avg("station_distance").alias("a"), F.stddev_samp("station_distance").alias("b"), F.avg("station_alt").alias("c"), F.stddev_samp("station_alt").alias("d"))
    share = F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6)
    return by_flag.select("flag", "n", share.alias("share"), seen("a").alias("mean_distance"), seen("b").alias("sd_distance"), seen("c").alias("mean_alt"), seen("d").alias("sd_alt"))
