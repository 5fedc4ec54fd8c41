"""Where a satellite was: two-line elements, secular J2 motion, its place in a station's sky and its passes.

Positions follow mean elements with the secular drift that the Earth's oblateness causes and the stated
drag term, as in the published simplified perturbation theory without its short-period terms; that is good to tens of kilometres
near the epoch, which is what tells whether a satellite stood above a station's horizon.

Every step is a projection.  Terms used more than once have a column of their own, so that Kepler's equation is not written out
again for each use; steps that a query does not ask for are pruned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: Earth in kilometres and radians, WGS-72 as used with element sets
MU, RADIUS, J2, FLAT = 398600.8, 6378.135, 1.082616e-3, 1 / 298.26
E2 = FLAT * (2 - FLAT)
TURN = 2 * math.pi
# fixed values: the window, in days around a reading, that its time quality asks to search; others are not searched
WINDOWS = {1: (-0.010416, 0.010416), 3: (0.0, 0.041667), 4: (0.0, 1.0)}
#: steps of a block of times whose middle tells whether the satellite can come high enough, and the eccentricity above which all blocks are searched
BLOCK, ROUND = 8, 0.7
#: how fast the Earth turns, degrees a day, and how far geodetic and geocentric verticals may differ, degrees
EARTH_RATE, PLUMB = 360.98564736629, 0.2
#: qualities above this have no time to look up
WORST_QUALITY = 4
NEWTON, LATITUDE_STEPS = 8, 6


def _chain(df: DataFrame, *steps: tuple[str, Column]) -> DataFrame:
    for name, value in steps:
        df = df.withColumn(name, value)
    return df


def with_elements(df: DataFrame, line1: Column, line2: Column) -> DataFrame:
    """df with the mean elements and their secular rates, radians and seconds, in columns that begin with ``__``; null where the lines do not parse."""

    def part(line: Column, start: int, length: int) -> Column:
        return F.trim(F.substring(line, start, length)).try_cast("double")

    def deg(line: Column, start: int, length: int) -> Column:
        return F.radians(part(line, start, length))

    yy = part(line1, 19, 2).cast("int")
    year = yy + F.when(yy >= 57, 1900).otherwise(2000)
    day = F.round((part(line1, 21, 12) - 1) * 86400e6)
    n = F.col("__n")
    df = _chain(
        df,
        ("__epoch", F.unix_date(F.make_date(year, F.lit(1), F.lit(1))) * 86400.0 + day / 1e6),
        ("__drag", F.coalesce(F.replace(F.substring(line1, 34, 10), F.lit(" "), F.lit("")).try_cast("double"), F.lit(0.0))),
        ("__incl", deg(line2, 9, 8)), ("__node", deg(line2, 18, 8)), ("__ecc", F.concat(F.lit("0."), F.trim(F.substring(line2, 27, 7))).try_cast("double")),
        ("__peri", deg(line2, 35, 8)), ("__anom", deg(line2, 44, 8)), ("__n", part(line2, 53, 11) * TURN / 86400),
        ("__a", F.pow(MU / (n * n), F.lit(1 / 3))), ("__flatter", F.sqrt(1 - F.col("__ecc") * F.col("__ecc"))),
        ("__ci", F.cos("__incl")), ("__si", F.sin("__incl")),
        ("__ratio", J2 * F.pow(RADIUS / (F.col("__a") * F.col("__flatter") * F.col("__flatter")), F.lit(2.0))),
        ("__node_rate", -1.5 * n * F.col("__ratio") * F.col("__ci")),
        ("__peri_rate", 0.75 * n * F.col("__ratio") * (5 * F.col("__ci") * F.col("__ci") - 1)),
        ("__anom_rate", n + 0.75 * n * F.col("__ratio") * F.col("__flatter") * (3 * F.col("__ci") * F.col("__ci") - 1)),
    )
    return df.drop("__incl", "__ratio", "__n")


def with_position(df: DataFrame, seconds: str) -> DataFrame:
    """df of ``with_elements`` with the inertial place ``__x``, ``__y``, ``__z`` in kilometres and the sidereal angle ``__sid`` at a time."""
    dt, e = F.col("__dt"), F.col("__ecc")
    mean = F.col("__anom") + F.col("__anom_rate") * dt + F.col("__drag") * TURN * F.pow(dt / 86400, F.lit(2.0))
    df = _chain(df, ("__dt", F.col(seconds) - F.col("__epoch")), ("__mean", mean), ("__E", F.col("__mean")))
    E = F.col("__E")
    for _ in range(NEWTON):
        df = df.withColumn("__E", E - (E - e * F.sin(E) - F.col("__mean")) / (1 - e * F.cos(E)))
    node, peri = F.col("__node") + F.col("__node_rate") * dt, F.col("__peri") + F.col("__peri_rate") * dt
    p, q, ci = F.col("__p"), F.col("__q"), F.col("__ci")
    cp, sp, cn, sn = F.col("__cp"), F.col("__sp"), F.col("__cn"), F.col("__sn")
    df = _chain(
        df,
        ("__p", F.col("__a") * (F.cos(E) - e)), ("__q", F.col("__a") * F.col("__flatter") * F.sin(E)),
        ("__cp", F.cos(peri)), ("__sp", F.sin(peri)), ("__cn", F.cos(node)), ("__sn", F.sin(node)),
        ("__x", p * (cp * cn - sp * sn * ci) - q * (sp * cn + cp * sn * ci)),
        ("__y", p * (cp * sn + sp * cn * ci) - q * (sp * sn - cp * cn * ci)),
        ("__z", (p * sp + q * cp) * F.col("__si")),
        ("__sid", F.radians((280.46061837 + 360.98564736629 * (F.col(seconds) / 86400 + (2440587.5 - 2451545.0))) % 360)),
    )
    return df.drop("__dt", "__mean", "__E", "__p", "__q", "__cp", "__sp", "__cn", "__sn")


def with_ground(df: DataFrame) -> DataFrame:
    """df of ``with_position`` with sat_lat and sat_lon in degrees and sat_height in kilometres of the point below."""
    z, r, lat = F.col("__z"), F.col("__r"), F.col("__lat")
    df = _chain(df, ("__r", F.hypot("__x", "__y")), ("__lat", F.atan2("__z", "__r")))
    for _ in range(LATITUDE_STEPS):
        s = F.sin(lat)
        df = df.withColumn("__lat", F.atan2(z + RADIUS * E2 * s / F.sqrt(1 - E2 * s * s), r))
    height = r * F.cos(lat) + z * F.sin(lat) - RADIUS * F.sqrt(1 - E2 * F.sin(lat) * F.sin(lat))
    return _chain(df, ("sat_lat", F.degrees(lat)), ("sat_lon", F.degrees(F.pmod(F.atan2("__y", "__x") - F.col("__sid") + math.pi, F.lit(TURN)) - math.pi)), ("sat_height", height)).drop("__r", "__lat")


def with_sky(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """df of ``with_position`` with station_alt in degrees above the horizon and station_distance in kilometres."""
    cl, sl, ct, st, c = (F.col(f"__{n}") for n in ("cl", "sl", "ct", "st", "c"))
    dx, dy, dz = (F.col(f"__d{a}") for a in "xyz")
    up = (dx * cl * ct + dy * cl * st + dz * sl) / F.col("station_distance")
    df = _chain(
        df,
        ("__cl", F.cos(F.radians(lat))), ("__sl", F.sin(F.radians(lat))), ("__th", F.radians(lon) + F.col("__sid")), ("__ct", F.cos("__th")), ("__st", F.sin("__th")),
        ("__c", RADIUS / F.sqrt(1 - E2 * sl * sl)),
        ("__dx", F.col("__x") - c * cl * ct), ("__dy", F.col("__y") - c * cl * st), ("__dz", F.col("__z") - c * (1 - E2) * sl),
        ("station_distance", F.sqrt(dx * dx + dy * dy + dz * dz)),
        ("station_alt", F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), up))))),
    )
    return df.drop("__cl", "__sl", "__th", "__ct", "__st", "__c", "__dx", "__dy", "__dz")


def _usable(seconds: str, lat: str, lon: str, quality: str) -> Column:
    return F.col("__a").isNotNull() & F.col("__epoch").isNotNull() & F.col(seconds).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.coalesce(F.col(quality) <= WORST_QUALITY, F.lit(False))


def orbit_check(df: DataFrame, line1: str, line2: str, seconds: str, lat: str, lon: str, quality: str) -> DataFrame:
    """df with sat_lat, sat_lon, sat_height, station_alt, station_distance and flag, 1 at or below the horizon.

    Readings whose quality is above ``WORST_QUALITY`` or null, or that lack a time, a place or elements, get zeros and flag 1.
    Columns of df named like new ones are replaced; names that begin with two underscores are this module's own.
    """
    new = ("sat_lat", "sat_lon", "sat_height", "station_alt", "station_distance")
    df = df.drop(*new, "flag")
    own = df.columns
    out = with_sky(with_ground(with_position(with_elements(df, F.col(line1), F.col(line2)), seconds)), lat, lon)
    usable = _usable(seconds, lat, lon, quality)
    values = [F.when(usable, F.col(c)).otherwise(0.0).alias(c) for c in new]
    return out.select(*own, *values, F.when(usable & (F.col("station_alt") > 0), 0).otherwise(1).alias("flag"))


def _reach(dt: Column, span: float, least: float) -> Column:
    """Kilometres beyond which a satellite of ``with_elements``, dt seconds from its epoch, cannot come to an altitude within a span of seconds.

    At that altitude its distance follows from its greatest radius and the least one of the Earth; within the span, distance changes by no more
    than both speeds' bounds.
    """
    e = F.col("__ecc")
    far = F.col("__a") * (1 + e)
    low, sine, cosine = RADIUS * (1 - FLAT), math.sin(math.radians(least - PLUMB)), math.cos(math.radians(least - PLUMB))
    visible = F.sqrt(F.greatest(F.lit(0.0), far * far - (low * cosine) ** 2)) - low * sine
    mean_rate = F.abs("__anom_rate") + 2 * F.abs("__drag") * TURN * (dt + span) / 86400**2
    speed = F.col("__a") * mean_rate / (1 - e) + far * (F.abs("__node_rate") + F.abs("__peri_rate")) + RADIUS * math.radians(EARTH_RATE) / 86400
    return visible + speed * span


def passes(df: DataFrame, key: str, line1: str, line2: str, seconds: str, lat: str, lon: str, quality: str, least: float = 15.0, step: float = 60.0) -> DataFrame:
    """(key, event, event_seconds): rise and set at an altitude, and culminations above it, in the window of each reading's quality.

    key tells readings apart.  Each reading becomes a grid of times, ``step`` seconds apart, compared with their neighbours; a step in which the
    altitude crosses ``least`` is looked at again at parts of a second, of which the last before the crossing counts.  Blocks of ``BLOCK`` steps are left out where the
    satellite is too far at their middle to come to ``least`` within the block or a step beside it, by bounds of its speed, so no event is lost.  Readings are dealt by
    key first and with the session's number of partitions, as one of them is up to 1,441 times: grids stay in their task.
    """
    spark = df.sparkSession
    edge = [F.lit(None).cast("double")] * 2
    for q, w in WINDOWS.items():
        edge = [F.when(F.col(quality) == q, F.lit(d * 86400)).otherwise(other) for d, other in zip(w, edge, strict=True)]
    readings = with_elements(df.select(*dict.fromkeys((key, line1, line2, seconds, lat, lon, quality))), F.col(line1), F.col(line2))
    readings = readings.where(_usable(seconds, lat, lon, quality) & F.col(quality).isin(*WINDOWS)).drop(line1, line2)
    readings = readings.withColumn("__from", edge[0]).withColumn("__to", edge[1])
    readings = readings.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key)

    def altitude(points: DataFrame, *kept: str) -> DataFrame:
        # as rows of an array of one: a filter behind it would else be moved down to the scan, with all of the orbit written out in it
        return with_sky(with_position(points, "__t"), lat, lon).select(*kept, F.explode(F.array("station_alt")).alias("__alt"))

    last = F.ceil((F.col("__to") - F.col("__from")) / step)
    blocks = readings.withColumn("__last", last).withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("__last") / BLOCK))))
    blocks = blocks.withColumn("__t", F.col(seconds) + F.col("__from") + (F.col("__b") * BLOCK + (BLOCK - 1) / 2) * step)
    kept = [*readings.columns, "__last", "__b"]
    # as rows of an array of one, for the same reason as above
    near = with_sky(with_position(blocks, "__t"), lat, lon).select(*kept, "__t", F.explode(F.array("station_distance")).alias("__far"))
    near = near.where(~((F.col("__ecc") < ROUND) & (F.col("__far") > _reach(F.abs(F.col("__t") - F.col("__epoch")), (BLOCK + 1) / 2 * step, least)))).drop("__t", "__far")
    grid = near.withColumn("__i", F.explode(F.sequence(F.col("__b") * BLOCK, F.least("__last", F.col("__b") * BLOCK + BLOCK - 1)))).drop("__last", "__b")
    grid = grid.withColumn("__t", F.col(seconds) + F.col("__from") + F.col("__i") * step)
    own = [c for c in grid.columns if c not in ("__from", "__to", quality)]
    w = Window.partitionBy(key).orderBy("__i")
    near = altitude(grid, *own).withColumn("__last", F.lag("__alt").over(w)).withColumn("__next", F.lead("__alt").over(w))
    a, rising = F.col("__alt"), F.col("__alt") < least
    top = near.where((a > F.col("__last")) & (a >= F.col("__next")) & (a >= least)).select(key, F.lit("culminate").alias("event"), F.col("__t").alias("event_seconds"))
    parts = 1 << max(0, math.ceil(math.log2(step)))
    crossed = near.where(rising != (F.col("__next") < least)).withColumn("__rising", rising).withColumn("__begin", F.col("__t"))
    fine = crossed.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("__t", F.col("__begin") + F.col("__j") * (step / parts))
    fine = altitude(fine, key, "__begin", "__rising", "__j")
    event = F.when(F.col("__rising"), "rise").otherwise("set")
    edges = fine.where((F.col("__alt") < least) == F.col("__rising")).groupBy(key, "__begin", event.alias("event")).agg(F.max("__j").alias("__j"))
    return top.unionByName(edges.select(key, "event", (F.col("__begin") + F.col("__j") * (step / parts)).alias("event_seconds")))
