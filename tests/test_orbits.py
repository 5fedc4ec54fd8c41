"""Orbits as Spark plans against plain array code, one reading at a time."""

import numpy as np
from pyspark.sql import functions as F

from skyfilm.operators import orbits as O
from skyfilm.plans.orbits import LINE1, LINE2
from tests import plain_orbit as plain

OLD1 = "1 00424U 62049A   62275.25000000  .00000012  00000-0  00000-0 0  0000"
OLD2 = "2 00424  80.4600  20.0000 1230000  70.0000 300.0000 13.67000000 00000"
ODD = [(LINE1, LINE2, None, 1.0, 1.0, 1), (LINE1, LINE2, 1.7e9, None, 1.0, 1), (LINE1, LINE2, 1.7e9, 1.0, 1.0, 5), (LINE1, LINE2, 1.7e9, 1.0, 1.0, None), (None, LINE2, 1.7e9, 1.0, 1.0, 1), ("short", "also", 1.7e9, 1.0, 1.0, 1)]
SCHEMA = "line1 string, line2 string, s double, lat double, lon double, q int, id long, flag string"
ARGS = ("line1", "line2", "s", "lat", "lon", "q")


def readings(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        a, b = (LINE1, LINE2) if i % 2 else (OLD1, OLD2)
        s = float(plain.parse_elements(a, b)["epoch"] + rng.uniform(-20, 20) * 86400)
        rows.append((a, b, s, float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180)), i % 5))
    return rows, spark.createDataFrame([(*r, i, "own") for i, r in enumerate(rows + ODD)], SCHEMA)


def test_places_equal_plain_code(spark):
    rows, df = readings(spark)
    got = {r.id: r for r in O.orbit_check(df, *ARGS).collect()}
    assert len(got) == len(rows) + len(ODD)
    for i, (a, b, s, lat, lon, _) in enumerate(rows):
        e, t = plain.parse_elements(a, b), np.array([s])
        xyz = plain.position(e, t)
        want = [x[0] for x in (*plain.ground_point(xyz, t), *plain.seen_from(xyz, t, np.array([lat]), np.array([lon])))]
        r = got[i]
        assert np.allclose([r.sat_lat, r.sat_lon, r.sat_height, r.station_alt, r.station_distance], want, atol=1e-5)
        assert r.flag == int(want[3] <= 0)
    for i in range(len(rows), len(rows) + len(ODD)):
        assert (got[i].sat_lat, got[i].station_distance, got[i].flag) == (0.0, 0.0, 1)


def test_passes_equal_plain_code(spark):
    rows, df = readings(spark)
    got = {}
    for r in O.passes(df, "id", *ARGS).collect():
        got.setdefault(r.id, []).append((r.event_seconds, r.event))
    seen = 0
    for i, (a, b, s, lat, lon, q) in enumerate(rows):
        lo, hi = plain.WINDOWS.get(q, (0, -1))
        want = plain.passes(plain.parse_elements(a, b), s + lo * 86400, s + hi * 86400, lat, lon) if q in plain.WINDOWS else []
        own = sorted(got.get(i, []))
        assert [n for _, n in own] == [n for n, _ in sorted(want, key=lambda x: (x[1], x[0]))]
        assert np.allclose([t for t, _ in own], sorted(t for _, t in want), atol=1e-3)
        seen += len(want)
    assert seen > 20 and not set(got) & set(range(len(rows), len(rows) + len(ODD)))


def test_grids_stay_in_their_task(spark):
    _, df = readings(spark)
    plan = O.passes(df, "id", *ARGS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3 and "Python" not in plan
    assert O.passes(df.where("id < 0"), "id", *ARGS).count() == 0 and O.orbit_check(df.where(F.lit(False)), *ARGS).count() == 0


def test_blocks_out_of_reach_are_left_out(spark, monkeypatch):
    """Few times of a day are worth a look, and none that matters is lost."""
    _, df = readings(spark)
    few = sorted(O.passes(df, "id", *ARGS).collect())
    assert "__far" in O.passes(df, "id", *ARGS)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(O, "ROUND", 0.0)
    assert few and few == sorted(O.passes(df, "id", *ARGS).collect())
