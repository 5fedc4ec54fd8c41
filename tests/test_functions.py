"""Kernels, orbit, sources and streams on small invented cases."""

import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyfilm.functions import geometry as G
from tests import plain_kernels as K
from tests import plain_orbit as orbit
from skyfilm.functions import timeq
from skyfilm.functions import parse as P
from skyfilm.operators import clean as C
from skyfilm.operators import joins as J
from skyfilm.operators import sampling as S
from skyfilm.operators import windows as W
from skyfilm.sources import files
from skyfilm.streaming import streams


def png(img):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    raw = b"".join(b"\0" + row.tobytes() for row in img)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", img.shape[1], img.shape[0], 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def flood(mask):
    seen, parts = np.zeros(mask.shape, bool), []
    for y, x in zip(*np.nonzero(mask), strict=True):
        if seen[y, x]:
            continue
        stack, part = [(y, x)], 0
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            part += 1
            for i in range(max(0, a - 1), min(mask.shape[0], a + 2)):
                for j in range(max(0, b - 1), min(mask.shape[1], b + 2)):
                    if mask[i, j] and not seen[i, j]:
                        seen[i, j] = True
                        stack.append((i, j))
        parts.append(part)
    return sorted(parts)


@pytest.mark.parametrize("seed", range(8))
def test_components_equal_flood_fill(seed):
    mask = np.random.default_rng(seed).random((40, 50)) < 0.1 + 0.07 * seed
    labels, n = K.components(mask)
    assert sorted(np.bincount(labels.ravel(), minlength=n + 1)[1:].tolist()) == flood(mask)
    assert ((labels > 0) == mask).all()


def test_blur_and_morphology():
    img = np.random.default_rng(1).integers(0, 256, (20, 25), dtype=np.uint8)
    padded = np.pad(img, 2, mode="edge")
    assert K.median_blur(img)[7, 9] == np.median(padded[7:12, 9:14])
    assert K.dilated(img)[5, 5] == img[4:7, 4:7].max() and K.eroded(img)[5, 5] == img[4:7, 4:7].min()


def test_peaks():
    assert K.peaks([0, 2, 0, 5, 5, 0, 1, 0]).tolist() == [1, 3, 6]
    assert K.peaks([0, 2, 0, 5, 5, 0, 1, 0], prominence=1.5).tolist() == [1, 3]
    assert K.peaks([0, 2, 1, 3, 0], distance=3).tolist() == [3]
    assert K.peaks([1, 1]).tolist() == [] and K.peaks(np.ones(9)).tolist() == []
    x = np.sin(np.arange(0, 130, 0.1))
    assert len(K.exactly(x, 21, distance=10)) == 21


def test_segment_and_trace():
    img = np.zeros((100, 120), np.uint8)
    img[20:80, 30:110] = 200
    assert K.picture_area(img) == (30, 109, 20, 79)
    assert K.picture_area(np.zeros((10, 10), np.uint8)) is None
    assert K.foreground(np.array([[0, 255], [0, 0]], np.uint8)).sum() == 1 and K.foreground(img) is None
    assert K.otsu(img) < 200 and K.overexposed_share(np.full((2, 2), 240, np.uint8)) == 1.0
    assert K.best_window(img, 60, 80, 10)[:2] == (20, 30)
    assert K.group_limits(img, 0) == (30, 100)


def test_suppression_and_fits():
    boxes = np.array([[0, 0, 10, 10], [0, 0, 10, 5], [20, 20, 30, 30], [1, 0, 11, 10]], float)
    assert K.suppressed(boxes, np.array([0.9, 0.8, 0.7, 0.95])) == [3, 1, 2] or K.suppressed(boxes, np.array([0.9, 0.8, 0.7, 0.95])) == [3, 2]
    x = np.linspace(0, 3, 30)
    d, c, r = K.polynomial_fit(x, 1 + 2 * x**2, 5)
    assert r < 1e-9 and d >= 2
    kept, cut = K.two_layers(np.array([1, 1.1, 1.2, 5, 5.1, 900.0]))
    assert kept[cut - 1] < 2 < kept[cut]
    assert len(K.resampled(np.array([1.0, 1.001, 2.0]), np.array([5.0, 6.0, 7.0]))) == 3
    assert K.stacked([np.ones((2, 2)), np.ones((3, 3))]).shape == (2, 2)


def test_orbit_is_plausible():
    from skyfilm.plans.orbits import LINE1, LINE2

    e = orbit.parse_elements(LINE1, LINE2)
    t = e["epoch"] + np.arange(0, 86400, 60.0)
    lat, lon, h = orbit.ground_point(orbit.position(e, t), t)
    assert np.abs(lat).max() <= 81 and 900 < h.min() and h.max() < 1150 and np.abs(lon).max() <= 180
    alt, far = orbit.seen_from(orbit.position(e, t), t, lat, lon)
    assert alt.min() > 89 and np.allclose(far, h, atol=15)
    events = orbit.passes(e, t[0], t[-1], 45.0, -75.0)
    names = [n for n, _ in events]
    assert "rise" in names and "set" in names and "culminate" in names


def test_time_cascade_and_parse(spark):
    rows = [("109963060246060", 1963, 60, 24, 60, 60), ("1A9963060246060", 1964, 60, 1, None, None), ("10.9963060246060", 1964, 366, None, None, None), (None, 1963, 366, 1, 1, 1)]
    df = spark.createDataFrame(rows, "text string, y int, d int, h int, m int, s int")
    t, q = timeq.time_cascade(*[F.col(c) for c in "ydhms"])
    t2, _ = timeq.time_cascade(*[F.col(c) for c in "ydhms"], legacy=True)
    got = df.select(t.cast("string").alias("t"), q.alias("q"), t2.cast("string").alias("l"), P.rejection_reason(F.col("text")).alias("r")).collect()
    assert [(r.t, r.q) for r in got] == [("1963-03-02 01:01:00", 1), ("1964-02-29 01:00:00", 3), ("1964-12-31 00:00:00", 4), (None, 0)]
    assert got[1].l == "1964-03-01 01:00:00" and got[2].l == "1964-01-01 00:00:00"
    assert [r.r for r in got] == [None, "ocr_contains_letters", None, None]


def test_geometry(spark):
    one = spark.range(1)
    box = tuple(F.lit(x) for x in (0, 0, 10, 10))
    r = one.select(G.iou(box, tuple(F.lit(x) for x in (0, 0, 10, 5))).alias("i"), G.iou(box, tuple(F.lit(x) for x in (3, 3, 3, 3))).alias("z"), G.tile_starts(F.lit(1000)).alias("t"), G.tile_starts(F.lit(10)).alias("u")).first()
    assert (r.i, r.z, r.t, r.u) == (0.5, 0.0, [0, 384, 488], [0])


def test_joins_and_windows(spark):
    a = spark.createDataFrame([(1, 5, "x"), (1, 1, "y"), (2, 3, "z"), (2, None, "n")], "k int, t int, v string")
    b = spark.createDataFrame([(1, 1, "p"), (1, 4, "q"), (3, 0, "r")], "k int, u int, w string")
    got = {r.v: r.w for r in J.asof_join(a, b, ["k"], "t", "u", ["w"]).collect()}
    assert got == {"x": "q", "y": "p", "z": None, "n": None}
    assert {r.v: r.w for r in J.asof_join(a, b, ["k"], "t", "u", ["w"], forward=True).collect()} == {"x": None, "y": "p", "z": None, "n": None}
    m = spark.createDataFrame([("r", "num", 1), ("r", "num", 2), ("r", "dot", 3), ("s", "num2", 4), ("s", "dot", 5), ("t", "num", 6), ("t", "dot", 7)], "g string, c string, x int")
    got = {r.x0: (r.c, r.x) for r in C.majority_class(m.withColumn("x0", F.col("x")), "g", "c", ["x"]).collect()}
    assert got[3] == ("loss", None) and got[5] == ("loss", None) and got[6] == ("num", 6) and got[1] == ("num", 1)
    p = spark.createDataFrame([("a/b/c.png",), ("a/bb/c.png",), ("d/e.png",)], "path string")
    assert {r.path for r in J.under_any(p, spark.createDataFrame([("a/b",), ("d/e.png",)], "x string"), "path", "x").collect()} == {"a/b/c.png", "d/e.png"}
    pts = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (1, 100), (2, 10), (3, 20))])
    assert [q.y for q in spark.range(1).select(W.accepted(pts, 50, 0.5).alias("p")).first().p] == [0.0, 10.0, 20.0]


def test_group_split_keeps_groups_whole(spark):
    df = spark.createDataFrame([(g, i) for g in range(12) for i in range(g + 1)], "g int, i int")
    got = S.greedy_group_split(df, "g").groupBy("g").agg(F.countDistinct("split").alias("n"), F.first("split").alias("s")).collect()
    assert all(r.n == 1 for r in got) and {r.s for r in got} == {"train", "validation", "test"}


def test_scan_tree(spark, tmp_path):
    for d, s, f in (("R1", "a_1", "x.png"), ("R1", "a_1", "y.PNG"), ("R2", "b", "z.png"), ("R2", "b", "n.txt")):
        (tmp_path / d / s).mkdir(parents=True, exist_ok=True)
        (tmp_path / d / s / f).write_bytes(png(np.full((4, 6), 7, np.uint8)) if "txt" not in f else b"t")
    tree = files.scan_tree(spark, str(tmp_path))
    assert {(r.directory, r.subdirectory, r.images) for r in files.inventory(tree).collect()} == {("R1", "a_1", 2), ("R2", "b", 1)}
    kept, skipped = files.pruned(tree, ["b"])
    assert kept.count() == 2 and skipped.count() == 1
    pixels = files.pixel_table(files.images(spark, str(tmp_path)).where("path LIKE '%z.png'")).collect()
    assert {(r.height, r.width, r.v) for r in pixels} == {(4, 6, 7)} and sorted((r.y, r.x) for r in pixels) == [(y, x) for y in range(4) for x in range(6)]


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("n,t\n1,caf\xe9\n2,NA\n".encode("latin1"))
    got = files.read_table(spark, str(tmp_path / "a.csv"), "n int, t string", "cp1252", "NA").collect()
    assert [(r.n, r.t) for r in got] == [(1, "café"), (2, None)]
    (tmp_path / "b.txt").write_text("some preamble of a file\nA B\n1 2\n3 4\n")
    assert [tuple(r) for r in files.read_spaced(spark, str(tmp_path / "b.txt"), ["A", "B"]).collect()] == [("1", "2"), ("3", "4")]
    boxes = spark.createDataFrame([(0, 0.5, 0.25, 0.1, 0.2)], "cls int, cx double, cy double, w double, h double")
    files.write_boxes(boxes, str(tmp_path / "boxes"))
    r = files.read_boxes(spark, str(tmp_path / "boxes")).where("cls IS NOT NULL").first()
    assert (r.cls, r.cx, r.h) == (0.0, 0.5, 0.2)


def test_reservations(spark, tmp_path):
    log = pd.DataFrame({"path": ["a", "a", "b", "b", "c"], "status": ["reserved", "completed", "reserved", "abandoned", "reserved"], "ts": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 01:00", "2024-01-01 00:00", "2024-01-02 00:00", "2024-01-01 00:00"])})
    spark.createDataFrame(log).write.parquet(str(tmp_path / "log"))
    stream = streams.arriving_files(spark, str(tmp_path / "log"), spark.read.parquet(str(tmp_path / "log")).schema, files_each=100)
    got = {r.path: r.status for r in streams.drain(streams.reservations(stream), "update", ["path"]).collect()}
    assert got == {"a": "completed", "b": "free", "c": "reserved"}
