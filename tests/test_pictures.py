"""Pictures as tables of pixels against plain array code, and operators that meet hot keys."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import plain_kernels as K
from tests import plain_strips as E
from skyfilm.operators import fits, joins, layers, peaks, pixels, quantiles, runs


def table_of(spark, pictures):
    rows = [(k, int(y), int(x), int(img[y, x])) for k, img in pictures.items() for y, x in zip(*np.nonzero(img), strict=True)]
    return spark.createDataFrame(rows, "k long, y int, x int, v int")


def size_of(spark, pictures):
    return spark.createDataFrame([(k, *img.shape) for k, img in pictures.items()], "k long, height int, width int")


def array_of(rows, img):
    out = np.zeros(img.shape, int)
    for r in rows:
        out[r.y, r.x] = r.v
    return out


def noise(seed, shape=(18, 25), fill=0.5):
    rng = np.random.default_rng(seed)
    return np.where(rng.random(shape) < fill, rng.integers(1, 256, shape), 0)


def spiral(n=21):
    img = np.zeros((n, n), int)
    y, x, dy, dx = 0, 0, 0, 1
    for _ in range(n * n):
        img[y, x] = 1
        far = lambda a, b: not (0 <= a < n and 0 <= b < n) or img[a, b]
        if far(y + dy, x + dx) or (0 <= y + 2 * dy < n and 0 <= x + 2 * dx < n and img[y + 2 * dy, x + 2 * dx]):
            dy, dx = dx, -dy
            if far(y + dy, x + dx) or (0 <= y + 2 * dy < n and 0 <= x + 2 * dx < n and img[y + 2 * dy, x + 2 * dx]):
                break
        y, x = y + dy, x + dx
    return img


@pytest.mark.parametrize("corners", [True, False])
def test_parts(spark, corners):
    comb = np.zeros((12, 40), int)
    comb[:, ::2] = 1
    comb[6] = 1
    pictures = {1: noise(1, fill=0.4), 2: noise(2, fill=0.55), 3: spiral(), 4: comb, 5: np.ones((5, 7), int), 6: np.eye(15, dtype=int)[::-1]}
    got = runs.parts(table_of(spark, pictures), corners).collect()
    for k, img in pictures.items():
        if corners:
            labels, n = K.components(img > 0)
        else:
            labels, n = plain_parts(img > 0)
        want = set()
        for i in range(1, n + 1):
            y, x = np.nonzero(labels == i)
            want.add((len(y), x.min(), x.max(), y.min(), y.max(), x.sum(), y.sum(), (int(y[0]) << 32) + int(x[0])))
        assert {(r.area, r.left, r.right, r.top, r.bottom, r.sum_x, r.sum_y, r.label) for r in got if r.k == k} == want


def plain_parts(mask):
    labels, n = np.zeros(mask.shape, int), 0
    for y0, x0 in zip(*np.nonzero(mask), strict=True):
        if labels[y0, x0]:
            continue
        n += 1
        todo = [(y0, x0)]
        while todo:
            y, x = todo.pop()
            if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not labels[y, x]:
                labels[y, x] = n
                todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return labels, n


def test_no_pixels_no_parts(spark):
    empty = spark.createDataFrame([], "k long, y int, x int, v int")
    assert runs.parts(empty).count() == 0 and pixels.exposed_area(empty, pixels.sizes(empty)).count() == 0


def test_limits_windows_blur_and_noise(spark):
    pictures = {1: noise(3, (30, 41), 0.6), 2: noise(4, (22, 19), 0.9), 3: noise(5, (8, 60), 0.3)}
    pictures[1][5:20, 18:33] = 250
    t, size = table_of(spark, pictures), size_of(spark, pictures)
    flat = pixels.dense(t, size)
    area = {r.k: r for r in pixels.exposed_area(t, size, 3).collect()}
    window = {r.k: r for r in pixels.densest_window(flat, size, 10, 12, 2).collect()}
    sigma = {r.k: r.sigma for r in pixels.laplacian_noise(t, size).collect()}
    blurred, cleaned = pixels.median_blurred(flat, 2).collect(), pixels.cleaned_marks(flat).collect()
    otsu = {r.k: r.otsu for r in pixels.thresholds(pixels.level_counts(t, size)).collect()}
    for k, img in pictures.items():
        columns, rows = K.bright_limits(img, 0, 3), K.bright_limits(img, 1)
        assert (area[k].left, area[k].right, area[k].top, area[k].bottom) == (*columns, *rows)
        top, left, h, w = K.best_window(img, 10, 12, 2)
        assert (window[k].top, window[k].left, window[k].height, window[k].width) == (top, left, h, w) and window[k].total == img[top : top + h, left : left + w].sum()
        assert sigma[k] == pytest.approx(K.noise(img.astype(np.uint8))["laplacian"])
        assert (array_of([r for r in blurred if r.k == k], img) == K.median_blur(img.astype(np.uint8), 5)).all()
        assert (array_of([r for r in cleaned if r.k == k], img) == K.cleaned_marks(img.astype(np.uint8))).all()
        assert otsu[k] == K.otsu(img.astype(np.uint8))


def test_stack_of_unequal_pictures(spark):
    pictures = {1: noise(6, (9, 14)), 2: noise(7, (12, 11)), 3: noise(8, (10, 13))}
    t, size = table_of(spark, pictures).withColumn("k", F.lit(7)), size_of(spark, pictures).withColumn("k", F.lit(7))
    want = K.stacked(list(pictures.values()))
    got = pixels.stacked(t, size).collect()
    assert len(got) == want.size and (array_of(got, want) == want).all()


def test_equalised(spark):
    pictures = {1: noise(10, (40, 70), 0.9), 2: np.tile(np.arange(50), (33, 1)), 3: np.full((20, 20), 9)}
    pictures[1][12:22, 30:40] = 230
    size = size_of(spark, pictures)
    got = pixels.equalised(pixels.dense(table_of(spark, pictures), size), size, 4).collect()
    for k, img in pictures.items():
        even = array_of([r for r in got if r.k == k], img)
        assert np.abs(even - E.equalised(img.astype(np.uint8), 4).astype(int)).max() <= 1


def test_dense_parts(spark):
    mask = noise(9, (40, 50), 0.25) > 0
    mask[10:25, 20:38] = True
    t = table_of(spark, {1: mask.astype(int)})
    got = pixels.dense_parts(t, size_of(spark, {1: mask}), 12, 4, 1.5).withColumn("v", F.lit(1)).collect()
    assert (array_of(got, mask) == K.dense_parts(mask.astype(np.uint8), 12, 4, 1.5)).all()


def test_long_lines(spark):
    img = np.zeros((60, 80), int)
    img[20, 5:75] = 1
    img[10:50, 33] = 1
    for i in range(40):
        img[10 + i, 20 + i] = 1
    t = table_of(spark, {1: img})
    found = {(r.angle, r.offset) for r in pixels.long_lines(t, range(0, 180, 45), 30).collect()}
    assert {(90, 20), (0, 33)} <= found and any(a == 135 for a, _ in found)
    left = pixels.without_lines(t, pixels.long_lines(t, range(0, 180, 45), 30), range(0, 180, 45), 1)
    assert left.count() == 0


@pytest.mark.parametrize("distance,least", [(1, 0.0), (5, 0.1), (3, 0.4)])
def test_peaks(spark, distance, least):
    rng = np.random.default_rng(distance)
    profiles = [rng.integers(0, 12, n).astype(float) for n in (0, 1, 2, 3, 40, 90)] + [np.zeros(9), np.array([0, 1, 1, 1, 0, 2, 2, 0.0]), np.arange(9.0), np.sin(np.arange(200) / 5)]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(profiles)], "k int, p array<double>")
    got = {r.k: r.at for r in df.select("k", peaks.prominent(peaks.peaks(F.col("p"), distance), least).alias("at")).collect()}
    for i, p in enumerate(profiles):
        assert got[i] == K.peaks(p, distance, least).tolist()


def test_exact_number_of_peaks(spark):
    rng = np.random.default_rng(1)
    profiles = [K.unit_range(rng.random(150).cumsum() % 1.7) for _ in range(8)]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(profiles)], "k int, p array<double>")
    for wanted in (3, 9, 14, 60):
        e = df.select("k", peaks.exactly(peaks.peaks(F.col("p"), 4), wanted).alias("e")).select("k", "e.*").collect()
        for r in e:
            want = K.exactly(profiles[r.k], wanted, 4)
            assert r.hit == (len(want) == wanted) or not r.hit
            if r.hit:
                assert r.at == want.tolist()


LISTS = st.lists(st.one_of(st.floats(-1e300, 1e300), st.integers(-3, 3).map(float), st.none(), st.just(math.nan)), max_size=40)


@settings(max_examples=3, deadline=None)
@given(LISTS)
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.fraction: r.value for r in quantiles.exact_quantiles(df, "v", [0.0, 0.3, 0.5, 1.0], small=4).collect()}
    real = [v for v in values if v is not None and not math.isnan(v)]
    assert len(got) == (4 if real else 0)
    for f, v in got.items():
        assert v == pytest.approx(float(np.quantile(np.array(real) / 4, f)) * 4, rel=1e-9)


def test_quantiles_by_narrowing(spark):
    """A group with most rows, values over many magnitudes, long ties; few rows may be sorted in one place."""
    rng = np.random.default_rng(2)
    a = np.concatenate([np.exp(rng.normal(0, 60, 20_000)), np.zeros(9_000), -np.exp(rng.normal(0, 3, 5_000))])
    b, c = rng.integers(0, 5, 700).astype(float), np.array([3.5])
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [(None, 3.5), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    fractions = [0.001, 0.25, 0.26, 0.5, 0.999]
    got = {(r.g, r.fraction): r.value for r in quantiles.exact_quantiles(df, "v", fractions, ["g"], small=50).collect()}
    for g, values in (("a", a), ("b", b), (None, c)):
        for f in fractions:
            assert got[g, f] == pytest.approx(np.quantile(values, f), rel=1e-9)
    assert len(got) == 15


def test_two_layers(spark):
    rng = np.random.default_rng(3)
    groups = {1: np.concatenate([rng.normal(100, 4, 200), rng.normal(160, 6, 90), [9000.0]]), 2: np.full(5, 7.0), 3: rng.random(2)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k int, v double")
    got = {r.k: r for r in layers.two_layers(layers.within_mads(df, ["k"], "v"), ["k"], "v").collect()}
    assert set(got) == {1, 3}
    for k in got:
        kept, split = K.two_layers(groups[k])
        assert (got[k].n, got[k].lower, got[k].cut) == (len(kept), split, pytest.approx(kept[split - 1]))


def test_curves_find_their_own_family(spark):
    x = np.linspace(1, 9, 60)
    curves = {"poly2": 3 - 2 * x + 0.5 * x**2, "poly3": 1 + x**3 / 9 - x, "exponential": 0.3 * np.exp(0.4 * x), "power": 2 * x**1.7, "log": 5 + 3 * np.log(x), "rational": 2 + 7 / x, "logistic": 10 / (1 + np.exp(4 - x))}
    names = list(curves)
    rows = [(i, float(a), float(b)) for i, n in enumerate(names) for a, b in zip(x, curves[n], strict=True)] + [(90, 1.0, 2.0), (91, 2.0, 1.0), (91, 2.0, 3.0), (92, None, 1.0)]
    out = fits.curve_fits(spark.createDataFrame(rows, "k int, x double, y double"), 3, 4).collect()
    best = {r.k: (r.family, r.residual) for r in out if r.best}
    for i, n in enumerate(names):
        assert best[i][1] < 0.05 and (n == "logistic" or best[i][0] == n)
    for r in out:
        if r.k < 7 and r.family.startswith("poly"):
            y, d = curves[names[r.k]], int(r.family[4:])
            assert r.residual == pytest.approx(((np.polyval(np.polyfit(x, y, d), x) - y) ** 2).sum(), abs=1e-7)
    logistic = next(r.residual for r in out if r.k == names.index("logistic") and r.family == "logistic")
    assert logistic < 1


def test_asof_join_over_ranges_of_time(spark):
    """A hot key, ranges without right rows, ties, nulls; against a plain search."""
    from datetime import datetime, timedelta

    rng = np.random.default_rng(4)
    day = lambda d: datetime(2020, 1, 1) + timedelta(days=float(d))
    left = [(i, "hot" if i % 3 else f"k{i % 5}", None if i % 17 == 0 else day(rng.integers(0, 900))) for i in range(400)] + [(900, None, day(5))]
    right = [("hot", day(d), float(v)) for v, d in enumerate(rng.integers(0, 900, 60))] + [("k1", day(100), 1.0), ("k1", day(100), 2.0), ("k2", day(450), 3.0), ("k3", None, 4.0)]
    lf, rf = spark.createDataFrame(left, "i int, k string, t timestamp_ntz"), spark.createDataFrame(right, "k string, s timestamp_ntz, v double")
    for forward in (False, True):
        got = {r.i: (r.s_hit, r.v) for r in joins.asof_join(lf, rf, ["k"], "t", "s", ["v"], forward).collect()}
        assert len(got) == len(left)
        for i, k, t in left:
            fit = [(s, v) for kk, s, v in right if t and s and kk == k and (s >= t if forward else s <= t)]
            near = (min if forward else max)((s for s, _ in fit), default=None)
            assert got[i] == (near, max((v for s, v in fit if s == near), default=None))


def test_contained_names(spark):
    names = spark.createDataFrame([("Niger", 1), ("Nigeria", 2), ("New York", 3), ("York", 0), ("São Tomé", 5), ("...", 6), (None, 7)], "name string, rank int")
    texts = [(1, "Lagos, Nigeria"), (2, "niger river"), (3, "new  york-city"), (4, "Duke of York"), (5, "SÃO TOMÉ!"), (6, ""), (7, None), (8, "Newyork")]
    df = spark.createDataFrame(texts, "id int, text string")
    longest = {r.id: r.name for r in joins.contained_names(df, "id", "text", names, "name", "rank").collect()}
    assert longest == {1: "Nigeria", 2: "Niger", 3: "New York", 4: "York", 5: "São Tomé"}
    assert {r.id: r.name for r in joins.contained_names(df, "id", "text", names, "name", "rank", longest=False).collect()}[3] == "York"
    assert joins.contained_names(df, "id", "text", names.where("rank > 9"), "name", "rank").count() == 0


def test_mark_sequence(spark):
    img = np.zeros((30, 400), int)
    for i in range(15):
        img[10:20, 30 + 16 * i : 36 + 16 * i] = 1
    for i in range(8):
        img[12:22, 320 + 9 * i : 324 + 9 * i] = 1
    img[2, 100:180] = 1
    found = runs.parts(table_of(spark, {1: img, 2: img * (np.arange(400) > 310)}))
    got = layers.mark_sequence(found, least_gap=12.0, gap_heights=1.0).collect()
    assert [(r.k, r.x1, r.y1, r.x2, r.y2, r.marks) for r in got] == [(1, 30, 10, 260, 20, 15)]


def test_reservations_end_by_themselves(spark, tmp_path):
    """A reservation is free a day later without any further event of its item."""
    from datetime import datetime, timedelta

    from skyfilm.streaming import streams

    t0 = datetime(2024, 1, 1)
    batches = [[("a", "reserved", t0), ("b", "reserved", t0), ("c", "reserved", t0)], [("c", "completed", t0 + timedelta(hours=20)), ("d", "reserved", t0 + timedelta(hours=40))]]
    schema = "path string, status string, ts timestamp"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    from pyspark.sql.types import _parse_datatype_string

    stream = streams.arriving_files(spark, f"{tmp_path}/in/*", _parse_datatype_string(schema))
    got = {r.path: r.status for r in streams.drain(streams.reservations(stream), "update", ["path"], f"{tmp_path}/out").collect()}
    assert got == {"a": "free", "b": "free", "c": "completed", "d": "reserved"}
