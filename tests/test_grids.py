"""Grid lines, left-side axes and strip preparation on small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import plain_strips as E
from skyfilm.functions import grids as R


def one(spark, column, p, kind="array<int>"):
    return spark.createDataFrame([(p,)], f"p {kind}").select(column).first()[0]


def test_frequency_lines(spark):
    p = F.col("p")
    exact = [10 * i for i in range(1, 14)]
    assert [g["x"] for g in one(spark, R.frequency_lines(p, p), exact)] == exact
    for few in ([], [100], None):
        assert [g["x"] for g in one(spark, R.frequency_lines(p, p), few)] == list(R.USUAL_COLUMNS)
    shifted = [x + 9 for x in R.USUAL_COLUMNS]
    shifted[3] = 700
    usual = [x + 9 for x in R.USUAL_COLUMNS]
    usual[3] = R.USUAL_COLUMNS[3]
    none = F.array().cast("array<int>")
    assert [g["x"] for g in one(spark, R.frequency_lines(none, p), shifted)] == usual
    assert [g["x"] for g in one(spark, R.frequency_lines(none, p, legacy=True), shifted)] == list(R.USUAL_COLUMNS)


@pytest.mark.parametrize(("p", "rows"), [([5, 41, 111, 170], [41, 111]), ([60], [55, 110]), (None, [55, 110]), ([150, 300], [55, 110])])
def test_depth_lines(spark, p, rows):
    assert [g["x"] for g in one(spark, R.depth_lines(F.col("p")), p)] == rows


def test_axes(spark):
    p = F.col("p")
    assert [g["at"] for g in one(spark, R.field_axis(p, R.DOT_FIELDS, "dot"), None)] == [20 + 59 * i for i in range(10)]
    near = [g["at"] for g in one(spark, R.field_axis(p, R.DIGIT_FIELDS, "digit"), [30, 300, 670])]
    assert near[0] == 30 and near[-1] == 670
    assert [g["at"] for g in one(spark, R.weight_axis(p, "digit"), [40, 90, 136])] == [40, 88, 136, 184]
    assert [g["at"] for g in one(spark, R.weight_axis(p, "digit", legacy=True), [40, 90, 136])] == [41, 88, 135, 182]
    assert [g["at"] for g in one(spark, R.weight_axis(p, "digit"), [40])] == [41, 88, 135, 182]


def test_strips():
    rng = np.random.default_rng(3)
    img = rng.integers(0, 40, (120, 300)).astype(np.uint8)
    img[60:75, 40:48] = 230
    even = E.equalised(img)
    assert even.shape == img.shape and even.dtype == np.uint8 and even[60:75, 40:48].min() > np.median(even)
    two, level = E.binarised(img)
    assert set(np.unique(two).tolist()) <= {0, 255} and 0 < level < 255
    clean = np.zeros((120, 300), np.uint8)
    clean[10, :200] = clean[100, :200] = clean[50:60, 20:26] = 255
    rows = E.long_rows(clean)
    assert len(rows) == 2 and abs(rows[0] - 10) <= 1 and abs(rows[1] - 100) <= 1
    out = E.blanked_outside(clean, rows)
    assert out[50:60, 20:26].all() and not out[:15].any() and not out[96:].any()
    assert E.bottom(img, 121) is None and E.bottom(img, 50).shape == (50, 300)
    assert not E.black_edges(img)[:10].any() and (E.black_edges(img)[10:110] == img[10:110]).all()
    assert E.prepared(img[:20])[1]["status"] == "too short"
    assert E.prepared(np.zeros((100, 50), np.uint8))[1]["status"] in ("ok", "empty")
