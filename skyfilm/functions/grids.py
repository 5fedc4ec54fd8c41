"""Places of a roll's grid lines and of the labels beside its pictures, from arrays of peaks.

All are column expressions over sorted arrays: a roll has tens of peaks, so one row per roll holds them.  Peaks come from
``kernels.grid_peaks``, ``kernels.exactly`` and ``kernels.histogram_peaks``.  A null or short array gives the usual places.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: frequencies of the vertical lines in MHz, their usual columns, and the outermost columns that a line can have
FREQUENCIES = (1.5, 2.0, 2.5, 3.5, 4.5, 5.5, 6.5, 7.0, 7.5, 8.5, 9.5, 10.5, 11.5)
USUAL_COLUMNS = (149, 273, 335, 390, 496, 604, 711, 837, 898, 964, 1128, 1314, 1444)
OUTERMOST = (89, 1510)
# fixed values: depths of the horizontal lines in km and their usual rows; lines above the least row are not depths
USUAL_ROWS = {100: 55, 200: 110}
LEAST_ROW = 40
# fixed values: labels along the two axes beside a picture
DOT_FIELDS = ("day_1", "day_2", "day_3", "hour_1", "hour_2", "minute_1", "minute_2", "second_1", "second_2", "station_code")
DIGIT_FIELDS = ("satellite_number", "year", "day_1", "day_2", "day_3", "hour_1", "hour_2", "minute_1", "minute_2", "second_1", "second_2", "station_number_1", "station_number_2")
WEIGHTS = (1, 2, 4, 8)
# fixed values: usual gap, first and last place of fields; usual gap and first place of weights and least distance of their peaks
FIELD_AXIS = {"digit": (53, 21, 661), "digit_f": (43, 23, 540), "dot": (59, 20, 549)}
WEIGHT_AXIS = {"digit": (47, 41, 20), "digit_f": (40, 37, 20), "dot": (15, 32, 10)}


def column_limits() -> list[tuple[float, float]]:
    """For each frequency the columns half way to its neighbours' usual ones."""
    middles = [(a + b) / 2 for a, b in zip(USUAL_COLUMNS[:-1], USUAL_COLUMNS[1:], strict=True)]
    return list(zip([OUTERMOST[0], *middles], [*middles, OUTERMOST[1]], strict=True))


def _lines(places: list[Column], values: tuple) -> Column:
    return F.array(*[F.struct(p.cast("int").alias("x"), F.lit(v).alias("v")) for p, v in zip(places, values, strict=True)])


def frequency_lines(found: Column, adjusted: Column, legacy: bool = False) -> Column:
    """array<struct<x, v>> of the frequencies' columns, as ``geometry.piecewise`` takes it.

    As many peaks as frequencies are taken as they are.  Otherwise adjusted peaks of that number are, each within half
    way to its neighbours and the usual column where it is not; legacy takes all usual columns then.
    """
    n = len(FREQUENCIES)
    usual = _lines([F.lit(x) for x in USUAL_COLUMNS], FREQUENCIES)
    if legacy:
        mended = usual
    else:
        at = [F.get(adjusted, F.lit(i)) for i in range(n)]
        mended = _lines([F.when(a.between(low, high), a).otherwise(u) for a, (low, high), u in zip(at, column_limits(), USUAL_COLUMNS, strict=True)], FREQUENCIES)
    own = _lines([F.get(found, F.lit(i)) for i in range(n)], FREQUENCIES)
    return F.when(F.size(found) == n, own).when(F.size(adjusted) == n, mended).otherwise(usual)


def depth_lines(found: Column) -> Column:
    """array<struct<x, v>> of the rows of 100 and 200 km: the first two peaks below the least row, usual ones if there
    are fewer, and the usual one in place of any that is further from it than the two are apart."""
    (d1, y1), (d2, y2) = USUAL_ROWS.items()
    low = F.filter(found, lambda y: y > LEAST_ROW)

    def near(i: int, usual: int) -> Column:
        at = F.get(low, F.lit(i))
        return F.when((F.size(low) >= 2) & (F.abs(at - usual) <= y2 - y1), at).otherwise(usual)

    return _lines([near(0, y1), near(1, y2)], (d1, d2))


def _axis(first: Column, gap: Column, labels: tuple) -> Column:
    """array<struct<at, label>>, as ``geometry.nearest_label`` takes it; halves go to the even pixel."""
    return F.array(*[F.struct(F.bround(first + gap * i, 0).cast("int").alias("at"), F.lit(v).alias("label")) for i, v in enumerate(labels)])


def _or_usual(at: Column, usual: int, most: float) -> Column:
    return F.when(F.abs(at - usual) <= most, at).otherwise(F.lit(usual)).cast("double")


def field_axis(found: Column, labels: tuple, kind: str, ratio: float = 0.75) -> Column:
    """Evenly spaced fields from the first to the last peak, each end the usual one if it is off by more than ratio gaps."""
    gap, first, last = FIELD_AXIS[kind]
    a = _or_usual(F.try_element_at(found, F.lit(1)), first, ratio * gap)
    b = _or_usual(F.try_element_at(found, F.lit(-1)), last, ratio * gap)
    there = F.coalesce(F.size(found) > 0, F.lit(False))
    # without any peak the usual gap holds, which need not end at the usual last place
    return _axis(F.when(there, a).otherwise(F.lit(float(first))), F.when(there, (b - a) / (len(labels) - 1)).otherwise(F.lit(float(gap))), labels)


def weight_axis(found: Column, kind: str, ratio: float = 0.75, legacy: bool = False) -> Column:
    """Weights from the first peak on, by the mean of the first three gaps; usual ones where they are too far off.

    Two or three peaks give fewer gaps; legacy wants all three gaps and falls back to the usual axis.
    """
    gap, first, distance = WEIGHT_AXIS[kind]
    used = F.least(F.size(found), F.lit(4))
    mean = (F.get(found, used - 1) - F.get(found, F.lit(0))) / F.nullif(used - 1, F.lit(0))
    there = F.coalesce(F.size(found) >= (4 if legacy else 2), F.lit(False))
    start = F.when(there, _or_usual(F.get(found, F.lit(0)), first, ratio * gap)).otherwise(F.lit(float(first)))
    return _axis(start, F.when(there, _or_usual(mean, gap, ratio * distance)).otherwise(F.lit(float(gap))), WEIGHTS)
