"""Peaks of a profile by height, distance and prominence, as folds over the profile's array.

A profile is as long as a picture is wide or high, so its array is small; profiles of many pictures are rows of a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = "struct<v:double,a:int,b:int>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use over a value that is worked out once, however often use names it."""
    return F.transform(F.array(value), use)[0]


def unit_range(values: Column) -> Column:
    """Values from 0 to 1; all 0 if they are equal."""

    def scaled(ends: Column) -> Column:
        low, high = ends["low"], ends["high"]
        return F.transform(values, lambda v: F.when(high == low, F.lit(0.0)).otherwise((v - low) / (high - low)))

    return _once(F.struct(F.array_min(values).alias("low"), F.array_max(values).alias("high")), scaled)


def _levels(values: Column) -> Column:
    """Runs of equal values as (v, a, b), with the places of their first and last."""

    def add(spans: Column, at: Column) -> Column:
        v = values[at]
        last = F.element_at(spans, -1)
        grown = F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(F.struct(last["v"].alias("v"), last["a"].alias("a"), at.alias("b"))))
        fresh = F.concat(spans, F.array(F.struct(v.alias("v"), at.alias("a"), at.alias("b"))))
        return F.when((F.size(spans) > 0) & (F.try_element_at(spans, F.lit(-1))["v"] == v), grown).otherwise(fresh).cast(f"array<{_SPAN}>")

    places = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, F.array().cast(f"array<{_SPAN}>"), add)


def _valleys(heights: Column) -> Column:
    """For each value the least one back to the nearest greater one, or to the begin: one pass with a stack that falls."""
    kind = "struct<stack:array<struct<v:double,m:double>>,out:array<double>>"

    def step(state: Column, v: Column) -> Column:
        passed = F.filter(state["stack"], lambda s: s["v"] <= v)
        low = F.least(v, F.array_min(F.transform(passed, lambda s: s["m"])))
        stack = F.concat(F.filter(state["stack"], lambda s: s["v"] > v), F.array(F.struct(v.alias("v"), low.alias("m"))))
        return F.struct(stack.alias("stack"), F.concat(state["out"], F.array(low)).alias("out")).cast(kind)

    start = F.struct(F.array().cast("array<struct<v:double,m:double>>").alias("stack"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(heights, start, step, lambda s: s["out"])


def peaks(values: Column, distance: int = 1) -> Column:
    """Peaks of an array of doubles as (at, height, prominence), in order of place.

    A peak is the middle of equal values, rounded down, that are higher than both neighbours.  Of peaks closer than distance the higher
    stays, of equal ones the later.  Prominence is the height above the higher of the two lowest points towards the nearest
    higher values, or the ends.
    """
    kind = "array<struct<height:double,at:int,prominence:double>>"

    def of_spans(spans: Column) -> Column:
        heights = F.transform(spans, lambda s: s["v"])
        valleys = F.struct(_valleys(heights).alias("left"), F.reverse(_valleys(F.reverse(heights))).alias("right"))
        return _once(valleys, lambda low: tops(spans, low))

    def tops(spans: Column, low: Column) -> Column:
        inner = F.when(F.size(spans) > 2, F.sequence(F.lit(1), F.size(spans) - 2)).otherwise(F.array().cast("array<int>"))
        higher = F.filter(inner, lambda i: (spans[i]["v"] > spans[i - 1]["v"]) & (spans[i]["v"] > spans[i + 1]["v"]))
        return F.transform(higher, lambda i: F.struct(spans[i]["v"].alias("height"), F.floor((spans[i]["a"] + spans[i]["b"]) / 2).cast("int").alias("at"), (spans[i]["v"] - F.greatest(low["left"][i], low["right"][i])).alias("prominence")))

    found = _once(_levels(values), of_spans)
    kept = F.aggregate(F.reverse(F.array_sort(found)), F.array().cast(kind), lambda k, p: F.when(F.exists(k, lambda q: F.abs(q["at"] - p["at"]) < distance), k).otherwise(F.concat(k, F.array(p))).cast(kind))
    return F.array_sort(F.transform(kept, lambda p: F.struct(p["at"].alias("at"), p["height"].alias("height"), p["prominence"].alias("prominence"))))


def prominent(found: Column, least: Column | float) -> Column:
    """Places of the peaks with at least a prominence."""
    return F.transform(F.filter(found, lambda p: p["prominence"] >= least), lambda p: p["at"])


def exactly(found: Column, wanted: int, start: float = 0.1, step: float = 0.01, tries: int = 1000) -> Column:
    """(at, least, hit): places of the peaks at the prominence, start moved by steps, that leaves the wanted number, and whether one does.

    Sorted prominences give the step at once: the first one past the greatest prominence too many, or the last one at
    which enough are left.  Where it leaves another number, or lies beyond the tries or below one step, its peaks count as they are.
    """

    def of_found(peaks_: Column) -> Column:
        sizes = F.sort_array(F.transform(peaks_, lambda p: p["prominence"]), asc=False)
        many, few = F.try_element_at(sizes, F.lit(wanted + 1)), F.try_element_at(sizes, F.lit(wanted))
        now = F.size(prominent(peaks_, start))
        # counted in steps; a peak stays as long as the level does not pass its prominence
        up = F.floor((many - start) / step).cast("int") + 1
        down = F.greatest(F.coalesce(F.floor((few - start) / step).cast("int"), F.lit(-tries)), F.lit(-int(round(start / step)) + 1))
        return F.when(now > wanted, F.least(up, F.lit(tries))).when(now < wanted, down).otherwise(0)

    def at_steps(pair: Column) -> Column:
        least = start + pair["steps"] * step
        at = prominent(pair["peaks"], least)
        return F.struct(at.alias("at"), least.alias("least"), (F.size(at) == wanted).alias("hit"))

    with_steps = _once(found, lambda peaks_: F.struct(peaks_.alias("peaks"), of_found(peaks_).alias("steps")))
    return _once(with_steps, at_steps)
