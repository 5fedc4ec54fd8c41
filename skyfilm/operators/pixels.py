"""Pictures as tables of pixels (k, y, x, v): limits, stacks, windows, lines, thresholds and noise, all as aggregations.

Pixels that are not there are 0.  Sizes come as a table (k, height, width); a picture's pixels are spread over its rows or
columns, so no task holds a picture and none is decoded in Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored


def sizes(pixels: DataFrame) -> DataFrame:
    """(k, height, width) up to the outermost pixel that is there."""
    return pixels.groupBy("k").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


def _filled(every: DataFrame, rows: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """A row for each of ``every``, with an aggregate v of its rows, 0 without any: one aggregation, so tables dealt by picture stay where they are."""
    both = every.select(*by, F.lit(None).cast(rows.schema["v"].dataType).alias("v"), F.lit(True).alias("wanted")).unionByName(rows.select(*by, "v", F.lit(False).alias("wanted")))
    return both.groupBy(*by).agg(F.coalesce(value, F.lit(0)).alias("v"), F.max("wanted").alias("wanted")).where("wanted").drop("wanted")


def dense(pixels: DataFrame, size: DataFrame) -> DataFrame:
    """Every pixel of the pictures, 0 where none was."""
    rows = size.select("k", "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"))
    grid = rows.select("k", "y", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"))
    return _filled(grid, pixels, ["k", "y", "x"], F.max("v"))


def line_sums(pixels: DataFrame, size: DataFrame, axis: str) -> DataFrame:
    """(k, i, s): sums of all columns (axis x) or rows (axis y), also of empty ones."""
    length = {"x": "width", "y": "height"}[axis]
    every = size.select("k", F.explode(F.sequence(F.lit(0), F.col(length) - 1)).alias("i"))
    return _filled(every, pixels.select("k", F.col(axis).alias("i"), "v"), ["k", "i"], F.sum("v")).withColumnRenamed("v", "s")


def bright_limits(sums: DataFrame, beyond: int = -1) -> DataFrame:
    """(k, low, high): first and last line brighter than the mean line, beyond a place; no row for a picture without light.

    A line is above the mean of all lines scaled to their range if n times its sum is above the sum of all, which whole numbers tell exactly.
    """
    whole = Window.partitionBy("k")
    told = sums.withColumns({"all": F.sum("s").over(whole), "n": F.count("*").over(whole)})
    above = told.where((F.col("all") > 0) & (F.col("s") * F.col("n") > F.col("all")) & (F.col("i") > beyond))
    return above.groupBy("k").agg(F.min("i").alias("low"), F.max("i").alias("high"))


def exposed_area(pixels: DataFrame, size: DataFrame, start: int = 15) -> DataFrame:
    """(k, left, right, top, bottom, class, details): the exposed picture's limits, or class loss and why; right and bottom are no longer inside."""
    # one after the other, so that no task holds the steps of both
    columns = stored(bright_limits(line_sums(pixels, size, "x"), start).select("k", F.col("low").alias("left"), F.col("high").alias("right")), "columns")
    rows = stored(bright_limits(line_sums(pixels, size, "y")).select("k", F.col("low").alias("top"), F.col("high").alias("bottom")), "rows")
    found = size.select("k").join(columns, "k", "left").join(rows, "k", "left")
    ok = F.coalesce((F.col("left") < F.col("right")) & (F.col("top") < F.col("bottom")), F.lit(False))
    limits = [F.when(ok, F.col(c)).alias(c) for c in ("left", "right", "top", "bottom")]
    return found.select("k", *limits, F.when(ok, "picture").otherwise("loss").alias("class"), F.when(~ok, "no picture found").alias("details"))


def cropped(pixels: DataFrame, area: DataFrame) -> DataFrame:
    """Pixels inside the limits of their picture, counted from its corner; pictures that are losses have none."""
    inside = (F.col("x") >= F.col("left")) & (F.col("x") < F.col("right")) & (F.col("y") >= F.col("top")) & (F.col("y") < F.col("bottom"))
    return pixels.join(area, "k").where(inside).select("k", (F.col("y") - F.col("top")).alias("y"), (F.col("x") - F.col("left")).alias("x"), "v")


def grouped_limits(sums: DataFrame, group: int = 10, cut: int = 20) -> DataFrame:
    """(k, low, high) in pixels of the first and last group of lines above the least one; the last lines are left out, and so is a short last group."""
    n = F.count("*").over(Window.partitionBy("k"))
    own = sums.withColumn("usable", F.floor((n - cut) / group) * group).where("i < usable")
    groups = own.groupBy("k", F.floor(F.col("i") / group).alias("g")).agg(F.sum("s").alias("s"))
    above = groups.withColumn("least", F.min("s").over(Window.partitionBy("k"))).where("s > least")
    return above.groupBy("k").agg((F.min("g") * group).alias("low"), ((F.max("g") + 1) * group).alias("high"))


def narrowed_limits(sums: DataFrame, widest: int = 300, step: int = 10) -> DataFrame:
    """(k, low, high, offset): lines above a share of the range of sums, the first of 0, step, ... per cent at which they span no more than widest."""
    whole = Window.partitionBy("k")
    ends = sums.withColumns({"least": F.min("s").over(whole), "most": F.max("s").over(whole)}).where("most > least")
    share = (F.col("s") - F.col("least")) * 100 > F.col("offset") * (F.col("most") - F.col("least"))
    tried = ends.withColumn("offset", F.explode(F.array(*[F.lit(o) for o in range(0, 100, step)]))).where(share)
    spans = tried.groupBy("k", "offset").agg(F.min("i").alias("low"), F.max("i").alias("high")).where(F.col("high") - F.col("low") <= widest)
    return spans.groupBy("k").agg(F.min(F.struct("offset", "low", "high")).alias("b")).select("k", "b.low", "b.high", "b.offset")


def stacked(pixels: DataFrame, size: DataFrame, pad: int = 1) -> DataFrame:
    """Pictures (k, y, x, v) of one k each, laid over each other: (k, y, x, v), n times the sum of a stack's n pictures.

    pixels and sizes have the pictures' own number in part.  Pictures that do not reach a place count pad there, up to the largest of
    the stack; the result is cut to the median height and width, rounded down.
    """
    stack = size.groupBy("k").agg(F.count("*").alias("n"), F.floor(F.median("height")).cast("int").alias("height"), F.floor(F.median("width")).cast("int").alias("width"))
    ends = size.groupBy("k", (F.col("height") - 1).alias("y"), (F.col("width") - 1).alias("x")).agg(F.count("*").alias("c"))
    # how many pictures reach a place: those that end at or beyond it in both directions
    reach = size.groupBy("k").agg(F.max("height").alias("height"), F.max("width").alias("width"))
    grid = dense(ends.withColumnRenamed("c", "v"), reach)
    along = Window.partitionBy("k", "y").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("k", "x").orderBy(F.desc("y")).rowsBetween(Window.unboundedPreceding, 0)
    reached = grid.withColumn("v", F.sum("v").over(along)).withColumn("reached", F.sum("v").over(down)).drop("v")
    total = pixels.groupBy("k", "y", "x").agg(F.sum("v").alias("s"))
    cut = reached.join(stack, "k").where((F.col("y") < F.col("height")) & (F.col("x") < F.col("width")))
    value = F.col("n") * (F.coalesce("s", F.lit(0)) + pad * (F.col("n") - F.col("reached")))
    return cut.join(total, ["k", "y", "x"], "left").select("k", "y", "x", value.alias("v"))


def line_medians(picture: DataFrame, axis: str) -> DataFrame:
    """(k, i, m): the median of every column (axis x) or row (axis y) of dense pictures."""
    return picture.groupBy("k", F.col(axis).alias("i")).agg(F.median("v").alias("m"))


def summed_area(picture: DataFrame) -> DataFrame:
    """Dense pictures with the sum of all pixels above and left of each place, itself included."""
    along = Window.partitionBy("k", "y").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("k", "x").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
    return picture.withColumn("v", F.sum("v").over(along)).withColumn("total", F.sum("v").over(down)).select("k", "y", "x", "total")


def window_sums(picture: DataFrame, size: DataFrame, height: int, width: int, step: int) -> DataFrame:
    """(k, top, left, tall, wide, total) of windows at multiples of step that fit into dense pictures; small pictures shrink the window.

    Each corner of the summed areas goes to the windows that it bounds, with its sign.
    """
    table = summed_area(picture).join(size.select("k", F.col("height").alias("h"), F.col("width").alias("w")), "k")
    tall, wide = F.least(F.lit(height), F.col("h")), F.least(F.lit(width), F.col("w"))
    corners = []
    for dy, dx, sign in ((0, 0, 1), (0, 1, -1), (1, 0, -1), (1, 1, 1)):
        # the place above and left of a window bounds it, or its own last row and column
        top = F.col("y") + 1 - (tall if dy else F.lit(0))
        left = F.col("x") + 1 - (wide if dx else F.lit(0))
        corners.append(F.struct(top.alias("top"), left.alias("left"), (sign * F.col("total")).alias("part")))
    ours = table.select("k", "h", "w", tall.alias("tall"), wide.alias("wide"), F.explode(F.array(*corners)).alias("c")).select("k", "h", "w", "tall", "wide", "c.*")
    ours = ours.where((F.col("top") >= 0) & (F.col("left") >= 0) & (F.col("top") % step == 0) & (F.col("left") % step == 0) & (F.col("top") + F.col("tall") <= F.col("h")) & (F.col("left") + F.col("wide") <= F.col("w")))
    return ours.groupBy("k", "top", "left", "tall", "wide").agg(F.sum("part").alias("total"))


def densest_window(picture: DataFrame, size: DataFrame, height: int = 100, width: int = 700, step: int = 10) -> DataFrame:
    """(k, top, left, height, width, total) of the window with the greatest sum, the first of equals in reading order."""
    sums = window_sums(picture, size, height, width, step)
    best = sums.groupBy("k").agg(F.max(F.struct("total", (-F.col("top")).alias("t"), (-F.col("left")).alias("l"), "tall", "wide")).alias("b"))
    return best.select("k", (-F.col("b.t")).alias("top"), (-F.col("b.l")).alias("left"), F.col("b.tall").alias("height"), F.col("b.wide").alias("width"), "b.total")


def dense_parts(mask: DataFrame, size: DataFrame, side: int = 100, step: int = 25, times: float = 2.0) -> DataFrame:
    """Pixels (k, y, x) of a mask inside square windows that are more than some times as full as the whole picture; windows lie at multiples of step."""
    marks = mask.select("k", "y", "x").distinct()
    sums = window_sums(dense(marks.withColumn("v", F.lit(1)), size), size, side, side, step)
    whole = marks.groupBy("k").agg(F.count("*").alias("all")).join(size, "k")
    fuller = F.col("total") * F.col("height") * F.col("width") > F.lit(times) * F.col("all") * F.col("tall") * F.col("wide")
    full = sums.join(whole, "k").select("k", "top", "left", "tall", "wide", "width", fuller.alias("full"))
    # windows stand in reading order, so a pixel finds those that may hold it by their number
    line = F.floor((F.col("width") - F.col("wide")) / step) + 1
    told = full.groupBy("k", "tall", "wide", line.alias("line")).agg(F.transform(F.array_sort(F.collect_list(F.struct("top", "left", "full"))), lambda w: w["full"]).alias("full"))
    held = F.lit(False)
    for i in range(-(-side // step)):
        for j in range(-(-side // step)):
            down, across = F.floor(F.col("y") / step) - i, F.floor(F.col("x") / step) - j
            fits = (down >= 0) & (across >= 0) & (across < F.col("line")) & (F.col("y") < down * step + F.col("tall")) & (F.col("x") < across * step + F.col("wide"))
            held = held | F.coalesce(fits & F.get("full", (down * F.col("line") + across).cast("int")), F.lit(False))
    return marks.join(told, "k").where(held).select("k", "y", "x")


def without_grid(pixels: DataFrame, rows: Sequence[int], columns: Sequence[int], thickness: int = 5) -> DataFrame:
    """Pixels off the given rows and columns, which are as thick as said."""
    r = thickness // 2
    on = F.lit(False)
    for name, places in (("y", rows), ("x", columns)):
        for place in places:
            on = on | F.col(name).between(place - r, place + r)
    return pixels.where(~on)


def _line(column: str) -> Window:
    return Window.partitionBy("k", {"x": "y", "y": "x"}[column]).orderBy(column)


def _stretched(picture: DataFrame, radius: int, f) -> DataFrame:
    for column in ("x", "y"):
        picture = picture.withColumn("v", f("v").over(_line(column).rowsBetween(-radius, radius)))
    return picture


def grown(picture: DataFrame, radius: int = 1) -> DataFrame:
    """Dense pictures with the greatest value of each place's square."""
    return _stretched(picture, radius, F.max)


def shrunk(picture: DataFrame, radius: int = 1) -> DataFrame:
    """Dense pictures with the least value of each place's square."""
    return _stretched(picture, radius, F.min)


def median_blurred(picture: DataFrame, radius: int = 2) -> DataFrame:
    """Dense pictures with the median of each place's square; beyond the border its nearest pixel counts."""

    def around(value: str, column: str) -> Column:
        whole = _line(column).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = [F.coalesce(F.lag(value, i).over(_line(column)), F.first(value).over(whole)) for i in range(radius, 0, -1)]
        after = [F.coalesce(F.lead(value, i).over(_line(column)), F.last(value).over(whole)) for i in range(1, radius + 1)]
        return F.array(*before, F.col(value), *after)

    square = picture.withColumn("line", around("v", "x")).withColumn("square", F.flatten(around("line", "y")))
    return square.select("k", "y", "x", F.element_at(F.sort_array("square"), (2 * radius + 1) ** 2 // 2 + 1).alias("v"))


def cleaned_marks(picture: DataFrame, above: int = 127) -> DataFrame:
    """Marks of dense pictures after a median of five by five, without what is narrower than three: 255 or 0."""
    opened = grown(shrunk(median_blurred(picture, 2), 1), 1)
    return opened.withColumn("v", F.when(F.col("v") > above, 255).otherwise(0))


def turned(pixels: DataFrame, size: DataFrame, flip: Column, half_turn: Column) -> DataFrame:
    """Pixels of the pictures for which flip holds from right to left, and then of those for which half_turn holds upside down and from right to left; both are columns over k."""
    rows = pixels.join(size, "k")
    mirrored = F.when(flip, F.col("width") - 1 - F.col("x")).otherwise(F.col("x"))
    x = F.when(half_turn, F.col("width") - 1 - mirrored).otherwise(mirrored)
    return rows.select("k", F.when(half_turn, F.col("height") - 1 - F.col("y")).otherwise(F.col("y")).alias("y"), x.alias("x"), "v")


def bottom_strip(pixels: DataFrame, size: DataFrame, rows: int = 100, black: int = 0) -> DataFrame:
    """Pixels of the last rows of each picture, counted from the strip's top; lower pictures have none; its first and last rows may be made black, which leaves their pixels out."""
    first = F.col("height") - rows
    strip = pixels.join(size.where(F.col("height") >= rows), "k").where(F.col("y") >= first).select("k", (F.col("y") - first).alias("y"), "x", "v")
    return strip.where(F.col("y").between(black, rows - 1 - black)) if black else strip


def foreground(counts: DataFrame) -> DataFrame:
    """(k, colour, pixels) of the rarer colour of pictures in black and white, black on a tie, from counts of levels; others have no row."""
    of = {name: F.coalesce(F.sum(F.when(F.col("level") == v, F.col("n"))), F.lit(0)) for name, v in (("black", 0), ("white", 255))}
    both = counts.groupBy("k").agg(*[c.alias(n) for n, c in of.items()], F.sum("n").alias("all")).where(F.col("black") + F.col("white") == F.col("all"))
    rare = F.col("white") < F.col("black")
    return both.select("k", F.when(rare, 255).otherwise(0).alias("colour"), F.when(rare, F.col("white")).otherwise(F.col("black")).alias("pixels"))


_UNIT = 1024


def directions(angles: Sequence[int]) -> list[tuple[int, int, int]]:
    """(degrees, cosine, sine) in 1024ths, so that offsets are whole numbers."""
    return [(a, round(math.cos(math.radians(a)) * _UNIT), round(math.sin(math.radians(a)) * _UNIT)) for a in angles]


def line_votes(pixels: DataFrame, angles: Sequence[int]) -> DataFrame:
    """Pixels with a row for each line of the given directions through them: (k, y, x, angle, offset).

    Degrees are those of a line's normal: 90 for rows, 0 for columns.
    """
    ways = F.array(*[F.struct(F.lit(a).alias("angle"), F.lit(c).alias("c"), F.lit(s).alias("s")) for a, c, s in directions(angles)])
    turned = pixels.select("k", "y", "x", F.explode(ways).alias("d"))
    offset = F.floor((F.col("x") * F.col("d.c") + F.col("y") * F.col("d.s") + _UNIT // 2) / _UNIT)
    return turned.select("k", "y", "x", F.col("d.angle").alias("angle"), offset.alias("offset"))


def long_lines(pixels: DataFrame, angles: Sequence[int], least: int, near: int = 2) -> DataFrame:
    """(k, angle, offset, votes) of lines with least pixels, and with more than the lines of their direction within near offsets, or as many and first."""
    votes = line_votes(pixels, angles).groupBy("k", "angle", "offset").agg(F.count("*").alias("votes")).where(F.col("votes") >= least)
    around = Window.partitionBy("k", "angle").orderBy("offset")
    before, after = F.max("votes").over(around.rangeBetween(-near, -1)), F.max("votes").over(around.rangeBetween(1, near))
    peak = (F.col("votes") > F.coalesce(before, F.lit(0))) & (F.col("votes") >= F.coalesce(after, F.lit(0)))
    return votes.withColumn("peak", peak).where("peak").drop("peak")


def without_lines(pixels: DataFrame, lines: DataFrame, angles: Sequence[int], thickness: int = 0) -> DataFrame:
    """Pixels that lie on no line, nor within thickness of one."""
    # for each direction of a picture, which offsets between its first and last line are on one, looked up by number
    wide = lines.groupBy("k", "angle").agg((F.min("offset") - thickness).alias("low"), (F.max("offset") + thickness).alias("high"), F.collect_set("offset").alias("at"))
    far = F.sequence(F.lit(-thickness), F.lit(thickness))
    on = F.map_from_entries(F.transform(F.array_distinct(F.flatten(F.transform("at", lambda o: F.transform(far, lambda d: o + d)))), lambda o: F.struct(o, F.lit(True))))
    wide = wide.withColumn("on", on).select("k", "angle", "low", F.transform(F.sequence("low", "high"), lambda o: F.coalesce(F.try_element_at("on", o), F.lit(False))).alias("on"))
    told = wide.groupBy("k").agg(*[F.first(F.when(F.col("angle") == a, F.struct("low", "on")), ignorenulls=True).alias(f"__{i}") for i, a in enumerate(angles)])
    held = F.lit(False)
    for i, (_, c, s) in enumerate(directions(angles)):
        at = F.floor((F.col("x") * c + F.col("y") * s + _UNIT // 2) / _UNIT) - F.col(f"__{i}.low")
        held = held | F.coalesce(F.get(f"__{i}.on", at.cast("int")), F.lit(False))
    return pixels.join(told, "k", "left").where(~held).select(*pixels.columns)


def level_counts(pixels: DataFrame, size: DataFrame, levels: int = 256) -> DataFrame:
    """(k, level, n) for every level, empty ones too; pixels that are not there count as 0."""
    counts = pixels.groupBy("k", F.col("v").cast("int").alias("level")).agg(F.count("*").alias("n"))
    lit = counts.groupBy("k").agg(F.sum("n").alias("there"))
    dark = size.join(lit, "k", "left").select("k", F.lit(0).alias("level"), (F.col("height").cast("long") * F.col("width") - F.coalesce("there", F.lit(0))).alias("n"))
    every = size.select("k", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"), F.lit(0).cast("long").alias("n"))
    return counts.unionByName(dark).unionByName(every).groupBy("k", "level").agg(F.sum("n").alias("n"))


def otsu_score(counts: DataFrame) -> DataFrame:
    """Counts of levels (k, level, n) with the variance between both sides of each level as score, null where a side is empty."""
    to, whole = Window.partitionBy("k").orderBy("level").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("k")
    n, s = F.col("n"), F.col("n") * F.col("level")
    c = counts.withColumns({"n0": F.sum(n).over(to), "s0": F.sum(s).over(to), "all_n": F.sum(n).over(whole), "all_s": F.sum(s).over(whole)})
    n0, n1 = F.col("n0").cast("double"), (F.col("all_n") - F.col("n0")).cast("double")
    m0, m1 = F.col("s0") / n0, (F.col("all_s") - F.col("s0")) / n1
    return c.withColumn("score", F.when((n0 > 0) & (n1 > 0), n0 * n1 * (m0 - m1) * (m0 - m1))).select(*counts.columns, "score")


def thresholds(counts: DataFrame) -> DataFrame:
    """(k, otsu, yen, triangle, isodata, median) from counts of levels (k, level, n); pixels above a threshold are bright.

    otsu: greatest variance between both sides; yen: greatest correlation of both sides' squared shares; triangle: furthest
    below the line from the peak to the longer tail's end; isodata: first level not below the mean of both sides' means, rounded down; median: first level with half of the
    pixels at or below it.  Of equal levels the first counts; a measure that no level has gives null.
    """
    to = Window.partitionBy("k").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("k")
    n, level = F.col("n"), F.col("level")
    c = counts.select("k", "level", "n", F.sum("n").over(to).alias("n0"), F.sum(n * level).over(to).alias("s0"), F.sum(n * n).over(to).alias("q0"), F.sum("n").over(whole).alias("all_n"), F.sum(n * level).over(whole).alias("all_s"), F.sum(n * n).over(whole).alias("all_q"), F.max(F.when(n > 0, F.struct("n", (-level).alias("l")))).over(whole).alias("most"), F.min(F.when(n > 0, level)).over(whole).alias("first"), F.max(F.when(n > 0, level)).over(whole).alias("last"))
    c = c.withColumns({"peak": -F.col("most.l"), "top": F.col("most.n")})
    n0, n1 = F.col("n0").cast("double"), (F.col("all_n") - F.col("n0")).cast("double")
    both = (n0 > 0) & (n1 > 0)
    m0, m1 = F.col("s0") / n0, (F.col("all_s") - F.col("s0")) / n1
    otsu = F.when(both, n0 * n1 * (m0 - m1) * (m0 - m1))
    q0, q1 = F.col("q0").cast("double"), (F.col("all_q") - F.col("q0")).cast("double")
    yen = F.when((q0 > 0) & (q1 > 0) & both, n0 * n1 * n0 * n1 / (q0 * q1))
    iso = F.when(both & (level >= F.floor((m0 + m1) / 2)), -level)
    half = F.when(F.col("n0") * 2 >= F.col("all_n"), -level)
    # distance from the line between the peak and the empty end, in whole numbers and without its constant factor
    longer = F.col("peak") - F.col("first") >= F.col("last") - F.col("peak")
    end = F.when(longer, F.col("first") - 1).otherwise(F.col("last") + 1)
    inside = F.when(longer, level.between(F.col("first"), F.col("peak"))).otherwise(level.between(F.col("peak"), F.col("last")))
    below = F.when(inside, F.col("top") * F.abs(level - end) - n * F.abs(F.col("peak") - end))
    measures = {"otsu": otsu, "yen": yen, "triangle": below, "isodata": iso, "median": half}
    return c.groupBy("k").agg(*[F.max_by("level", F.when(score.isNotNull(), F.struct(score, -level))).alias(name) for name, score in measures.items()])


_LAPLACE = [(dy, dx, (1, -2, 1)[dy + 1] * (1, -2, 1)[dx + 1]) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def laplacian_noise(pixels: DataFrame, size: DataFrame) -> DataFrame:
    """(k, response, sigma): the sum of absolute second differences in both directions over inner pixels, and the noise it stands for."""
    shares = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(w).alias("w")) for dy, dx, w in _LAPLACE])
    spread = pixels.select("k", "y", "x", "v", F.explode(shares).alias("s")).groupBy("k", (F.col("y") + F.col("s.dy")).alias("y"), (F.col("x") + F.col("s.dx")).alias("x")).agg(F.sum(F.col("v") * F.col("s.w")).alias("d"))
    inner = spread.join(size, "k").where((F.col("y") > 0) & (F.col("x") > 0) & (F.col("y") < F.col("height") - 1) & (F.col("x") < F.col("width") - 1))
    found = size.where("height > 2 AND width > 2").join(inner.groupBy("k").agg(F.sum(F.abs("d")).alias("response")), "k", "left").withColumn("response", F.coalesce("response", F.lit(0)))
    return found.select("k", "response", (F.sqrt(F.lit(math.pi / 2)) * F.col("response") / (6 * (F.col("width") - 2) * (F.col("height") - 2))).alias("sigma"))


def equalised(picture: DataFrame, size: DataFrame, tiles: int = 8, clip: float = 2.0) -> DataFrame:
    """Dense pictures of levels 0 to 255 with contrast-limited adaptive equalisation (Zuiderveld, 1994), each pixel by the four nearest tiles' clipped distributions.

    Pictures are mirrored up to whole tiles.  Tiles count their levels; the counts above a limit are shared out over all levels; running sums give
    each tile a table of 256 shades, which its pixels and those of its neighbours look up.
    """
    tall, wide = F.ceil(F.col("height") / tiles).cast("int"), F.ceil(F.col("width") / tiles).cast("int")
    sized = picture.join(size.withColumns({"th": tall, "tw": wide}), "k")

    def mirrored(at: str, length: str, tile: str) -> Column:
        far = 2 * F.col(length) - 1 - F.col(at)
        return F.when((far >= F.col(length)) & (far < F.col(tile) * tiles), F.array(F.col(at), far)).otherwise(F.array(F.col(at)))

    every = sized.select("k", "th", "tw", "x", "width", "v", F.explode(mirrored("y", "height", "th")).alias("y")).select("k", "th", "tw", "v", "y", F.explode(mirrored("x", "width", "tw")).alias("x"))
    counts = every.groupBy("k", "th", "tw", F.floor(F.col("y") / F.col("th")).cast("int").alias("ty"), F.floor(F.col("x") / F.col("tw")).cast("int").alias("tx"), F.col("v").cast("int").alias("level")).agg(F.count("*").alias("n"))
    most = F.greatest(F.floor(clip * F.col("th") * F.col("tw") / 256), F.lit(1))
    shared = Window.partitionBy("k", "ty", "tx")
    counts = counts.withColumns({"over": F.sum(F.greatest(F.col("n") - most, F.lit(0))).over(shared), "n": F.least("n", most)})
    # the running sum stands until the next level that is there; none is below the first
    levels = shared.orderBy("level")
    counts = counts.withColumns({"sum": F.sum("n").over(levels), "until": F.lead("level", 1, 256).over(levels)})
    stands = F.array_repeat("sum", F.col("until") - F.col("level"))
    found = counts.groupBy("k", "ty", "tx", "th", "tw", "over").agg(F.min("level").alias("first"), F.array_sort(F.collect_list(F.struct("level", stands.alias("sums")))).alias("sums"))
    running = F.concat(F.array_repeat(F.lit(0).cast("long"), F.col("first")), F.flatten(F.transform("sums", lambda s: s["sums"])))
    shade = F.transform(running, lambda c, i: F.least(F.rint((c + (i + 1) * F.col("over") / 256) * 255 / (F.col("th") * F.col("tw"))), F.lit(255.0)))
    # a picture's tables stand side by side, so that a pixel finds its four by their numbers
    every_tile = found.select("k", (F.col("ty") * tiles + F.col("tx")).alias("tile"), shade.alias("shade"))
    tables = every_tile.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("tile", "shade"))).alias("of")).select("k", F.transform(F.sequence(F.lit(0), F.lit(tiles * tiles - 1)), lambda t: F.try_element_at("of", t)).alias("shades"))

    def around(at: str, tile: str) -> list[tuple[Column, Column]]:
        """The two tiles around a place, by their middles, with their shares."""
        middle = (F.col(at) + 0.5) / F.col(tile) - 0.5
        second = middle - F.floor(middle)
        return [(F.least(F.greatest(F.floor(middle) + i, F.lit(0)), F.lit(tiles - 1)).cast("int"), second if i else 1 - second) for i in (0, 1)]

    told = F.lit(0.0)
    for ty, wy in around("y", "th"):
        for tx, wx in around("x", "tw"):
            told = told + F.coalesce(wy * wx * F.get(F.get("shades", ty * tiles + tx), F.col("v").cast("int")), F.lit(0.0))
    return sized.join(tables, "k").select("k", "y", "x", F.rint(F.round(told, 9)).cast("int").alias("v"))
