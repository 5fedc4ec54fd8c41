"""Boxes, tiles and piecewise-linear grids as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def area(b: Box) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0)) * F.greatest(b[3] - b[1], F.lit(0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union, 0 for boxes without area."""
    both = area((F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])))
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def yolo_box(b: Box, width: Column, height: Column) -> Box:
    """Pixel corners to centre and size as shares of the image."""
    return ((b[0] + b[2]) / 2 / width, (b[1] + b[3]) / 2 / height, (b[2] - b[0]) / width, (b[3] - b[1]) / height)


def pixel_box(y: Box, width: Column, height: Column) -> Box:
    """Centre and size to pixel corners, cut to the image; fractions are dropped."""
    def cut(v: Column, most: Column) -> Column:
        return F.greatest(F.lit(0), F.least(v.cast("int"), most))

    return (cut((y[0] - y[2] / 2) * width, width), cut((y[1] - y[3] / 2) * height, height), cut((y[0] + y[2] / 2) * width, width), cut((y[1] + y[3] / 2) * height, height))


def tile_box(b: Box, tile_left: Column, scale: Column, width: Column, height: Column) -> Box:
    """A box found in a scaled tile, in the image: outer pixels, one wide and high at least."""
    x1, y1 = F.greatest(F.lit(0), F.floor((b[0] + tile_left) / scale)), F.greatest(F.lit(0), F.floor(b[1] / scale))
    x2, y2 = F.least(width, F.ceil((b[2] + tile_left) / scale)), F.least(height, F.ceil(b[3] / scale))
    return x1, y1, F.greatest(x2, x1 + 1), F.greatest(y2, y1 + 1)


def tile_starts(width: Column, tile: int = 512, overlap: int = 128) -> Column:
    """Left edges of tiles that cover the width; the last one ends at its end."""
    last = F.greatest(F.lit(0), width - tile).cast("int")
    return F.array_distinct(F.concat(F.filter(F.sequence(F.lit(0), last, F.lit(tile - overlap)), lambda s: s < last), F.array(last)))


def letterbox(width: Column, height: Column, to_width: int, to_height: int) -> dict[str, Column]:
    """Scale, whole size and centred padding of an image fitted into a frame."""
    scale = F.least(F.lit(float(to_width)) / width, F.lit(float(to_height)) / height)
    w, h = (width * scale).cast("int"), (height * scale).cast("int")
    return {"scale": scale, "width": w, "height": h, "left": F.floor((to_width - w) / 2).cast("int"), "top": F.floor((to_height - h) / 2).cast("int")}


def piecewise(x: Column, grid: Column, legacy: bool = False) -> Column:
    """Value at x of array<struct<x, v>> joined by lines, null outside; legacy gives 0 on grid lines."""
    nodes = F.array_sort(F.transform(grid, lambda g: F.struct(g["x"].cast("double").alias("x"), g["v"].cast("double").alias("v"))))
    left = F.try_element_at(F.filter(nodes, lambda g: g["x"] <= x), F.lit(-1))
    right = F.try_element_at(F.filter(nodes, lambda g: g["x"] >= x), F.lit(1))
    on = F.when(left["x"] == right["x"], F.lit(0.0) if legacy else left["v"])
    return F.coalesce(on, left["v"] + (right["v"] - left["v"]) * (x - left["x"]) / F.nullif(right["x"] - left["x"], F.lit(0.0)))


def inverse_piecewise(v: Column, grid: Column, legacy: bool = False) -> Column:
    """Position of a value on the grid; legacy gives the value itself on grid lines."""
    flipped = F.transform(grid, lambda g: F.struct(g["v"].alias("x"), g["x"].alias("v")))
    found = piecewise(v, flipped)
    return F.when(F.exists(grid, lambda g: g["v"] == v), v).otherwise(found) if legacy else found


def by_two_anchors(y: Column, y1: Column, v1: float, y2: Column, v2: float) -> Column:
    return v1 + (y - y1) * (v2 - v1) / (y2 - y1)


def nearest_label(x: Column, labels: Column) -> Column:
    """Label of the nearest of array<struct<at, label>>; of equally near ones the first."""
    order = F.transform(labels, lambda g, i: F.struct(F.abs(g["at"] - x).alias("far"), i.alias("i"), g["label"].alias("label")))
    return F.array_min(order)["label"]


def largest_margin(height: Column, width: Column, left: Column, right: Column, top: Column, bottom: Column) -> Column:
    """Which side of the kept rectangle has the largest area; of equal ones the first of left, right, top, bottom."""
    sides = {"left": left * height, "right": (width - right) * height, "top": top * width, "bottom": (height - bottom) * width}
    return F.array_max(F.array(*[F.struct(a.cast("double").alias("a"), F.lit(-i).alias("i"), F.lit(n).alias("side")) for i, (n, a) in enumerate(sides.items())]))["side"]


# fixed values: curve families fitted to traces
CURVES = {
    "rational": lambda x, a, b, c: (a + b * x) / (1 + c * x),
    "exponential": lambda x, a, b, c: a * F.exp(b * x) + c,
    "logarithm": lambda x, a, b, c: a * F.ln(b * x) + c,
    "power": lambda x, a, b, c: a * F.pow(x, b) + c,
    "logistic": lambda x, a, b, c: a / (1 + F.exp(-b * (x - c))),
}


def suppressed(boxes: str, limit: float = 0.5) -> Column:
    """Of an array of boxes (fields x1, y1, x2, y2), best first, those that overlap no kept one by the limit or more."""

    def corners(b: Column) -> Box:
        return tuple(b[c] for c in ("x1", "y1", "x2", "y2"))

    none = F.slice(boxes, 1, 0)
    return F.aggregate(F.col(boxes), none, lambda kept, b: F.when(F.exists(kept, lambda k: iou(corners(k), corners(b)) >= limit), kept).otherwise(F.concat(kept, F.array(b))))


def first_usable(candidates: dict[str, Column], failure: str = "no usable region") -> Column:
    """struct(source, box, reason): the first candidate box, in the order given, that is not null and has an area."""
    found = F.lit(None)
    for name, box in reversed(candidates.items()):
        ok = box.isNotNull() & F.coalesce((box["x2"] > box["x1"]) & (box["y2"] > box["y1"]), F.lit(False))
        found = F.when(ok, F.struct(F.lit(name).alias("source"), box.alias("box"), F.lit(None).cast("string").alias("reason"))).otherwise(found)
    none = F.struct(F.lit("failure").alias("source"), F.lit(None).cast("struct<x1:int,y1:int,x2:int,y2:int>").alias("box"), F.lit(failure).alias("reason"))
    return F.coalesce(found, none)
