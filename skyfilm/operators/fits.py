"""Curves fitted by least squares from sums that merge, one aggregation a step; no group of points is in one place.

Polynomials follow from sums of powers of x, scaled to [-1, 1], by elimination in a fold.  Curves g(a + b u) of a line start from the
line through their transformed points and are improved by rounds of Gauss and Newton's method, each of which needs five sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import dealt, stored

#: a pivot below this leaves a polynomial undetermined
LEAST_PIVOT = 1e-9


@dataclass(frozen=True)
class Line:
    """SQL for a curve g(a + b u): u over x, the transform of y that makes it a line, g and g' over a value z of the line; m is the group's capacity."""

    name: str
    u: str
    straight: str
    curve: str
    slope: str


#: y = a + b ln x, y = a + b / x, y = exp(a + b x), y = exp(a) x^b, y = m / (1 + exp(-(a + b x)))
LINES = (
    Line("log", "CASE WHEN x > 0 THEN ln(x) END", "y", "z", "1.0D"),
    Line("rational", "CASE WHEN x <> 0 THEN 1 / x END", "y", "z", "1.0D"),
    Line("exponential", "x", "CASE WHEN y > 0 THEN ln(y) END", "exp(z)", "exp(z)"),
    Line("power", "CASE WHEN x > 0 THEN ln(x) END", "CASE WHEN y > 0 THEN ln(y) END", "exp(z)", "exp(z)"),
    Line("logistic", "x", "CASE WHEN y > 0 AND y < m THEN ln(y / (m - y)) END", "m / (1 + exp(-z))", "m * exp(-z) / ((1 + exp(-z)) * (1 + exp(-z)))"),
)
#: capacity of logistic curves over the greatest y
HEADROOM = 1.01


def _horner(coefficients: list[Column], t: Column) -> Column:
    out = coefficients[-1]
    for c in reversed(coefficients[:-1]):
        out = out * t + c
    return out


def solved(matrix: Column, size: int) -> Column:
    """Solution of size equations, an array of rows with the right side last; null entries where they are not independent."""

    def pivot(row: Column, k: Column) -> Column:
        return F.when(F.abs(row[k]) > LEAST_PIVOT, row[k])

    def step(m: Column, k: Column) -> Column:
        return F.transform(m, lambda row, i: F.when(i == k, row).otherwise(F.zip_with(row, m[k], lambda a, b: a - row[k] / pivot(m[k], k) * b)))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), matrix, step)
    return F.transform(done, lambda row, i: row[size] / pivot(row, i))


def polynomials(points: DataFrame, highest: int) -> DataFrame:
    """(k, p1, ..., p<highest>, mid, half): coefficients in (x - mid) / half of the polynomials of each degree through points (k, x, y)."""
    low, high = points.agg(F.min("x"), F.max("x")).first()
    mid, half = ((low + high) / 2, (high - low) / 2 or 1.0) if low is not None else (0.0, 1.0)
    t = (F.col("x") - mid) / half
    powers = [F.lit(1.0)]
    for _ in range(2 * highest):
        powers.append(powers[-1] * F.col("t"))
    scaled = points.where("x IS NOT NULL AND y IS NOT NULL").withColumn("t", t)
    sums = scaled.groupBy("k").agg(F.array(*[F.sum(p) for p in powers]).alias("s"), F.array(*[F.sum(F.col("y") * p) for p in powers[: highest + 1]]).alias("r"))
    fits = []
    for d in range(1, highest + 1):
        rows = F.array(*[F.array(*[F.col("s")[i + j] for j in range(d + 1)], F.col("r")[i]) for i in range(d + 1)])
        fits.append(solved(rows, d + 1).alias(f"p{d}"))
    return sums.select("k", *fits, F.lit(float(mid)).alias("mid"), F.lit(float(half)).alias("half"))


def _solve_two(uu: Column, u: Column, n: Column, ur: Column, r: Column) -> tuple[Column, Column]:
    """a and b of n a + u b = r and u a + uu b = ur."""
    det = n * uu - u * u
    whole = F.when(F.abs(det) > LEAST_PIVOT, det)
    return (uu * r - u * ur) / whole, (n * ur - u * r) / whole


def curve_fits(points: DataFrame, highest: int = 9, rounds: int = 2, lines: tuple[Line, ...] = LINES) -> DataFrame:
    """(k, family, residual, best): sums of squared residuals of every curve through the points (k, x, y) of each group, and the least.

    Families are poly1 to poly<highest> and the lines' names, the earlier of equals is best.  Curves that the points leave undetermined, or that are not defined at
    all of them, have no row.  Of a line's rounds the best counts.  What a round finds, a row for each group, is stored, so a task holds the points of one round.
    """
    points = dealt(points.select("k", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL"))
    capacity = points.groupBy("k").agg((F.max("y") * HEADROOM).alias("m"))
    state = stored(polynomials(points, highest).join(capacity, "k"), "state")
    sums = []
    for line in lines:
        u, w = F.expr(line.u), F.expr(line.straight)
        ok = u.isNotNull() & w.isNotNull()
        u, w = F.when(ok, u), F.when(ok, w)
        sums += [F.sum(e).alias(f"{line.name}_{name}") for name, e in (("uu", u * u), ("u", u), ("uw", u * w), ("w", w))] + [F.sum(ok.cast("double")).alias(f"{line.name}_n")]
    first = points.join(state.select("k", "m"), "k").groupBy("k").agg(*sums)
    start = []
    for line in lines:
        uu, u, n, uw, w = (F.col(f"{line.name}_{c}") for c in ("uu", "u", "n", "uw", "w"))
        a, b = _solve_two(uu, u, n, uw, w)
        start += [a.alias(f"{line.name}_a"), b.alias(f"{line.name}_b"), F.lit(None).cast("double").alias(f"{line.name}_best")]
    state = stored(state.join(first.select("k", *start), "k"), "state")
    for round_ in range(rounds + 1):
        sums = []
        for line in lines:
            u = F.expr(line.u)
            z = F.col(f"{line.name}_a") + F.col(f"{line.name}_b") * u
            value, slope = (F.expr(e) for e in (line.curve.replace("z", f"{line.name}_z"), line.slope.replace("z", f"{line.name}_z")))
            off = F.col("y") - value
            sums += [(z.alias(f"{line.name}_z")), {"sse": off * off, "bad": value.isNull().cast("double"), "uu": slope * slope * u * u, "u": slope * slope * u, "n": slope * slope, "ur": slope * u * off, "r": slope * off}]
        joined = points.join(state, "k").select("*", *[s for s in sums if isinstance(s, Column)])
        named = [F.sum(e).alias(f"{line.name}_{c}") for line, s in zip(lines, (s for s in sums if isinstance(s, dict)), strict=True) for c, e in s.items()]
        polys = [] if round_ else [F.sum((F.col("y") - _horner([F.col(f"p{d}")[i] for i in range(d + 1)], (F.col("x") - F.col("mid")) / F.col("half"))) ** 2).alias(f"poly{d}") for d in range(1, highest + 1)]
        found = joined.groupBy("k").agg(*named, *polys)
        kept = [c for c in state.columns if c not in ("k",) and not c.startswith(tuple(line.name + "_" for line in lines))]
        new = []
        for line in lines:
            col = lambda c, line=line: F.col(f"{line.name}_{c}")
            sse = F.when(col("bad") == 0, col("sse"))
            da, db = _solve_two(col("uu"), col("u"), col("n"), col("ur"), col("r"))
            new += [(col("a") + da).alias(f"{line.name}_a"), (col("b") + db).alias(f"{line.name}_b"), F.least(col("best"), sse).alias(f"{line.name}_best")]
        residuals = [f"poly{d}" for d in range(1, highest + 1)]
        state = stored(state.join(found, "k").select("k", *kept, *new, *([] if round_ else residuals)), "state")
    families = [f"poly{d}" for d in range(1, highest + 1)] + [line.name for line in lines]
    values = [F.col(f"poly{d}") for d in range(1, highest + 1)] + [F.col(f"{line.name}_best") for line in lines]
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("family"), v.alias("residual")) for i, (f, v) in enumerate(zip(families, values, strict=True))])
    known = F.filter(rows, lambda r: r["residual"].isNotNull() & ~F.isnan(r["residual"]))
    least = F.array_min(F.transform(known, lambda r: F.struct(r["residual"].alias("residual"), r["i"].alias("i"))))
    return state.select("k", least.alias("least"), F.explode(known).alias("r")).select("k", "r.family", "r.residual", (F.col("r.i") == F.col("least.i")).alias("best"))
