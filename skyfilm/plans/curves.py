"""The query of curve families, with SQL that eliminates and iterates step by step."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fits as FT
from .registry import query, table

HIGHEST, ROUNDS = 4, 2
_POINTS = ("l_suppkey AS k", "l_quantity AS x", "l_extendedprice / 1000 AS y")


def _elimination(d: int) -> str:
    """CTEs q<d>_0, q<d>_1, ... whose last one holds the coefficients of degree d."""
    n, steps = d + 1, []
    entry = lambda i, j: f"a{i}_{j}"
    first = [f"s{i + j} AS {entry(i, j)}" if j < n else f"r{i} AS {entry(i, j)}" for i in range(n) for j in range(n + 1)]
    steps.append(f"q{d}_0 AS (SELECT k, {', '.join(first)} FROM moments)")
    for p in range(n):
        cells = [entry(i, j) if i == p else f"{entry(i, j)} - {entry(i, p)} / {entry(p, p)} * {entry(p, j)} AS {entry(i, j)}" for i in range(n) for j in range(n + 1)]
        steps.append(f"q{d}_{p + 1} AS (SELECT k, {', '.join(cells)} FROM q{d}_{p})")
    steps.append(f"c{d} AS (SELECT k, {', '.join(f'{entry(i, n)} / {entry(i, i)} AS p{i}' for i in range(n))} FROM q{d}_{n})")
    value = f"p{d}"
    for i in reversed(range(d)):
        value = f"({value}) * t + p{i}"
    steps.append(f"e{d} AS (SELECT k, 'poly{d}' AS family, {d} AS i, sum((y - ({value})) * (y - ({value}))) AS residual FROM scaled JOIN c{d} USING (k) GROUP BY k)")
    return ", ".join(steps)


def _iteration(line: FT.Line, i: int) -> str:
    """CTEs for one curve: its line, then rounds of five sums each."""
    name, u, w = line.name, line.u, line.straight
    value, slope = line.curve.replace("1.0D", "1.0"), line.slope.replace("1.0D", "1.0")
    det = "(n * uu - u * u)"
    steps = [f"{name}_s AS (SELECT k, sum(u * u) AS uu, sum(u) AS u, sum(u * w) AS ur, sum(w) AS r, count(*)::DOUBLE AS n FROM (SELECT k, {u} AS u, {w} AS w FROM p JOIN cap USING (k)) WHERE u IS NOT NULL AND w IS NOT NULL GROUP BY k)",
             f"{name}_0 AS (SELECT k, (uu * r - u * ur) / {det} AS a, (n * ur - u * r) / {det} AS b FROM {name}_s)"]
    for k in range(ROUNDS + 1):
        steps.append(f"{name}_v{k} AS (SELECT k, y, u, a, b, {value} AS v, {slope} AS g FROM (SELECT k, x, y, m, a, b, {u} AS u, a + b * ({u}) AS z FROM p JOIN cap USING (k) JOIN {name}_{k} USING (k)))")
        steps.append(f"{name}_t{k} AS (SELECT k, any_value(a) AS a, any_value(b) AS b, sum((y - v) * (y - v)) AS sse, count(*) FILTER (v IS NULL) AS bad, sum(g * g * u * u) AS uu, sum(g * g * u) AS u, sum(g * g) AS n, sum(g * u * (y - v)) AS ur, sum(g * (y - v)) AS r FROM {name}_v{k} GROUP BY k)")
        steps.append(f"{name}_{k + 1} AS (SELECT k, a + (uu * r - u * ur) / {det} AS a, b + (n * ur - u * r) / {det} AS b FROM {name}_t{k})")
    each = " UNION ALL ".join(f"SELECT k, sse FROM {name}_t{k} WHERE bad = 0" for k in range(ROUNDS + 1))
    steps.append(f"e_{name} AS (SELECT k, '{name}' AS family, {i} AS i, min(sse) AS residual FROM ({each}) GROUP BY k)")
    return ", ".join(steps)


_MOMENTS = ", ".join([f"sum(t ** {i}) AS s{i}" for i in range(2 * HIGHEST + 1)] + [f"sum(y * t ** {i}) AS r{i}" for i in range(HIGHEST + 1)])
_ALL = " UNION ALL ".join([f"SELECT * FROM e{d}" for d in range(1, HIGHEST + 1)] + [f"SELECT * FROM e_{line.name}" for line in FT.LINES])
FITS_SQL = f"""WITH p AS (SELECT {', '.join(_POINTS)} FROM lineitem), cap AS (SELECT k, max(y) * {FT.HEADROOM} AS m FROM p GROUP BY 1),
    ends AS (SELECT (min(x) + max(x)) / 2 AS mid, (max(x) - min(x)) / 2 AS half FROM p), scaled AS (SELECT k, y, (x - mid) / half AS t FROM p, ends), moments AS (SELECT k, {_MOMENTS} FROM scaled GROUP BY k),
    {', '.join(_elimination(d) for d in range(1, HIGHEST + 1))}, {', '.join(_iteration(line, HIGHEST + i) for i, line in enumerate(FT.LINES, 1))}
    SELECT k, family, round(residual, 4) AS residual, row_number() OVER (PARTITION BY k ORDER BY residual, i) = 1 AS best FROM ({_ALL}) WHERE residual IS NOT NULL"""


@query("im26_curve_fit", FITS_SQL)
def _(spark, sf):
    return FT.curve_fits(table(spark, sf, "lineitem").selectExpr(*_POINTS), HIGHEST, ROUNDS).withColumn("residual", F.round("residual", 4))
