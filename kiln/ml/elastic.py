"""Elastic net from moments (L2, H2): a whole grid of penalties, in every fold,
from one scan.

The objective is Spark's: features and label are standardised (population
deviations), and the penalty ``reg / sd(label)`` is shared by ``mix`` between
the absolute and the squared coefficients. It depends on the data only by the
means and covariances, which Spark aggregates per fold in one pass with partial
sums. Each fold's training moments are the totals less its own; every grid point
is then solved on them by coordinate descent, and scored on the fold's moments.
A fold of the data is never read again, joined or stored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.ml.search import _fold_sums

#: Coordinate descent ends when no standardised coefficient moves by more.
TOLERANCE = 1e-15
SWEEPS = 100_000


def soft(z, t):
    return np.sign(z) * np.maximum(np.abs(z) - t, 0.0)


def descend(corr: np.ndarray, r: np.ndarray, l1: float, l2: float, start: np.ndarray) -> np.ndarray:
    """Minimise ``b'Cb/2 - r'b + l1 |b| + l2 b'b/2`` for a correlation matrix.
    A feature without variance keeps a coefficient of zero."""
    live = np.diag(corr) > 0
    if l1 == 0.0:
        b = np.zeros(len(r))
        c = corr[np.ix_(live, live)] + l2 * np.eye(int(live.sum()))
        b[live] = np.linalg.lstsq(c, r[live], rcond=1e-12)[0]
        return b
    b = np.where(live, start, 0.0)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in np.flatnonzero(live):
            new = soft(r[j] - corr[j] @ b + corr[j, j] * b[j], l1) / (corr[j, j] + l2)
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved <= TOLERANCE:
            return b
    raise ArithmeticError(f"coordinate descent did not settle in {SWEEPS} sweeps")


def path(cov: np.ndarray, cxy: np.ndarray, var_y: float, grid: list[tuple[float, float]]) -> np.ndarray:
    """Coefficients (grid points x features) on the original scale. Points are
    solved from the strongest penalty on, each started from the one before."""
    p = len(cxy)
    out = np.zeros((len(grid), p))
    sx, sy = np.sqrt(np.maximum(np.diag(cov), 0.0)), np.sqrt(max(var_y, 0.0))
    if sy == 0.0:
        return out
    scale = np.where(sx > 0, sx, 1.0)
    corr = np.where(np.outer(sx > 0, sx > 0), cov / np.outer(scale, scale), 0.0)
    r = np.where(sx > 0, cxy / (scale * sy), 0.0)
    np.fill_diagonal(corr, (sx > 0).astype(float))
    b = np.zeros(p)
    for i in sorted(range(len(grid)), key=lambda i: -grid[i][0] * grid[i][1]):
        reg, mix = grid[i]
        b = descend(corr, r, mix * reg / sy, (1 - mix) * reg / sy, b)
        out[i] = b * sy / scale
    return out


def _unpacked(r, pre: str, p: int):
    """n, sum x, sum y, sum xx, sum xy and sum yy of a row of sums."""
    sxx = np.empty((p, p))
    for i in range(p):
        for j in range(i, p):
            sxx[i, j] = sxx[j, i] = r[f"{pre}sxx{i}_{j}"]
    return [np.asarray(x, float) for x in (r[f"{pre}n"], [r[f"{pre}sx{i}"] for i in range(p)], r[f"{pre}sy"], sxx,
                                           [r[f"{pre}sxy{i}"] for i in range(p)], r[f"{pre}syy"])]


def _fit(sums, grid):
    n, sx, sy, sxx, sxy, syy = sums
    mx, my = sx / n, sy / n
    b = path(sxx / n - np.outer(mx, mx), sxy / n - mx * my, float(syy / n - my * my), grid)
    return my - b @ mx, b


def elastic_sweep(df: DataFrame, xs: list[str], y: str, grid: list[tuple[float, float]], fold: str = "fold") -> DataFrame:
    """Cross-validated elastic net over ``grid`` (pairs of penalty and mixing):
    (trial, regParam, elasticNetParam, avg_rmse, n_zero), ``n_zero`` being the
    coefficients that are zero in the mean over folds. Rows with a null feature,
    label or fold take no part; a fold without other rows has no score."""
    p, grid = len(xs), [(float(a), float(m)) for a, m in grid]
    st = _fold_sums(df, list(xs), y, fold)
    names = [c for c in st.columns if c != fold]
    every = Window.partitionBy()                   # over the k fold rows only
    st = st.select(*names, *[F.sum(c).over(every).alias(f"t_{c}") for c in names])

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                own, rest = _unpacked(r, "", p), [t - o for t, o in zip(_unpacked(r, "t_", p), _unpacked(r, "", p))]
                if rest[0] <= 0:
                    continue
                a, b = _fit(rest, grid)
                n, sx, sy, sxx, sxy, syy = own
                sse = (syy - 2 * a * sy - 2 * b @ sxy + n * a * a + 2 * a * (b @ sx) + np.einsum("gi,ij,gj->g", b, sxx, b))
                out += [(i, *g, float(np.sqrt(max(e, 0.0) / n)), float((c == 0).sum())) for i, (g, e, c) in enumerate(zip(grid, sse, b))]
            yield pd.DataFrame(out, columns=["trial", "regParam", "elasticNetParam", "rmse", "zero"])

    scored = st.mapInPandas(run, "trial int, regParam double, elasticNetParam double, rmse double, zero double")
    return scored.groupBy("trial", "regParam", "elasticNetParam").agg(F.avg("rmse").alias("avg_rmse"), F.avg("zero").alias("n_zero"))


def elastic_fit(df: DataFrame, xs: list[str], y: str, reg: float, mix: float) -> tuple[float, list[float], int]:
    """Intercept, coefficients and rows used of one elastic net, from one scan."""
    p = len(xs)
    clean = df.na.drop(subset=[*xs, y])
    means = clean.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate([*xs, y])],
                      *[F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}_{j}")
                        for i, a in enumerate([*xs, y]) for j, b in enumerate([*xs, y]) if j >= i],
                      F.count(F.lit(1)).alias("n")).first()         # p * p numbers
    if not means["n"]:
        raise ValueError("no rows without nulls")
    cov = np.array([[means[f"c{min(i, j)}_{max(i, j)}"] for j in range(p + 1)] for i in range(p + 1)], float)
    b = path(cov[:p, :p], cov[:p, p], float(cov[p, p]), [(float(reg), float(mix))])[0]
    a = means[f"m{p}"] - sum(c * means[f"m{i}"] for i, c in enumerate(b.tolist()))
    return float(a), b.tolist(), int(means["n"])


def linear_expr(intercept: float, coef: list[float], xs: list[str]) -> Column:
    """The fitted line as a column expression."""
    out = F.lit(float(intercept))
    for b, c in zip(coef, xs):
        out = out + F.lit(float(b)) * F.col(c).cast("double")
    return out
