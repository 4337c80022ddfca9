"""Least-squares fits from moment aggregates (D3, D4, and the closed-form
linear models used by the UDF scorers and the sweep).

A linear fit needs only means and covariances, which Spark computes as
stable, mergeable aggregates with map-side partial combine. So a group
holding a third of all rows costs the same shuffle as any other: only one
row of moments per group and task crosses the network, and the system is
solved per group on that one row. Raw rows are never gathered.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.session import checkpoint_root


#: A determinant below this share of the product of variances is singular.
SINGULAR = 1e-12


def _moments(df: DataFrame, keys, features, label) -> DataFrame:
    p = len(features)
    x = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n_used"), F.avg(y).alias("_my")]
    aggs += [F.avg(x[i]).alias(f"_m{i}") for i in range(p)]
    aggs += [F.covar_pop(x[i], x[j]).alias(f"_c{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.covar_pop(x[i], y).alias(f"_cy{i}") for i in range(p)]
    clean = df.na.drop(subset=list(features) + [label])
    return clean.groupBy(*keys).agg(*aggs) if keys else clean.agg(*aggs)


def _solve_small(p: int) -> tuple[Column, list[Column]]:
    """Closed form for one or two features, as Column expressions. A singular
    system gets the solution of least norm, as with more features."""
    if p == 1:
        b = [F.when(F.col("_c0_0") > 0, F.col("_cy0") / F.col("_c0_0")).otherwise(0.0)]
    else:
        s0, s1, c01, y0, y1 = (F.col(c) for c in ("_c0_0", "_c1_1", "_c0_1", "_cy0", "_cy1"))
        det = s0 * s1 - c01 * c01
        regular = det > F.lit(SINGULAR) * s0 * s1
        # of a rank-one matrix S the pseudo-inverse is S / trace(S)^2
        trace2 = (s0 + s1) * (s0 + s1)
        b = [F.when(regular, F.try_divide(s1 * y0 - c01 * y1, det))
             .otherwise(F.coalesce(F.try_divide(s0 * y0 + c01 * y1, trace2), F.lit(0.0))),
             F.when(regular, F.try_divide(s0 * y1 - c01 * y0, det))
             .otherwise(F.coalesce(F.try_divide(c01 * y0 + s1 * y1, trace2), F.lit(0.0)))]
    a = F.col("_my")
    for i in range(p):
        a = a - b[i] * F.col(f"_m{i}")
    return a, b


def ols(df: DataFrame, features, label: str, keys=()) -> DataFrame:
    """Ordinary least squares per group (or overall with no ``keys``):
    keys..., ``intercept``, ``coef`` (array), ``model`` (JSON), ``n_used``.

    One or two features are solved by JVM expressions; more features by a
    vectorised numpy solve over batches of group rows (one row per group).
    """
    keys, features = list(keys), list(features)
    p = len(features)
    mom = _moments(df, keys, features, label)
    if p <= 2:
        a, b = _solve_small(p)
        fit = mom.select(*keys, a.alias("intercept"), F.array(*b).alias("coef"), "n_used")
    else:
        out_schema = T.StructType(
            [mom.schema[k] for k in keys]
            + [T.StructField("intercept", T.DoubleType()),
               T.StructField("coef", T.ArrayType(T.DoubleType())),
               T.StructField("n_used", T.LongType())])

        iu = [(i, j) for i in range(p) for j in range(i, p)]

        def solve(batches):
            # one batched solve per Arrow batch of group rows; groups with a
            # singular system fall back to least squares one by one
            for pdf in batches:
                m = len(pdf)
                c = np.empty((m, p, p))
                for i, j in iu:
                    c[:, i, j] = c[:, j, i] = pdf[f"_c{i}_{j}"].to_numpy(float)
                cy = np.column_stack([pdf[f"_cy{i}"].to_numpy(float) for i in range(p)])
                beta = np.full((m, p), np.nan)
                ok = np.isfinite(c).all(axis=(1, 2)) & np.isfinite(cy).all(axis=1)
                diag = np.prod(np.diagonal(c, axis1=1, axis2=2), axis=1)
                ok &= np.linalg.det(np.where(ok[:, None, None], c, np.eye(p))) > SINGULAR * diag
                if ok.any():
                    beta[ok] = np.linalg.solve(c[ok], cy[ok][..., None])[..., 0]
                for r in np.flatnonzero(~ok):
                    if np.isfinite(c[r]).all() and np.isfinite(cy[r]).all():
                        beta[r] = np.linalg.lstsq(c[r], cy[r], rcond=SINGULAR)[0]
                means = np.column_stack([pdf[f"_m{i}"].to_numpy(float) for i in range(p)])
                out = pdf[keys].copy() if keys else pd.DataFrame(index=pdf.index)
                out["intercept"] = pdf["_my"].to_numpy(float) - (beta * means).sum(axis=1)
                out["coef"] = list(beta)
                out["n_used"] = pdf["n_used"].astype("int64")
                yield out

        fit = mom.mapInPandas(solve, out_schema)
    model = F.to_json(F.struct(F.lit(features).alias("features"), F.col("intercept"), F.col("coef")))
    return fit.withColumn("model", model)


def predict_expr(features, intercept="intercept", coef="coef") -> Column:
    """intercept + sum(coef[i] * x_i), JVM-side."""
    e = F.col(intercept)
    for i, c in enumerate(features):
        e = e + F.col(coef).getItem(i) * F.col(c).cast("double")
    return e


def group_score(df: DataFrame, models: DataFrame, keys, features, label: str | None = None,
                out: str = "prediction") -> DataFrame:
    """Join each row to its group's model and apply it. Keys are kept.
    The join strategy is Catalyst's: the model table is broadcast only when
    its measured size is under the broadcast threshold; otherwise a
    sort-merge join, with AQE splitting a skewed key's partition."""
    keys = list(keys)
    m = models.select(*keys, "intercept", "coef")
    scored = df.join(m, keys, "inner").withColumn(out, predict_expr(features))
    cols = keys + [c for c in df.columns if c not in keys] + [out]
    res = scored.select(*cols)
    if label:
        res = res.withColumn(f"actual_{label}", F.col(label).cast("double"))
    return res


def group_fit(df: DataFrame, keys, features, label: str) -> DataFrame:
    """D3: one linear model per group: keys, intercept, coef, model (JSON),
    in-sample mse, n_used. Two passes: moments, then residuals."""
    keys = list(keys)
    checkpoint_root(df.sparkSession)
    # The model table (one row per group) is used twice below; writing it
    # once to the shared checkpoint folder saves a second moment pass and
    # cuts the lineage a lost executor would otherwise recompute.
    models = ols(df, features, label, keys).checkpoint(eager=True)
    scored = group_score(df.na.drop(subset=list(features) + [label]), models, keys, features)
    err = (F.col(label).cast("double") - F.col("prediction"))
    mse = scored.groupBy(*keys).agg(F.avg(err * err).alias("mse"))
    return models.join(mse, keys, "left").select(*keys, "intercept", "coef", "model", "mse", "n_used")
