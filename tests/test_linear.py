"""Moment-based least squares against numpy on the same rows."""
import numpy as np
from pyspark.sql import functions as F

from kiln.ml import linear as LIN
from kiln.ml import search as H
from kiln.operators import relational as R

FEATS = ["l_quantity", "l_discount", "l_tax"]


def test_group_ols_three_features_matches_numpy(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("g", F.col("l_suppkey") % 3)
    fit = {r.g: r for r in LIN.ols(li, FEATS, "l_extendedprice", ["g"]).collect()}
    pdf = li.select("g", *FEATS, "l_extendedprice").toPandas()
    for g, part in pdf.groupby("g"):
        x = np.column_stack([np.ones(len(part))] + [part[c].to_numpy() for c in FEATS])
        beta = np.linalg.lstsq(x, part["l_extendedprice"].to_numpy(), rcond=None)[0]
        assert abs(fit[g].intercept - beta[0]) < 1e-6 * max(1.0, abs(beta[0]))
        assert np.allclose(fit[g].coef, beta[1:], rtol=1e-7, atol=1e-6)


def test_group_fit_mse_matches_numpy(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("g", F.col("l_suppkey") % 2)
    got = {r.g: r for r in LIN.group_fit(li, ["g"], FEATS, "l_extendedprice").collect()}
    pdf = li.select("g", *FEATS, "l_extendedprice").toPandas()
    for g, part in pdf.groupby("g"):
        x = np.column_stack([np.ones(len(part))] + [part[c].to_numpy() for c in FEATS])
        y = part["l_extendedprice"].to_numpy()
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        mse = float(np.mean((y - x @ beta) ** 2))
        assert abs(got[g].mse - mse) < 1e-6 * mse and got[g].n_used == len(part)


def test_ridge_sweep_several_features_matches_numpy(spark, sf):
    li = R.with_fold(spark.read.parquet(f"{sf}/lineitem.parquet"), "l_orderkey", 3, 42)
    feats, y, lams = ["l_quantity", "l_discount"], "l_extendedprice", [0.0, 10.0, 1e4]
    got = {r.trial: r.avg_mse for r in H.ridge_sweep(li, feats, y, lams, "fold").collect()}
    pdf = li.select("fold", *feats, y).toPandas()
    for t, lam in enumerate(lams):
        mses = []
        for k in range(3):
            tr, va = pdf[pdf.fold != k], pdf[pdf.fold == k]
            xt = tr[feats].to_numpy(float)
            mx, my = xt.mean(0), tr[y].mean()
            xc, yc = xt - mx, tr[y].to_numpy() - my
            b = np.linalg.solve(xc.T @ xc + lam * np.eye(len(feats)), xc.T @ yc)
            a = my - mx @ b
            pred = a + va[feats].to_numpy(float) @ b
            mses.append(np.mean((va[y].to_numpy() - pred) ** 2))
        assert abs(got[t] - np.mean(mses)) < 1e-6 * np.mean(mses)
    # one feature: the JVM-expression path agrees with the general one
    one = {r.trial: r.avg_mse for r in H.ridge_sweep(li, "l_quantity", y, lams, "fold").collect()}
    gen = {r.trial: r.avg_mse for r in H._ridge_sweep_multi(li, ["l_quantity"], y, lams, "fold").collect()}
    assert all(abs(one[t] - gen[t]) < 1e-6 * gen[t] for t in one)


def test_group_ols_singular_group_falls_back(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("g", F.col("l_suppkey") % 2)
    li = li.withColumn("const", F.when(F.col("g") == 0, F.lit(1.0)).otherwise(F.col("l_tax")))
    fit = {r.g: r for r in LIN.ols(li, ["l_quantity", "l_discount", "const"], "l_extendedprice", ["g"]).collect()}
    assert set(fit) == {0, 1}
    assert all(np.isfinite(fit[g].coef).all() and np.isfinite(fit[g].intercept) for g in fit)
    # the constant column carries no slope in the singular group (minimum-norm solution)
    assert abs(fit[0].coef[2]) < 1e-6
