"""Elastic net from moments: optimality, Spark's own fit, edge cases."""
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from kiln.ml import elastic as EN

XS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 3)) * [1, 50, 0.01] + [0, 1e6, 3]
    x = np.column_stack([x, 0.9 * x[:, 1] + rng.normal(size=900) * 10])
    y = 3 * x[:, 0] + 0.2 * x[:, 1] + rng.normal(size=900)
    rows = [(i, *map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))]
    rows += [(900, None, 1.0, 1.0, 1.0, 1.0, 0), (901, 1.0, 1.0, 1.0, 1.0, None, 1), (902, *rows[0][1:6], None)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, fold int").repartition(4)


@pytest.mark.parametrize("reg,mix", [(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (2.0, 1.0), (1e6, 0.5)])
def test_fit_is_optimal_and_spark_agrees(table, reg, mix):
    a, b, n = EN.elastic_fit(table, XS, "y", reg, mix)
    p = table.na.drop(subset=[*XS, "y"]).toPandas()
    assert n == len(p)
    x, y = p[XS].to_numpy(), p.y.to_numpy()
    sx, sy = x.std(0), y.std()
    z = (x - x.mean(0)) / sx
    t = np.array(b) * sx / sy                                   # standardised coefficients
    grad = z.T @ ((y - a - x @ np.array(b)) / sy) / len(p)
    for g, c in zip(grad, t):
        if c != 0:
            assert g == pytest.approx(reg / sy * (mix * np.sign(c) + (1 - mix) * c), abs=1e-8)
        else:
            assert abs(g) <= reg / sy * mix + 1e-8
    rows = VectorAssembler(inputCols=XS, outputCol="features").transform(table.na.drop())
    fit = LinearRegression(labelCol="y", regParam=reg, elasticNetParam=mix, tol=1e-14, maxIter=5000).fit(rows)
    own = EN.elastic_fit(table.na.drop(), XS, "y", reg, mix)
    assert np.allclose(fit.coefficients.toArray() * sx, np.array(own[1]) * sx, atol=2e-3 * sy)


def test_sweep_equals_fits_per_fold(table):
    grid = [(0.0, 0.0), (0.1, 1.0), (1.0, 0.5), (50.0, 1.0)]
    got = {r["trial"]: r for r in EN.elastic_sweep(table, XS, "y", grid).collect()}
    for i, (reg, mix) in enumerate(grid):
        rmse, zero = [], []
        for k in range(3):
            a, b, _ = EN.elastic_fit(table.filter(F.col("fold") != k), XS, "y", reg, mix)
            e = F.col("y") - EN.linear_expr(a, b, XS)
            held = table.filter(F.col("fold") == k).na.drop(subset=[*XS, "y"])
            rmse.append(held.agg(F.sqrt(F.avg(e * e))).first()[0])
            zero.append(sum(c == 0 for c in b))
        assert got[i]["avg_rmse"] == pytest.approx(np.mean(rmse), rel=1e-7) and got[i]["n_zero"] == np.mean(zero)
    assert got[3]["n_zero"] == 4.0


def test_data_is_read_in_one_scan(table):
    plan = EN.elastic_sweep(table, XS, "y", [(0.1 * i, 0.5) for i in range(30)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Join" not in plan


def test_constant_columns_and_labels(spark):
    df = spark.createDataFrame([(float(i), 5.0, 2.0 * i, i % 2) for i in range(20)], "x double, k double, y double, fold int")
    a, b, _ = EN.elastic_fit(df, ["x", "k"], "y", 0.0, 0.0)
    assert b == pytest.approx([2.0, 0.0]) and a == pytest.approx(0.0, abs=1e-9)
    assert EN.elastic_fit(df, ["x"], "k", 0.3, 0.5)[:2] == (5.0, [0.0])
    one = EN.elastic_sweep(df.withColumn("fold", F.lit(0)), ["x"], "y", [(0.1, 0.5)])
    assert one.count() == 0                                     # no fold has other rows to learn from
    with pytest.raises(ValueError):
        EN.elastic_fit(df.filter("false"), ["x"], "y", 0.1, 0.5)
