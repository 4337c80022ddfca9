"""Model, search and session behaviour on data the supplied tables lack."""
import math

import numpy as np
import pytest
from pyspark.ml.feature import PolynomialExpansion, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder

from kiln import session
from kiln.ml import linear as LIN
from kiln.ml import models as L
from kiln.ml import search as H


def xy(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(3)
    y = 2 * x[:, 0] - x[:, 1] ** 2 + (x[:, 2] > 0)
    return spark.createDataFrame([(float(a), float(b), float(c), float(v)) for (a, b, c), v in zip(x, y)], "a double, b double, c double, y double")


def test_depth_beyond_sparks_limit_is_an_error(spark):
    with pytest.raises(ValueError, match="30"):
        L.estimator("tree", maxDepth=50)
    assert not L.estimator("tree", maxDepth=12).getCacheNodeIds()
    assert L.estimator("tree", maxDepth=12, cacheNodeIds=True).getCacheNodeIds()


def test_importances_after_expansion_and_selection(spark):
    df = xy(spark).withColumnRenamed("y", "label")
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="v"), PolynomialExpansion(inputCol="v", outputCol="p", degree=3),
              VarianceThresholdSelector(featuresCol="p", outputCol="s", varianceThreshold=1.1), L.estimator("tree", "s")]
    model = L.fit_pipeline(df, stages)
    got = {r.feature: r.importance for r in L.importances(spark, model).collect()}
    names = [["a", "a^2", "a^3", "b", "a*b", "a^2*b", "b^2", "a*b^2", "b^3"][i] for i in model.stages[2].selectedFeatures]
    assert list(got) == names and len(got) == len(model.stages[-1].featureImportances.toArray())
    assert math.isclose(sum(got.values()), 1.0)
    with pytest.raises(ValueError):
        L.importances(spark, model, ["too", "few"])


@pytest.mark.parametrize("kind,params", [("tree", {"maxDepth": 4}), ("forest", {"maxDepth": 3, "numTrees": 4, "seed": 1}),
                                         ("gbt", {"maxDepth": 2, "maxIter": 4, "seed": 1})])
def test_rules_score_like_the_model(spark, kind, params):
    df = xy(spark).withColumnRenamed("y", "label")
    model = L.fit_pipeline(df, [VectorAssembler(inputCols=["a", "b", "c"], outputCol="v"), L.estimator(kind, "v", **params)])
    leaves = {}
    for r in L.tree_rules(spark, model).collect():
        leaf = leaves.setdefault((r.tree, r.weight, r.leaf), (r.prediction, []))
        if r.feature:
            leaf[1].append((r.feature, r.op, r.threshold))
    trees = {t for t, _, _ in leaves}
    assert trees == set(range(params.get("numTrees", params.get("maxIter", 1))))
    for row in L.score(model, df).collect():
        total = weights = 0.0
        for tree in trees:
            hits = [(w, p) for (t, w, _), (p, conds) in leaves.items() if t == tree
                    and all(row[f] <= x if op == "<=" else row[f] > x for f, op, x in conds)]
            assert len(hits) == 1
            total, weights = total + hits[0][0] * hits[0][1], weights + hits[0][0]
        assert total / (weights if kind == "forest" else 1.0) == pytest.approx(row.prediction)


@pytest.mark.parametrize("cols", [["x"], ["x", "x2"], ["x", "x2", "x3"]])
def test_singular_groups_have_one_rule(spark, cols):
    rows = [("const", 5.0, 5.0, 5.0, float(v)) for v in range(4)] + [("line", float(i), 2.0 * i, 3.0 * i, 7.0 * i + 1) for i in range(6)]
    df = spark.createDataFrame(rows, "g string, x double, x2 double, x3 double, y double")
    got = {r.g: r for r in LIN.ols(df, cols, "y", ["g"]).collect()}
    assert got["const"].intercept == pytest.approx(1.5) and list(got["const"].coef) == pytest.approx([0.0] * len(cols))
    line = np.array([i + 1.0 for i in range(len(cols))])
    want = 7.0 * line / (line @ line)                      # the solution of least norm
    assert list(got["line"].coef) == pytest.approx(want.tolist()) and got["line"].intercept == pytest.approx(1.0)


def brute_ridge(rows, lam):
    out = []
    rows = [r for r in rows if None not in r]
    for f in sorted({r[-1] for r in rows}):
        tr, te = [r for r in rows if r[-1] != f], [r for r in rows if r[-1] == f]
        x, y = np.array([r[:-2] for r in tr], float), np.array([r[-2] for r in tr], float)
        mx, my = x.mean(0), y.mean()
        s = (x - mx).T @ (x - mx) + lam * np.eye(x.shape[1])
        b = np.linalg.solve(s, (x - mx).T @ (y - my))
        e = [r[-2] - my - (np.array(r[:-2], float) - mx) @ b for r in te]
        out.append(np.mean(np.square(e)))
    return float(np.mean(out))


@pytest.mark.parametrize("shift", [0.0, 1e9])
@pytest.mark.parametrize("cols", ["a", ["a", "b"]])
def test_ridge_sweep_with_nulls_and_a_large_offset(spark, shift, cols):
    rng = np.random.default_rng(2)
    base = [(float(a), float(b), float(3 * a - b + e), i % 3) for i, (a, b, e) in enumerate(rng.normal(size=(90, 3)).round(3))]
    rows = [(a + shift, b + shift, y + shift, f) for a, b, y, f in base]
    rows += [(None, 1.0, 2.0, 0)] * 9 + [(1.0, 1.0, None, 1)] * 4 + [(1.0, 2.0, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double, fold int")
    got = {r["lambda"]: r.avg_mse for r in H.ridge_sweep(df, cols, "y", [0.0, 0.5, 10.0]).collect()}
    for lam, v in got.items():
        want = brute_ridge([(a, y, f) if cols == "a" else (a, b, y, f) for a, b, y, f in base], lam)
        assert v == pytest.approx(want, rel=1e-5 if shift else 1e-9)


@pytest.mark.parametrize("cols", ["k", ["k", "a"]])
def test_constant_feature_without_a_penalty_scores_infinity(spark, cols):
    df = xy(spark, 30).selectExpr("4.0D AS k", "a", "y", "cast(abs(a) * 100 as int) % 3 AS fold")
    got = {r["lambda"]: r.avg_mse for r in H.ridge_sweep(df, cols, "y", [0.0, 1.0]).collect()}
    assert got[0.0] == float("inf") and math.isfinite(got[1.0])


def test_trial_table_of_text_parameters(spark):
    lr = LinearRegression()
    maps = ParamGridBuilder().addGrid(lr.solver, ["normal", "l-bfgs"]).addGrid(lr.maxIter, [5]).build()
    rows = H._trial_frame(spark, lr, maps, [1.0, 2.0], "rmse").collect()
    assert [(r.solver, r.maxIter, r.rmse) for r in rows] == [("normal", 5.0, 1.0), ("l-bfgs", 5.0, 2.0)]


def test_failed_trials_keep_their_message(spark):
    def fit(p):
        if p["x"] > 0.5:
            raise RuntimeError("no fit")
        return p["x"]

    out = H.adaptive_search(fit, {"x": ("float", 0.0, 1.0)}, 8, spark=spark).collect()
    assert {r.error for r in out if r.metric == float("inf")} <= {"RuntimeError: no fit"}
    assert all(r.error is None for r in out if r.metric < 1)
    with pytest.raises(ZeroDivisionError):
        H.adaptive_search(lambda p: 1 / 0, {"x": ("float", 0.0, 1.0)}, 3, spark=spark)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
