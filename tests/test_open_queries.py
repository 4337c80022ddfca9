"""Queries without a SQL twin, recomputed with numpy on the small tables."""
import numpy as np
import pytest

import __spark_entry__ as E
from kiln.ml import search as H
from kiln.plans import ml_q, search_q

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@pytest.fixture(scope="module")
def lineitem(spark, sf):
    p = spark.read.parquet(f"{sf}/lineitem.parquet").toPandas()
    p["net"] = p.l_extendedprice.astype(float) * (1 - p.l_discount.astype(float))
    p["train"] = (p.l_orderkey * 7919 + 42) % 10007 < 8006
    return p


def test_flagship_is_least_squares(spark, sf, lineitem):
    x = np.column_stack([np.ones(len(lineitem)), lineitem[FEATS].astype(float)])
    y = lineitem.net.to_numpy(float)
    b = np.linalg.lstsq(x[lineitem.train], y[lineitem.train], rcond=None)[0]
    err = (y - x @ b)[~lineitem.train]
    got = E.queries()["fit_score_eval"](spark, sf).first()
    assert got["rmse"] == pytest.approx(np.sqrt(np.mean(err ** 2)), rel=1e-6)
    t = y[~lineitem.train]
    assert got["r2"] == pytest.approx(1 - (err ** 2).sum() / ((t - t.mean()) ** 2).sum(), rel=1e-9)


def test_elastic_net_meets_its_optimality_conditions(spark, sf, lineitem):
    """At the optimum of the standardised objective each coefficient's gradient
    equals its penalty's, or is within it where the coefficient is zero."""
    out = E.queries()["linreg_elastic"](spark, sf).toPandas()
    tr = lineitem[lineitem.train]
    x = tr[FEATS].astype(float)
    key = ["l_orderkey", "l_linenumber", "net"]
    both = tr.assign(net=tr.net.round(6)).drop_duplicates(key, keep=False).merge(
        out.assign(net=out.net.round(6)).drop_duplicates(key, keep=False), on=key)
    pred = both.prediction.to_numpy()
    zb = ((both[FEATS].astype(float) - x.mean()) / x.std(ddof=1)).to_numpy()
    design = np.column_stack([np.ones(len(zb)), zb])
    coef = np.linalg.lstsq(design, pred, rcond=None)[0]          # predictions are linear in z
    assert np.allclose(design @ coef, pred, atol=0.006)          # the query rounds to cents
    sy, n = both.net.std(ddof=1), len(both)
    grad = zb.T @ (both.net.to_numpy() - pred) / n
    for g, b in zip(grad, coef[1:]):
        want = 0.1 * (0.5 * np.sign(b) + 0.5 * b / sy)
        assert abs(g - want) < 0.02 * max(1.0, sy * 1e-3) if abs(b) > 1e-9 else abs(g) <= 0.05 + 1e-6


def test_principal_components(spark, sf, lineitem):
    out = E.queries()["pca_project"](spark, sf).toPandas()
    z = lineitem[FEATS].astype(float)
    z = ((z - z.mean()) / z.std(ddof=1)).to_numpy()
    _, axes = np.linalg.eigh(np.cov(z.T))
    want = z @ axes[:, ::-1][:, :2]
    cols = [c for c in out.columns if c not in ("l_orderkey", "l_linenumber")]
    for k, c in enumerate(cols):
        assert np.allclose(np.sort(np.abs(out[c])), np.sort(np.abs(want[:, k])), atol=1e-6)


@pytest.mark.parametrize("name", ["forest_reg", "gbt_reg"])
def test_ensembles_beat_the_mean(spark, sf, name):
    out = E.queries()[name](spark, sf).toPandas()
    test = out[~out.is_train]
    spread = ((test.net - out[out.is_train].net.mean()) ** 2).mean()
    assert ((test.net - test.prediction) ** 2).mean() < 0.3 * spread


def test_forest_classifier_predicts_labels(spark, sf):
    out = E.queries()["forest_clf"](spark, sf).toPandas()
    assert set(out.prediction) <= set(out.label) and (out[out.is_train].label == out[out.is_train].prediction).mean() > 0.5


def test_importances_name_every_feature(spark, sf):
    out = E.queries()["feature_importance"](spark, sf).toPandas()
    assert list(out.feature) == ml_q.LI_FEATS and out.importance.sum() == pytest.approx(1.0)
    assert out.set_index("feature").importance.idxmax() == "l_extendedprice"


def test_cv_without_penalty_is_least_squares_per_fold(spark, sf):
    out = E.queries()["cv_search"](spark, sf).toPandas()
    train, _ = search_q.part_folds(spark, sf)
    p = train.toPandas()
    x = np.column_stack([np.ones(len(p)), p[["p_partkey", "p_size"]].astype(float)])
    y = p.p_retailprice.astype(float).to_numpy()
    want = []
    for f in sorted(set(p.fold)):
        tr = (p.fold != f).to_numpy()
        b = np.linalg.lstsq(x[tr], y[tr], rcond=None)[0]
        want.append(np.sqrt(np.mean((y - x @ b)[~tr] ** 2)))
    metric = [c for c in out.columns if c.startswith("avg")][0]
    plain = out[out.regParam == 0.0][metric]
    assert len(out) == 9 and np.allclose(plain, np.mean(want), rtol=1e-6)


def test_adaptive_search_reports_real_metrics(spark, sf):
    out = E.queries()["adaptive_search"](spark, sf).toPandas()
    assert out.trial.tolist() == list(range(len(out))) and out.error.isna().all()
    part = spark.read.parquet(f"{sf}/part.parquet")
    train, test = search_q.R.split(part, "p_partkey", 0.8, 42)
    for r in out.head(2).itertuples():
        stages, lr = search_q.part_stages()
        lr.setRegParam(r.regParam).setElasticNetParam(r.elasticNetParam)
        m = search_q.E.eval_regression(search_q.L.fit_pipeline(train, stages).transform(test), "p_retailprice").first()["rmse"]
        assert m == pytest.approx(r.metric, rel=1e-9)


def test_reports_have_rows(spark, sf):
    for name in ("layout_report", "timing_report"):
        assert E.queries()[name](spark, sf).count() > 0


def test_search_handles_any_parameter(spark, sf):
    train, _ = search_q.part_folds(spark, sf)
    stages, lr = search_q.part_stages()
    res = H.cv_search(train, stages, lr, {"solver": ["normal", "l-bfgs"]}, "p_retailprice", "rmse", "fold")
    assert sorted(r.solver for r in res.trials.collect()) == ["l-bfgs", "normal"]


def test_conditional_search_tries_every_model(spark, sf):
    out = E.queries()["model_search"](spark, sf).toPandas()
    assert len(out) == 16 and set(out.model) == {"linear", "tree"} and out.error.isna().all()
    lin, tree = out[out.model == "linear"], out[out.model == "tree"]
    assert lin.maxDepth.isna().all() and tree.regParam.isna().all()
    assert tree.maxDepth.between(2, 10).all() and (tree.maxDepth % 1 == 0).all()


def test_conditional_search_at_the_whole_budget(spark, sf):
    out = E.queries()["model_search_full"](spark, sf).toPandas()
    assert out.trial.tolist() == list(range(30)) and set(out.model) == {"linear", "tree"} and out.error.isna().all()
    best = out.sort_values("metric").model.iloc[0]
    assert (out.model == best).sum() > 10                      # the search turns to the better model


def test_integer_search_stays_in_its_ranges(spark, sf):
    out = E.queries()["int_search"](spark, sf).toPandas()
    assert len(out) == 20 and out.error.isna().all()
    assert out.minInstancesPerNode.between(10, 200).all() and out.maxBins.between(2, 32).all()
    assert (out.maxBins % 1 == 0).all()


def test_forest_sweep(spark, sf):
    out = E.queries()["forest_sweep"](spark, sf).toPandas()
    assert len(out) == 4 and out.error.isna().all() and (out.avg_rmse > 0).all()


def test_sweep_keeps_errors_and_equals_cross_validation(spark, sf):
    train, _ = search_q.part_folds(spark, sf)
    out = H.sweep(train, [{"maxDepth": 3}, {"maxDepth": 99}], lambda p: search_q._tree_stages("tree", **p), "p_retailprice")
    rows = out.orderBy("trial").collect()
    assert rows[0].error is None and rows[1].avg_rmse is None and "30" in rows[1].error
    stages = search_q._tree_stages("tree")
    cv = H.cv_search(train, stages, stages[1], {"maxDepth": [3]}, "p_retailprice")
    assert cv.trials.first()["avg_rmse"] == pytest.approx(rows[0].avg_rmse)
    with pytest.raises(ValueError):
        H.sweep(train, [{"maxDepth": 99}], lambda p: search_q._tree_stages("tree", **p), "p_retailprice")
