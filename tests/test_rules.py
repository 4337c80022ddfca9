"""Exported rules against the models they come from; exact area under the curve."""
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

import __spark_entry__ as E
from kiln.ml import evaluation as EV
from kiln.ml import features as M
from kiln.ml import models as L
from kiln.ml import rules as RU

XS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 12, 800), rng.normal(size=800).round(2), rng.integers(0, 3, 800)]).astype(float)
    y = x[:, 0] * 2 + x[:, 1] ** 2 + rng.normal(size=800)
    df = spark.createDataFrame([(i, *map(float, r), float(v), float(v > 10), float(int(v) % 3 if v > 0 else 0))
                                for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, y double, two double, three double")
    return df.repartition(3).cache()


def model(rows, kind, label, **params):
    return L.fit_pipeline(rows, [M.assembler(XS, "features"), L.estimator(kind, "features", label, **params)])


CASES = [("tree", "y", {"maxDepth": 6}), ("forest", "y", {"numTrees": 7, "maxDepth": 4, "seed": 1}),
         ("gbt", "y", {"maxIter": 6, "maxDepth": 3, "seed": 1}), ("tree_clf", "three", {"maxDepth": 4}),
         ("forest_clf", "three", {"numTrees": 9, "maxDepth": 4, "seed": 1}), ("tree", "y", {"maxDepth": 0})]


@pytest.mark.parametrize("kind,label,params", CASES)
@pytest.mark.parametrize("way", [RU.score_by_leaves, RU.score, lambda d, m, names=None: d.withColumn("prediction", RU.expression(d.sparkSession, m))])
def test_rules_score_like_the_model(spark, rows, kind, label, params, way):
    m = model(rows, kind, label, **params)
    want = {r["id"]: r["prediction"] for r in m.transform(rows).select("id", "prediction").collect()}
    more = rows.select("id", *XS).unionByName(spark.createDataFrame([(-1, None, 0.0, 1.0), (-2, 99.0, -99.0, 1.0)], "id long, a double, b double, c double"))
    got = {r["id"]: r["prediction"] for r in way(more, m).collect()}
    assert got.keys() == want.keys() | {-1, -2}
    assert all(got[i] == pytest.approx(want[i], rel=1e-12) for i in want)
    if params.get("maxDepth"):
        assert got[-1] is None and got[-2] is not None


def test_boosted_classifier_and_categories(spark, rows):
    m = Pipeline(stages=[VectorAssembler(inputCols=XS, outputCol="features"),
                         GBTClassifier(labelCol="two", maxIter=5, maxDepth=3, seed=2)]).fit(rows)
    want = [r[0] for r in m.transform(rows).orderBy("id").select("prediction").collect()]
    for got in (RU.score(rows, m), RU.score_by_leaves(rows, m)):
        assert [r["prediction"] for r in got.orderBy("id").collect()] == want
    named = rows.withColumn("s", F.concat(F.lit("k"), (F.col("c") + F.col("a") % 2).cast("int").cast("string")))
    m = Pipeline(stages=[StringIndexer(inputCol="s", outputCol="si"), VectorAssembler(inputCols=["si", "b"], outputCol="features"),
                         L.estimator("tree", "features", "y", maxDepth=4)]).fit(named)
    indexed = m.stages[0].transform(named)
    want = [r[0] for r in m.transform(named).orderBy("id").select("prediction").collect()]
    assert RU.nodes(spark, m).filter("categories is not null").count() > 0
    assert [r["prediction"] for r in RU.score(indexed, m).orderBy("id").collect()] == pytest.approx(want)
    with pytest.raises(ValueError):
        RU.leaves(spark, m)


@pytest.mark.parametrize("kind,label,params", [c for c in CASES if c[2].get("maxDepth")])
def test_importances_from_gains(spark, rows, kind, label, params):
    m = model(rows, kind, label, **params)
    got = {r["feature"]: r["importance"] for r in RU.importances(spark, m).collect()}
    assert [got[x] for x in XS] == pytest.approx(m.stages[-1].featureImportances.toArray().tolist(), abs=1e-9)


def test_cells_give_the_same_tree(spark, rows):
    few = RU.cells(rows, XS, "y")
    assert few.agg(F.sum("weight")).first()[0] == rows.count() > few.count()
    plain, weighted = (L.fit_pipeline(d, [M.assembler(XS, "features"), L.estimator("tree", "features", "y", maxDepth=5, maxBins=800, **w)])
                       for d, w in ((rows, {}), (few, {"weightCol": "weight"})))
    a, b = ({r["id"]: r["prediction"] for r in m.transform(rows).collect()} for m in (plain, weighted))
    assert all(a[i] == pytest.approx(b[i]) for i in a)


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [1, 3, 40, 100000])
def test_auc_is_exact_with_ties(spark, levels):
    rng = np.random.default_rng(levels)
    pairs = [(float(s), bool(rng.random() < 0.2 + 0.6 * s / levels)) for s in rng.integers(0, levels, 300)]
    df = spark.createDataFrame([(s, int(y)) for s, y in pairs] + [(None, 1), (1.0, None)], "s double, y int").repartition(5)
    got = EV.auc(df, "y", "s").first()
    assert got["auc"] == pytest.approx(brute_auc(pairs), abs=1e-12) and got["n_pos"] + got["n_neg"] == 300


def test_auc_without_both_classes(spark):
    one = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert tuple(EV.auc(one, "y", "s").first()) == (None, 2, 0)
    assert tuple(EV.auc(one.filter("false"), "y", "s").first()) == (None, 0, 0)


def test_noisy_report_errs(spark, sf):
    r = E.queries()["eval_report_noisy"](spark, sf).first()
    assert 0.5 < r["auc"] < 1 and 0.5 < r["accuracy"] < 1
