"""Boosted trees on cells of bins against Spark's own fit of the rows."""
import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from kiln.ml import features as M
from kiln.ml import models as L

XS = ["a", "b", "c"]


@pytest.fixture
def fitted_rows(monkeypatch):
    """Rows that Spark's own boosting was given, a number per fit."""
    seen, fit = [], GBTRegressor._fit

    def counted(self, df):
        seen.append(df.count())
        return fit(self, df)
    monkeypatch.setattr(GBTRegressor, "_fit", counted)
    return seen


def rows(spark, n=3000):
    """A feature with zeros and negative values, one of steps, a constant one."""
    i = F.col("id")
    noise = ((i * 7919) % 1009) / 100.0
    return (spark.range(n, numPartitions=3)
            .select(i, ((i * 31) % 9 - 4).cast("double").alias("a"), (((i * 17) % 100) / 3.0).alias("b"), F.lit(7.0).alias("c"), noise.alias("_e"))
            .withColumn("y", F.col("a") * F.col("a") + F.when(F.col("b") > 20, 12.0).otherwise(F.col("b")) + F.col("_e")).drop("_e"))


def pair(df, xs=XS, **params):
    """(own, Spark's) model of the same rows and parameters."""
    own = L.fit_pipeline(df, [M.assembler(xs, "features"), L.estimator("gbt", "features", "y", **params)])
    plain = GBTRegressor(featuresCol="features", labelCol="y", **params)
    return own, L.fit_pipeline(df, [M.assembler(xs, "features"), plain])


def assert_same(spark, own, plain, df):
    both = L.score(own, df).withColumnRenamed("prediction", "p").drop("features")
    got = L.score(plain, both).select("p", "prediction").toPandas()
    assert np.allclose(got.p, got.prediction, rtol=1e-9, atol=1e-9)
    rules = [sorted((r.tree, r.leaf, r.step, r.weight, r.feature, r.op, r.threshold) for r in L.tree_rules(spark, m).collect()) for m in (own, plain)]
    assert rules[0] == rules[1]
    importance = [[r.importance for r in L.importances(spark, m).collect()] for m in (own, plain)]
    assert importance[0] == pytest.approx(importance[1], rel=1e-6, abs=1e-9)


def test_boosting_fits_cells_with_the_same_trees(spark, fitted_rows):
    df = rows(spark)
    params = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.1, "seed": 42}
    own, plain = pair(df, **params)
    assert len(fitted_rows) == 2 and fitted_rows[0] <= 9 * 32 < fitted_rows[1] == 3000
    assert_same(spark, own, plain, df)
    model = own.stages[-1]
    assert model.getMaxBins() == 32 and not model.isDefined(model.weightCol) and model.getLabelCol() == "y"
    assert len(model.trees) == 4 and model.numFeatures == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sampled_thresholds_and_bins_without_rows(spark, fitted_rows, seed):
    """Above 10,000 rows Spark samples them for its thresholds, and takes rows
    missing from the sample for zeros: a bin that no row is in."""
    df = rows(spark, 12000).withColumn("a", F.col("a") + 9).withColumn("b", F.col("b") + 5)
    own, plain = pair(df, XS[:2], maxIter=3, maxDepth=4, seed=seed)
    assert fitted_rows[0] < 400
    other = spark.range(400).select("id", (F.col("id") / 20.0).alias("a"), (F.col("id") / 8.0 - 3).alias("b"))
    assert_same(spark, own, plain, other)


def test_more_cells_than_spark_samples_are_all_cut(spark, fitted_rows):
    """A bin with a single row is a cell among more than 10,000 of them."""
    i = F.col("id")
    df = (spark.range(46000, numPartitions=3)
          .select(i, (i % 32).cast("double").alias("a"), (F.floor(i / 32) % 32).cast("double").alias("b"),
                  F.when(i == 45000, 99.0).otherwise(F.floor(i / 1024) % 30).alias("c"))
          .withColumn("y", F.col("a") + F.col("b") * 2 + F.when(F.col("c") == 3, 500.0).otherwise(F.col("c"))))
    own, plain = pair(df, maxIter=2, maxDepth=3, seed=5)
    assert 10000 < fitted_rows[0] < 46000
    assert_same(spark, own, plain, df)


@pytest.mark.parametrize("params", [{"lossType": "absolute"}, {"subsamplingRate": 0.5}, {"minInstancesPerNode": 40}, {"weightCol": "id"},
                                    {"featureSubsetStrategy": "onethird"}])
def test_fits_that_need_the_rows_get_them(spark, fitted_rows, params):
    df = rows(spark)
    own, plain = pair(df, XS[:2], maxIter=2, maxDepth=2, seed=3, **params)
    assert fitted_rows == [3000, 3000]
    assert_same(spark, own, plain, df)


def test_few_rows_are_fitted_as_they_are(spark, fitted_rows):
    own, plain = pair(rows(spark, 100), XS[:2], maxIter=2, maxDepth=2, seed=3)
    assert fitted_rows == [100, 100]


@pytest.mark.parametrize("column, bad, said", [("a", None, "null"), ("b", float("nan"), "NaN"), ("y", None, "Labels MUST NOT"),
                                               ("y", float("nan"), "Labels MUST NOT"), ("a", float("inf"), "Vector values MUST NOT")])
def test_values_without_order_still_fail(spark, column, bad, said):
    df = rows(spark).withColumn(column, F.when(F.col("id") == 1234, F.lit(bad).cast("double")).otherwise(F.col(column)))
    with pytest.raises(Exception) as e:      # noqa: PT011, B017 - Spark's, by way of the task
        L.fit_pipeline(df, [M.assembler(XS, "features"), L.estimator("gbt", "features", "y", maxIter=2, maxDepth=2, seed=1)])
    assert said.lower() in str(e.value).lower()
