"""Defects of the reference that must not come back."""
from pyspark.sql import functions as F

from kiln.ml import features as M
from kiln.ml import models as L
from kiln.operators import relational as R
from kiln.operators import timing as TM


def test_row_ids_stay_64_bit(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").repartition(3)
    assert dict(R.with_row_id(o, "ID").dtypes)["ID"] == "bigint"
    assert dict(R.with_row_id(o, "ID", order_by="o_orderkey").dtypes)["ID"] == "bigint"
    ids = R.with_row_id(o, "ID").select("ID")
    assert ids.distinct().count() == o.count()


def test_timing_runs_the_job(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    calls = []

    def q():
        calls.append(1)
        return li.groupBy("l_returnflag").count()
    t = TM.time_query(spark, q, runs=2, warmup=1)
    assert len(calls) == 3 and t["median_s"] > 0
    rows = TM.timed(spark, {"a": q, "b": q}, runs=1, warmup=0).collect()
    assert [r.name for r in rows] == ["a", "b"] and all(r.median_s > 0 for r in rows)


def test_importance_names_come_from_the_assembler(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("ID", F.monotonically_increasing_id())
    cols = ["l_discount", "l_quantity"]
    model = L.fit_pipeline(li, [M.assembler(cols, "features"),
                                L.estimator("forest", "features", "l_extendedprice", numTrees=5, seed=1)])
    names = [r.feature for r in L.importances(spark, model).collect()]
    assert names == cols


def test_relative_error_by_zero_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 1.05)], "p double, a double")
    got = [r.accuracy for r in R.with_within(df, "p", "a").orderBy("a").collect()]
    assert got == [None, True]


def test_scoring_keeps_rows_in_place(spark, sf):
    """Predictions stay on their own rows (no join back by position)."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    model = L.fit_pipeline(part, [M.assembler(["p_partkey"], "features"),
                                  L.estimator("linear", "features", "p_retailprice")])
    scored = L.score(model, part.repartition(4))
    assert scored.select("p_partkey").distinct().count() == part.count()


def test_random_split_option_and_corr_matrix(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    a, b = R.split(o, None, 0.8, 1, method="random")
    assert a.count() + b.count() == o.count()
    m = {(r.a, r.b): r.r for r in R.corr_matrix(o, ["o_totalprice", "o_custkey"], "spearman").collect()}
    assert abs(m[("o_totalprice", "o_totalprice")] - 1.0) < 1e-12
    assert abs(m[("o_totalprice", "o_custkey")] - m[("o_custkey", "o_totalprice")]) < 1e-12
    p = {(r.a, r.b): r.r for r in R.corr_matrix(o, ["o_totalprice", "o_custkey"]).collect()}
    one = R.corr_pairs(o, ["o_totalprice", "o_custkey"]).first().r
    assert abs(p[("o_totalprice", "o_custkey")] - one) < 1e-9


def test_training_set_as_of(spark):
    import datetime as dt

    from kiln.operators import feature_tables as FT
    feats = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1.0), (1, dt.datetime(2024, 1, 3), 3.0)],
                                  "k int, ts timestamp, f double")
    labels = spark.createDataFrame([(1, dt.datetime(2024, 1, 2), 0), (1, dt.datetime(2024, 1, 4), 1)],
                                   "k int, ts timestamp, y int")
    got = sorted((r.y, r.f) for r in FT.training_set(feats, labels, ["k"], ts="ts").collect())
    assert got == [(0, 1.0), (1, 3.0)]
