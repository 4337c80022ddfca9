"""Dictionaries, ranks, exact quantiles that the sketch misses, null split keys,
owned scratch tables, unreadable targets and child runs."""
import collections
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kiln import session
from kiln.operators import ranks as RK
from kiln.operators import relational as R
from kiln.plans import search_q
from kiln.sources import tables as S
from kiln.tracking import store as K


def test_index_of_many_values(spark):
    rng = np.random.default_rng(2)
    vals = ["hot"] * 4000 + [f"v{i}" for i in rng.integers(0, 3000, 5000)] + [None] * 500 + ["", " "]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vals)], "id long, v string, w string").repartition(6)
    counts = collections.Counter(v for v in vals if v is not None)
    want = {v: float(i) for i, (v, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))}
    got = RK.index_values(df.drop("w"), "v", "idx")
    assert got.columns == ["id", "v", "idx"]
    rows = got.collect()
    assert len(rows) == len(vals) and all(r["idx"] == want.get(r["v"]) for r in rows)
    assert want["hot"] == 0.0 and RK.index_values(df.filter("false"), "v", "idx").count() == 0


def test_hot_values_are_broadcast_within_their_bound(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("v"))
    d = RK.dictionary(df, "v", "i")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert d.filter(F.col("n") * RK.HOT * n > 1000).count() <= RK.HOT * n
    assert d.agg(F.max("i"), F.count_distinct("i")).first()[:] == (100, 101)


def test_rank_corr_is_spearman(spark):
    rng = np.random.default_rng(8)
    p = pd.DataFrame({"a": rng.integers(0, 9, 700).astype(float), "b": rng.normal(size=700), "c": [1.0] * 350 + [2.0] * 350})
    p["b"] += p.a
    rows = [tuple(map(float, r)) for r in p.itertuples(index=False)] + [(None, 1.0, 1.0), (5.0, None, 2.0)]
    got = RK.rank_corr(spark.createDataFrame(rows, "a double, b double, c double").repartition(4), ["a", "b", "c"])
    want = p.rank().corr()                                       # Pearson of average ranks
    assert {(r["a"], r["b"]): r["r"] for r in got.collect()} == {
        (x, y): pytest.approx(want.loc[x, y], abs=1e-12) for x, y in (("a", "b"), ("a", "c"), ("b", "c"))}


@pytest.mark.parametrize("accuracy,values", [(2, 10 ** 6), (2, 5), (10000, 5), (50, 1)])
@pytest.mark.parametrize("q", [0.0, 0.31, 0.5, 1.0])
def test_quantiles_when_the_sketch_misses(spark, accuracy, values, q):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.lognormal(size=3000), np.full(700, 0.25), -np.arange(500.0)])
    df = spark.createDataFrame([(float(x), None if i % 9 else float(i)) for i, x in enumerate(v)], "v double, w double").repartition(5)
    got = {r["column"]: r["value"] for r in R.exact_quantiles(df, ["v", "w"], q, accuracy, values).collect()}
    assert got["v"] == pytest.approx(np.quantile(v, q)) and got["w"] == pytest.approx(np.quantile(np.arange(0, len(v), 9), q))


@pytest.mark.parametrize("kind", ["long", "int", "string", "date", "double"])
def test_null_keys_have_a_part_and_a_fold(spark, kind):
    base = F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")) if kind == "date" else F.col("id").cast(kind)
    df = spark.range(200).withColumn("k", F.when(F.col("id") % 3 != 0, base))
    a, b = R.split(df, "k", 0.8, 42)
    assert a.count() + b.count() == 200 and a.unionByName(b).select("id").distinct().count() == 200
    assert R.with_fold(df, "k", 3, 42).filter("fold is null or fold not between 0 and 2").count() == 0
    assert R.with_split(df, "k").filter("is_train is null").count() == 0
    assert R.with_fold(df, "k", 3, 42).filter("k is null").select("fold").distinct().count() == 1


def test_scratch_scope_removes_what_was_made_in_it(spark):
    folder = session.checkpoint_root(spark).removeprefix("file:") + "/kiln-scratch"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with session.scratch_scope(spark):
        rows = R.with_row_id(spark.range(50).withColumnRenamed("id", "k"), "n", order_by="k").collect()
        assert len(rows) == 50 and set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) - before == set()


def test_overwrite_of_an_unreadable_target_is_refused(spark, tmp_path):
    target = tmp_path / "t"
    target.mkdir()
    (target / "part-0.parquet").write_bytes(b"no parquet file")
    with pytest.raises(Exception):
        S.sink(spark.range(3), f"file:{target}", mode="overwrite")
    assert (target / "part-0.parquet").exists()
    S.sink(spark.range(3), f"file:{target}", mode="overwrite", replace_schema=True)
    assert spark.read.parquet(str(target)).count() == 3


def test_child_runs_take_two_appends(spark, tmp_path, monkeypatch):
    st, calls = K.Store(spark, f"file:{tmp_path}/k"), []
    own = K.Store.append_df
    monkeypatch.setattr(K.Store, "append_df", lambda self, name, df: (calls.append(name), own(self, name, df)))
    session.checkpoint_root(spark)
    K.log_run(st, "p")
    K.log_children(st, "p", spark.range(40).select(F.concat(F.lit("c"), "id").alias("run_id"), F.col("id").alias("m"), F.lit("x").alias("t")))
    assert calls == ["runs", "metrics"]
    assert tuple(K.run_tree(st).first()) == ("p", "m", 40, 19.5, 0.0, 39.0)
    with pytest.raises(ValueError):
        K.log_children(st, "p", spark.range(1).select(F.lit("r").alias("run_id")))


def test_forest_grid_is_searched_at_full_size(spark, sf):
    out = E.queries()["forest_cv"](spark, sf).toPandas()
    assert len(out) == 9 and set(out.numTrees) == {5, 10, 20} and set(out.maxDepth) == {2, 5, 10}
    train, _ = search_q.part_folds(spark, sf)
    from kiln.ml import evaluation as EV
    from kiln.ml import models as L
    got = []
    for k in range(3):
        m = L.fit_pipeline(train.filter(F.col("fold") != k), search_q._tree_stages("forest", seed=42, numTrees=5, maxDepth=2))
        got.append(EV.eval_regression(m.transform(train.filter(F.col("fold") == k)), "p_retailprice").first()["rmse"])
    assert out[(out.numTrees == 5) & (out.maxDepth == 2)].avg_rmse.iloc[0] == pytest.approx(np.mean(got), rel=0.05)
