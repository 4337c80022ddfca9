"""Search, space sampling and tracking tables."""
import pytest
from pyspark.sql import functions as F

from kiln.ml import search as H
from kiln.session import scratch_path
from kiln.tracking import store as K


def test_param_grid_is_full_product(spark):
    g = H.param_grid(spark, numTrees=[10, 20, 30], maxDepth=[3, 5, 7])
    assert g.count() == 9
    assert g.select("numTrees", "maxDepth").distinct().count() == 9
    assert dict(g.dtypes)["numTrees"] == "int"


def test_sample_space_in_bounds_and_seed_stable(spark):
    space = {"model": {"linear": {"regParam": ("float", 0.0, 1.0)},
                       "tree": {"maxDepth": ("int", 2, 8), "minInstancesPerNode": ("logint", 1, 100)}}}
    a = H.sample_space(spark, space, 50, seed=7)
    b = H.sample_space(spark, space, 50, seed=7)
    assert sorted(a.collect()) == sorted(b.collect())
    rows = a.collect()
    for r in rows:
        if r.model == "linear":
            assert 0 <= r.regParam < 1 and r.maxDepth is None
        else:
            assert 2 <= r.maxDepth <= 8 and 1 <= r.minInstancesPerNode <= 100 and r.regParam is None
    assert {r.model for r in rows} == {"linear", "tree"}


def test_adaptive_search_finds_minimum():
    f = lambda p: (p["x"] - 0.3) ** 2 + (p["y"] - 0.7) ** 2
    hist = H.adaptive_search(f, {"x": ("float", 0, 1), "y": ("float", 0, 1)}, n=40, startup=5, batch=4, seed=1)
    assert len(hist) == 40
    assert min(m for _, m in hist) < 0.01


def test_adaptive_search_failure_is_inf():
    def f(p):
        if p["x"] > 0.4:
            raise RuntimeError("boom")
        return p["x"]
    hist = H.adaptive_search(f, {"x": ("float", 0, 1)}, n=8, startup=4, batch=2)
    assert all((m == float("inf")) == (p["x"] > 0.4) for p, m in hist)


def test_register_resolve_and_alias_move(spark):
    st = K.Store(spark, scratch_path(spark, "t-store"))
    assert K.resolve(st, "m", "champion") is None
    assert K.register(st, "m", "/p1", "r1", alias="champion") == 1
    assert K.register(st, "m", "/p2", "r2") == 2
    assert K.resolve(st, "m", "champion") == "/p1"
    K.set_alias(st, "m", "champion", 2)
    assert K.resolve(st, "m", "champion") == "/p2"
    assert K.resolve_or_register(st, "n", "champion", lambda: ("/q", "r3")) == "/q"


def test_signature_check(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    sig = K.signature(part, ["p_partkey", "p_retailprice"])
    K.check_signature(part, sig)
    with pytest.raises(K.SignatureError):
        K.check_signature(part.withColumn("p_partkey", F.col("p_partkey").cast("string")), sig)
    with pytest.raises(K.SignatureError):
        K.check_signature(part.drop("p_retailprice"), sig)


def test_input_digest_ignores_order(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    a = K.input_digest(o).first()
    b = K.input_digest(o.orderBy(F.desc("o_orderkey")).repartition(3)).first()
    assert a == b


def test_tvs_library_and_key_split_paths(spark, sf):
    from kiln.ml import features as M
    from kiln.ml import models as L
    part = spark.read.parquet(f"{sf}/part.parquet")

    def stages():
        lr = L.estimator("linear", "features", "p_retailprice")
        return [M.assembler(["p_partkey"], "features"), lr], lr
    s1, lr1 = stages()
    lib = H.tvs_search(part, s1, lr1, {"regParam": [0.0, 1.0]}, "p_retailprice", seed=3)
    s2, lr2 = stages()
    keyed = H.tvs_search(part, s2, lr2, {"regParam": [0.0, 1.0]}, "p_retailprice", seed=3, key="p_partkey")
    assert lib.trials.count() == keyed.trials.count() == 2
    again = H.tvs_search(part.repartition(5), *stages(), {"regParam": [0.0, 1.0]}, "p_retailprice", seed=3,
                         key="p_partkey")
    a, b = sorted(keyed.trials.collect()), sorted(again.trials.collect())
    assert [(r.trial, r.regParam) for r in a] == [(r.trial, r.regParam) for r in b]
    assert all(abs(x.rmse - y.rmse) <= 1e-9 + 1e-9 * abs(y.rmse) for x, y in zip(a, b))
    assert keyed.best_model.transform(part).count() == part.count()


def test_concurrent_appends_all_land(spark):
    from concurrent.futures import ThreadPoolExecutor
    st = K.Store(spark, scratch_path(spark, "t-par"))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: K.log_run(st, f"r{i}", {"a": i}, {"m": i}), range(8)))
    assert st.table("runs").count() == st.table("params").count() == st.table("metrics").count() == 8


def test_digest_sees_repeated_rows(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (1,), (1,), (2,)], "x int")
    assert K.input_digest(a).first() != K.input_digest(b).first()
    assert K.input_digest(a).first() == K.input_digest(a.repartition(3)).first()
