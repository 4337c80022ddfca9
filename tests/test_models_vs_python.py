"""Operators against plain-Python models of their semantics, on random data."""
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kiln.operators import feature_tables as FT
from kiln.operators import relational as R

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.lists(st.integers(0, 30), unique=True, max_size=12)
vals = st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))


@SETTINGS
@given(keys, keys, st.data())
def test_merge_matches_python_upsert(spark, cur_keys, in_keys, data):
    cur = [(k, data.draw(vals), f"s{k}") for k in cur_keys]
    inc = [(k, data.draw(vals), data.draw(vals)) for k in in_keys]
    cdf = spark.createDataFrame(cur, "k int, x double, s string")
    idf = spark.createDataFrame(inc, "k int, x double, z double")
    got = {r.k: (r.x, r.s, r.z) for r in FT.merge_frames(cdf, idf, ["k"]).collect()}
    want = {k: (x, s, None) for k, x, s in cur}
    for k, x, z in inc:
        old = want.get(k, (None, None, None))
        want[k] = (x, old[1], z)  # incoming x overwrites (even null), s kept, z new
    assert got == want


@SETTINGS
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.floats(0, 1), st.integers(1, 6))
def test_exact_quantile_matches_numpy(spark, xs, q, parts):
    # few distinct values: heavy ties, the hot-value case
    df = spark.createDataFrame([(float(v),) for v in xs], "v double")
    got = R.exact_quantiles(df, ["v"], q, accuracy=100, values=parts).first().value
    assert abs(got - float(np.quantile(np.array(xs, float), q))) < 1e-9


@SETTINGS
@given(st.lists(st.integers(-10**6, 10**6), unique=True, min_size=1, max_size=80), st.integers(1, 9),
       st.integers(1, 7))
def test_row_id_dense_for_any_partitioning(spark, ks, parts, shuffle_parts):
    df = spark.createDataFrame([(k,) for k in ks], "k long").repartition(shuffle_parts)
    got = sorted((r.k, r.rid) for r in R.with_row_id(df, "rid", order_by="k", partitions=parts).collect())
    assert [rid for _, rid in got] == list(range(1, len(ks) + 1))
    assert [k for k, _ in got] == sorted(ks)
