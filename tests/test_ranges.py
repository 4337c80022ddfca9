"""Nulls, ties, text and time keys and hot keys: results must not depend on
the number of ranges."""
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kiln.functions.exprs import split_bucket
from kiln.operators import relational as R
from kiln.operators.ranges import ranged


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_row_id_keeps_null_keys(spark, parts):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "k int")
    assert sorted((r.rid, r.k) for r in R.with_row_id(df, "rid", "k", parts).collect()) == [(1, None), (2, 1), (3, 2), (4, 3)]


@pytest.mark.parametrize("parts", [1, 7])
def test_row_id_on_text_and_time_keys(spark, parts):
    rows = [(f"k{i:03d}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(50)]
    df = spark.createDataFrame(rows[::-1], "s string, t timestamp")
    for key in ("s", "t"):
        got = {r[key]: r.rid for r in R.with_row_id(df, "rid", key, parts).collect()}
        assert got == {r[0 if key == "s" else 1]: i + 1 for i, r in enumerate(rows)}


def test_row_id_of_many_ranges(spark):
    df = spark.range(3000).withColumn("k", F.col("id") * 7 % 3001)
    got = sorted((r.k, r.rid) for r in R.with_row_id(df, "rid", "k", 2000).collect())
    assert [i for _, i in got] == list(range(1, 3001))


def brute_rolling(rows, n):
    by = {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2])):
        by.setdefault(k, []).append((t, i, v))
    out = {}
    for k, rs in by.items():
        for j, (_, i, _) in enumerate(rs):
            w = [v for _, _, v in rs[max(0, j - n + 1):j + 1] if v is not None]
            out[i] = round(sum(w) / n, 9) if len(w) == n else None
    return out


@pytest.mark.parametrize("n", [1, 2, 5])
@pytest.mark.parametrize("parts", [1, 4, 30])
def test_rolling_mean_keeps_every_row(spark, n, parts):
    rows = [(None if i % 11 == 0 else (7 if i % 3 else i % 5), None if i % 13 == 0 else i % 17, i, None if i % 19 == 0 else float(i))
            for i in range(120)]
    df = spark.createDataFrame(rows, "k int, t int, i int, v double").repartition(3)
    got = {r.i: None if r.m is None else round(r.m, 9) for r in
           R.rolling_mean(df, ["k"], ["t", "i"], "v", n, out="m", spread=True, parts=parts).collect()}
    want = brute_rolling(rows, n)
    assert got == want
    plain = {r.i: None if r.m is None else round(r.m, 9) for r in R.rolling_mean(df, ["k"], ["t", "i"], "v", n, out="m").collect()}
    assert plain == want


@pytest.mark.parametrize("parts", [1, 4, 30])
def test_asof_ignores_null_keys_and_times(spark, parts):
    left = [(None, 5, 0), (1, 5, 1), (1, None, 2), (2, 1, 3), (1, 9, 4), (1, 2, 5)] + [(1, 20 + i, 10 + i) for i in range(40)]
    right = [(None, 1, 1.0), (1, None, 7.0), (1, 3, None), (1, 8, 8.0), (2, None, 9.0)] + [(1, 15 + 2 * i, float(i)) for i in range(20)]
    a = spark.createDataFrame(left, "k int, t int, i int")
    b = spark.createDataFrame(right, "k int, t int, v double")
    got = {r.i: (r.t_matched, r.v) for r in R.join_asof(a, b, ["k"], "t", cols=["v"], parts=parts).collect()}
    want = {}
    for k, t, i in left:
        hits = [(rt, v) for rk, rt, v in right if None not in (k, t, rk, rt) and rk == k and rt <= t]
        want[i] = max(hits, key=lambda h: h[0]) if hits else (None, None)
    assert got == want


def test_one_key_in_one_day_is_spread(spark):
    df = spark.range(9000).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    sizes = [r["count"] for r in ranged(df, ["k", "t"], 8).groupBy("k", "_p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 0.3 * 9000


def test_shuffle_splits_a_hot_key(spark):
    df = spark.range(6000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    out = R.shuffle_rows(df, "k")
    runs = out.withColumn("p", F.spark_partition_id()).groupBy("p", "k").count().collect()
    hot = [r["count"] for r in runs if r["k"] == 0]
    assert max(hot) < 2 * sum(hot) / len(hot)
    assert [r.id for r in out.collect()] == [r.id for r in R.shuffle_rows(df.repartition(5), "k").collect()]


def test_split_of_very_large_keys(spark):
    keys = [0, 1, 10007, 2 ** 61, -2 ** 61, 2 ** 63 - 1, -2 ** 63]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.b for r in df.select("k", split_bucket("k").alias("b")).collect()}
    assert got == {k: (k * 7919 + 42) % 10007 for k in keys}


def test_quantile_narrows_until_it_fits(spark):
    import numpy as np
    xs = [float((i * 7919) % 4001) / 3 for i in range(4001)] + [5.0] * 900
    df = spark.createDataFrame([(x, None if i % 2 else x * 2) for i, x in enumerate(xs)], "a double, b double")
    got = {r["column"]: r.value for r in R.exact_quantiles(df, ["a", "b"], 0.37, accuracy=50, values=10).collect()}
    assert got["a"] == pytest.approx(np.quantile(xs, 0.37))
    assert got["b"] == pytest.approx(np.quantile([2 * x for i, x in enumerate(xs) if i % 2 == 0], 0.37))
    none = spark.createDataFrame([(None,)], "a double")
    assert Counter(R.exact_quantiles(none, ["a"]).collect()) == Counter()


@pytest.mark.parametrize("fan", [2, 5])
def test_asof_left_rows_carry_one_block_of_cuts(spark, monkeypatch, fan):
    """However many cuts there are, a left row is joined with ``ASOF_FAN`` of them at a time."""
    monkeypatch.setattr(R, "ASOF_ROWS", 1)
    monkeypatch.setattr(R, "ASOF_FAN", fan)
    sizes, own = [], R.F.broadcast
    monkeypatch.setattr(R.F, "broadcast", lambda df: (sizes.append(df), own(df))[1])
    right = spark.range(60).selectExpr("id % 2 AS k", "2 * id AS t", "id AS v")
    left = spark.range(130).selectExpr("id % 3 AS k", "id - 5 AS t", "id AS i")
    got = {r.i: r.v for r in R.join_asof(left, right, "k", "t", parts=4).collect()}
    want = {i: max((v for v in range(60) if v % 2 == i % 3 and 2 * v <= i - 5), default=None) for i in range(130)}
    assert got == want
    blocks = [max(len(r["_cuts"]) for r in df.collect()) for df in sizes]
    assert len(blocks) > 1 and max(blocks) <= fan


@pytest.mark.parametrize("rows,cuts", [(1, 10 ** 6), (3, 10 ** 6), (1024, 10 ** 6), (1024, 5)])
def test_asof_cuts_of_any_size(spark, monkeypatch, rows, cuts):
    """Hot keys, equal times, features that are maps, other key types on each
    side; the left side is never written."""
    import random

    from pyspark.sql import functions as F

    from kiln.operators import ranges
    monkeypatch.setattr(R, "ASOF_ROWS", rows)
    monkeypatch.setattr(R, "ASOF_CUTS", cuts)
    rnd = random.Random(rows)
    feats = [(rnd.choice([1, 1, 1, 2, 3]), rnd.randrange(60), rnd.randrange(1000)) for _ in range(200)] + [(None, 3, 1), (2, None, 1)]
    asks = [(i, rnd.choice([1, 1, 2, 3, 4, None]), rnd.choice([rnd.randrange(-5, 70), None])) for i in range(150)]
    right = spark.createDataFrame(feats, "k int, t long, v int").repartition(3)
    left = spark.createDataFrame(asks, "i int, k long, t int").repartition(3)
    written, own = [], ranges.ranged
    monkeypatch.setattr(R, "ranged", lambda df, *a, **b: (written.append(df.columns), own(df, *a, **b))[1])

    def want(k, t):
        hit = [(ft, v) for fk, ft, v in feats if None not in (k, t, ft) and fk == k and ft <= t]
        return max(hit) if hit else (None, None)

    got = {r.i: (r.t_matched, r.v) for r in R.join_asof(left, right, "k", "t", parts=4).collect()}
    assert got == {i: want(k, t) for i, k, t in asks}
    assert len(written) == 1 and "_l" not in written[0]
    maps = right.select("k", "t", F.create_map(F.lit("v"), "v").alias("m"))
    got = {r.i: r.t_matched if r.m is None else (r.t_matched, set(r.m)) for r in R.join_asof(left, maps, "k", "t").collect()}
    assert got == {i: (want(k, t)[0], {"v"}) if want(k, t)[0] is not None else None for i, k, t in asks}
