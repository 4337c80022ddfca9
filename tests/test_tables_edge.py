"""Feature and versioned tables: refused drops, full key reports, stored schemas."""
import pytest

from pyspark.sql import functions as F

from kiln.operators import feature_tables as FT
from kiln.operators import layout as Y
from kiln.session import scratch_path
from kiln.sources import fs
from kiln.sources import snapshots as V


def test_partition_and_clustering_columns_are_not_dropped(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "k int, p string, v double")
    root = scratch_path(spark, "t-part")
    FT.create(spark, root, ["k"], df, partitions=["p"])
    with pytest.raises(FT.KeyViolation, match="partition"):
        FT.drop_features(spark, root, ["p"])
    FT.drop_features(spark, root, ["v"])
    assert sorted(FT.read(spark, root).columns) == ["k", "p"] and sorted(FT.read(spark, root, version=0).columns) == ["k", "p", "v"]
    assert sorted((r.k, r.p) for r in FT.read(spark, root).collect()) == [(1, "a"), (2, "b")]


def test_all_offending_keys_are_reported(spark):
    df = spark.createDataFrame([(i // 2,) for i in range(60)] + [(None,), (99,)], "k int")
    got = {r.k: r["_n"] for r in FT.offending_keys(df, ["k"]).collect()}
    assert got == {**{i: 2 for i in range(30)}, None: 1}


def test_versions_keep_their_schema(spark):
    root = scratch_path(spark, "t-schema")
    V.write_version(spark.createDataFrame([(1, "x")], "a int, b string"), root)
    V.write_version(spark.createDataFrame([(2, 5.0)], "a int, c double"), root, mode="append")
    rows = sorted(tuple(r) for r in V.read_as_of(spark, root).collect())
    assert V.read_as_of(spark, root).columns == ["a", "b", "c"] and rows == [(1, "x", None), (2, None, 5.0)]
    assert V.read_as_of(spark, root, version=0).columns == ["a", "b"]
    seg = V.latest(spark, root).segments[0]
    assert fs.size_of(spark, seg)[0] == len(spark.read.parquet(seg).inputFiles())
    assert fs.size_of(spark, root + "/none") == (0, 0)


def segment_files(spark, root):
    return {s: sorted(spark.read.parquet(s).inputFiles()) for s in V.latest(spark, root).segments}


def test_merge_rewrites_only_touched_segments(spark):
    root = scratch_path(spark, "t-merge")
    FT.create(spark, root, ["k"], spark.createDataFrame([(i, "a", 1.0) for i in range(50)], "k int, s string, v double"))
    V.write_version(spark.createDataFrame([(i, "b", 2.0) for i in range(50, 90)], "k int, s string, v double"), root, mode="append")
    first, second = V.latest(spark, root).segments
    before = segment_files(spark, root)
    FT.merge(spark, root, spark.createDataFrame([(60, 9.0), (200, 8.0)], "k int, v double"))
    now = V.latest(spark, root)
    assert first in now.segments and second not in now.segments and now.n_rows == 91
    assert segment_files(spark, root)[first] == before[first]
    want = {i: ("a", 1.0) for i in range(50)} | {i: ("b", 2.0) for i in range(50, 90)} | {60: ("b", 9.0), 200: (None, 8.0)}
    assert {r.k: (r.s, r.v) for r in FT.read(spark, root).collect()} == want
    FT.merge(spark, root, spark.createDataFrame([(300, 7.0)], "k int, v double"))       # touches nothing stored
    assert set(now.segments) < set(V.latest(spark, root).segments) and FT.read(spark, root).count() == 92


def test_dropped_feature_does_not_come_back(spark):
    root = scratch_path(spark, "t-drop")
    FT.create(spark, root, ["k"], spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, v double"))
    kept = V.latest(spark, root).segments
    FT.drop_features(spark, root, ["v"])
    assert V.latest(spark, root).segments == kept and FT.read(spark, root).columns == ["k"]
    FT.merge(spark, root, spark.createDataFrame([(1, 9.0)], "k int, v double"))
    assert {r.k: r.v for r in FT.read(spark, root).collect()} == {1: 9.0, 2: None}
    assert {r.k: r.v for r in FT.read(spark, root, version=0).collect()} == {1: 5.0, 2: 6.0}


def test_compact_leaves_files_of_the_right_size(spark):
    root = scratch_path(spark, "t-compact")
    big = spark.range(200000).selectExpr("id", "xxhash64(id) AS h")
    V.write_version(big.coalesce(1), root)
    V.write_version(big.limit(1000).repartition(10), root, mode="append")
    first, second = V.latest(spark, root).segments
    Y.compact(spark, root, target_bytes=1 << 20)
    now = V.latest(spark, root)
    assert first in now.segments and second not in now.segments and now.n_rows == 201000
    assert len(segment_files(spark, root)[now.segments[-1]]) == 1
    assert V.read_as_of(spark, root).count() == 201000
    assert Y.compact(spark, root, target_bytes=1 << 20) == now.version          # nothing left to do


def test_compact_of_a_partitioned_table(spark):
    root = scratch_path(spark, "t-compact-part")
    df = spark.range(4000).selectExpr("id AS k", "CAST(id % 4 AS string) AS p", "xxhash64(id) AS h")
    FT.create(spark, root, ["k"], df.repartition(20), partitions=["p"])
    many = sum(map(len, segment_files(spark, root).values()))
    Y.compact(spark, root)
    assert many >= 40 and sum(map(len, segment_files(spark, root).values())) == 4
    assert FT.read(spark, root).select("k", "p", "h").exceptAll(df).count() == 0 and V.latest(spark, root).n_rows == 4000


def spans(spark, root, c):
    """Width of each file's range of a column, as a share of the whole."""
    v = V.read_as_of(spark, root).select(Y.sort_key(V.read_as_of(spark, root), c).alias("x"), "_metadata.file_path")
    lo, hi = v.agg({"x": "min"}).first()[0], v.agg({"x": "max"}).first()[0]
    return [(r["b"] - r["a"]) / (hi - lo) for r in v.groupBy("file_path").agg(F.min("x").alias("a"), F.max("x").alias("b")).collect()]


def test_zorder_narrows_files_in_every_column(spark, sf):
    li = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate", "o_clerk", "o_totalprice") \
        if "o_clerk" in spark.read.parquet(f"{sf}/orders.parquet").columns else spark.read.parquet(f"{sf}/orders.parquet")
    day = [c for c, t in li.dtypes if t in ("date", "timestamp", "timestamp_ntz")][0]
    root = scratch_path(spark, "t-z")
    V.write_version(li.repartition(16), root, prepared=True)
    size = V.latest(spark, root).n_bytes
    assert min(spans(spark, root, day)) > 0.9
    Y.zorder(spark, root, ["o_custkey", day], target_bytes=size // 16)
    for c in ("o_custkey", day):
        w = spans(spark, root, c)
        assert sum(w) / len(w) < 0.5
    assert V.read_as_of(spark, root).exceptAll(li).count() == 0


def test_text_sort_keys_keep_the_order(spark):
    words = ["", "a", "ab", "b", "ba", "zebra", "zed", "é", "日"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r.s for r in df.orderBy(Y.sort_key(df, "s"), "s").collect()]
    assert got == sorted(words, key=str.encode)


def test_appends_to_a_clustered_table_are_narrow(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    root = scratch_path(spark, "t-cluster")
    V.write_version(o.limit(0), root)
    Y.cluster_by(spark, root, ["o_custkey"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # else one file holds so few rows
    try:
        V.write_version(o.repartition(8), root, mode="append")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    w = spans(spark, root, "o_custkey")
    assert len(w) > 2 and max(w) < 0.6
