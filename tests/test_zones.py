"""Zone maps rule segments out before they are read; z-order of what is new."""
import random

import pytest
from pyspark.sql import functions as F

from kiln.operators import feature_tables as FT
from kiln.operators import layout as Y
from kiln.sources import snapshots as V
from kiln.sources import zones
from kiln.session import scratch_path


@pytest.fixture
def table(spark):
    root = scratch_path(spark, "zones")
    FT.create(spark, root, ["k"], df=spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    for i in range(1, 5):
        FT.merge(spark, root, spark.range(100 * i, 100 * i + 100).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    return root


@pytest.fixture
def read_paths(monkeypatch):
    """Segments whose data is opened."""
    seen, own = [], V.segments_of

    def spy(spark, row, segments):
        seen.append(list(segments))
        return own(spark, row, segments)
    monkeypatch.setattr(V, "segments_of", spy)
    return seen


def test_merge_reads_and_rewrites_only_segments_in_reach(spark, table, read_paths):
    before = V.latest(spark, table)
    assert len(before.segments) == 5 and before.sizes and sum(x[0] for x in before.sizes) == before.n_rows == 500
    assert all(len(s) <= 1 for s in read_paths)                # no merge of new keys opened an old segment's data
    read_paths.clear()
    FT.merge(spark, table, spark.createDataFrame([(150, "b"), (390, "b")], "k long, v string"))
    now = V.latest(spark, table)
    opened = {s for seen in read_paths for s in seen} - {now.segments[-1]}
    assert opened <= {before.segments[1], before.segments[3], *now.segments} and before.segments[0] not in {
        s for seen in read_paths[:1] for s in seen}
    assert [s for s in before.segments if s in now.segments] == [before.segments[i] for i in (0, 2, 4)]
    assert now.n_rows == 500 and FT.read(spark, table).filter("v = 'b'").count() == 2


def test_bounds_meet_but_no_key_is_there(spark, table):
    FT.merge(spark, table, spark.createDataFrame([(700, "x"), (900, "x")], "k long, v string"))
    row = V.latest(spark, table)
    assert FT.touched_segments(spark, table, row, spark.createDataFrame([(800,)], "k long"), ["k"]) == []
    assert zones.met(spark, table, row.segments, spark.createDataFrame([(800,)], "k long"), ["k"]) == [row.segments[-1]]
    assert zones.met(spark, table, row.segments, spark.createDataFrame([], "k long"), ["k"]) == []


@pytest.mark.parametrize("cuts", [512, 3])
def test_met_never_misses_a_segment(spark, monkeypatch, cuts):
    monkeypatch.setattr(zones, "CUTS", cuts)
    rnd, root = random.Random(5), scratch_path(spark, "zones")
    keys = [(f"{rnd.choice('abc')}{rnd.randrange(400):03d}", rnd.randrange(50)) for _ in range(300)]
    parts, seen = [], set()
    for i in range(0, 300, 40):
        parts.append([k for k in dict.fromkeys(keys[i:i + 40]) if k not in seen])
        seen |= set(parts[-1])
    FT.create(spark, root, ["s", "n"], df=spark.createDataFrame(parts[0], "s string, n int").withColumn("f", F.lit(1.0)))
    for p in parts[1:]:
        V.write_version(spark.createDataFrame(p, "s string, n int").withColumn("f", F.lit(1.0)), root, "APPEND", mode="append")
    row = V.latest(spark, root)
    for _ in range(6):
        want = rnd.sample(sorted(seen), 3) + [("zzz", 1)]
        asked = spark.createDataFrame(want, "s string, n int")
        near = zones.met(spark, root, row.segments, asked, ["s", "n"])
        held = {row.segments[i] for i, p in enumerate(parts) if set(p) & set(want)}
        assert held <= set(near)
        assert sorted((r.s, r.n) for r in FT.lookup(spark, root, asked).collect()) == sorted(set(want) & seen)
        assert set(FT.touched_segments(spark, root, row, asked, ["s", "n"])) == held


def test_lookup_reads_only_what_it_must(spark, table, read_paths):
    got = FT.lookup(spark, table, spark.createDataFrame([(5,), (405,)], "k long"))
    assert sorted(r.k for r in got.collect()) == [5, 405]
    assert len(read_paths) == 1 and len(read_paths[0]) == 2
    assert FT.lookup(spark, table, spark.createDataFrame([(-5,)], "k long")).count() == 0


def test_segments_without_zones_count_as_met(spark):
    root = scratch_path(spark, "zones")
    V.write_version(spark.range(10).withColumnRenamed("id", "k"), root)
    row = V.latest(spark, root)
    assert zones.met(spark, root, row.segments, spark.createDataFrame([(99,)], "k long"), ["k"]) == list(row.segments)


def points(spark, lo, n):
    return spark.range(lo, lo + n).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"), (F.xxhash64("id") % 97).alias("y"))


def test_second_zorder_leaves_old_segments(spark):
    root = scratch_path(spark, "z")
    V.write_version(points(spark, 0, 20000), root)
    Y.zorder(spark, root, ["x", "y"], bits=4, target_bytes=1 << 15)
    first = V.latest(spark, root)
    assert first.n_files > 2 and Y.zorder(spark, root, ["x", "y"], bits=4) == first.version          # nothing new
    V.write_version(points(spark, 20000, 500), root, mode="append")
    Y.zorder(spark, root, ["x", "y"], bits=4, target_bytes=1 << 15)
    now = V.latest(spark, root)
    assert now.segments[0] == first.segments[0] and len(now.segments) == 2 and now.n_rows == 20500
    assert V.read_as_of(spark, root).agg(F.sum("id")).first()[0] == sum(range(20500))
    assert V.read_meta(spark, root)["zorder"]["ranges"].keys() == {zones.name_of(s) for s in now.segments}
    Y.zorder(spark, root, ["x", "y"], bits=4, recut=True)
    assert len(V.latest(spark, root).segments) == 1


def test_small_overlapping_segments_are_merged(spark):
    root, written = scratch_path(spark, "z"), 0
    for i in range(9):
        V.write_version(points(spark, 1000 * i, 1000), root, mode="append")
        before = set(V.latest(spark, root).segments)
        Y.zorder(spark, root, ["x", "y"], bits=4)
        now = V.latest(spark, root)
        new = [n for s, n in zip(now.segments, now.sizes) if s not in before]
        written += sum(n[0] for n in new)
    assert len(now.segments) <= 4 and now.n_rows == 9000 and written < 9000 * 4.5
    assert V.read_as_of(spark, root).select("id").distinct().count() == 9000


def test_zorder_of_an_empty_table(spark):
    root = scratch_path(spark, "z")
    V.write_version(points(spark, 0, 0), root)
    Y.zorder(spark, root, ["x", "y"])
    assert V.read_as_of(spark, root).count() == 0


def test_zorder_tasks_read_bounded_splits(spark, monkeypatch):
    """A task of the rewrite holds a share of a file, however large the file is."""
    root, tasks, write, n, key = scratch_path(spark, "z"), [], V.write_version, 1_500_000, "spark.sql.files.minPartitionNum"
    noise = spark.range(n).select("id", *[F.xxhash64("id", F.lit(i)).alias(c) for i, c in enumerate("xyuv")])
    V.write_version(noise.coalesce(1), root, prepared=True)
    first = V.latest(spark, root)
    assert first.n_files == 1 and first.n_bytes > 3 << 24

    def written(out, *args, **kw):
        tasks.append(V.segments_of(spark, first, first.segments).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0])
        return write(out, *args, **kw)

    spark.conf.set(key, "1")
    try:
        monkeypatch.setattr(V, "write_version", written)
        Y.zorder(spark, root, ["x", "y"], bits=2)
        assert spark.conf.get(key) == "1"
    finally:
        spark.conf.unset(key)
    assert tasks[0] <= n / 2                                       # whole row groups, of about 16 MB together
    now = V.read_as_of(spark, root)
    assert now.count() == n and now.agg(F.sum("id")).first()[0] == n * (n - 1) // 2


def test_fine_splits_are_put_back(spark):
    key = "spark.sql.files.minPartitionNum"
    with pytest.raises(ZeroDivisionError), Y.fine_splits(spark, 1000 * Y.SPLIT_BYTES):
        assert spark.conf.get(key) == "1000"
        1 / 0
    assert spark.conf.get(key, None) is None
