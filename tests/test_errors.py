"""Refusals and error paths."""
import pytest
from pyspark.sql import functions as F

from kiln.operators import feature_tables as FT
from kiln.operators import layout as Y
from kiln.session import scratch_path
from kiln.sources import snapshots as V
from kiln.sources import tables as S


def test_overwrite_refuses_schema_change(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    path = scratch_path(spark, "t-sink")
    S.sink(p, path, "overwrite")
    with pytest.raises(S.SchemaChangeError):
        S.sink(p.withColumn("x", F.lit(1)), path, "overwrite")
    S.sink(p.withColumn("x", F.lit(1)), path, "overwrite", replace_schema=True)
    assert "x" in spark.read.parquet(path).columns


def test_error_mode(spark, sf):
    n = spark.read.parquet(f"{sf}/nation.parquet")
    path = scratch_path(spark, "t-err")
    S.sink(n, path)
    with pytest.raises(Exception):
        S.sink(n, path, "errorifexists")


def test_key_violations(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet")
    with pytest.raises(FT.KeyViolation, match="not unique"):
        FT.create(spark, scratch_path(spark, "t-ft"), ["c_custkey"], df=c.union(c.limit(3)))
    with pytest.raises(FT.KeyViolation, match="null"):
        FT.create(spark, scratch_path(spark, "t-ft"), ["k"],
                  df=c.withColumn("k", F.when(F.col("c_custkey") > 5, F.col("c_custkey"))))
    root = scratch_path(spark, "t-ft")
    FT.create(spark, root, ["c_custkey"], df=c)
    with pytest.raises(FT.KeyViolation):
        FT.drop_features(spark, root, ["c_custkey"])
    with pytest.raises(FileExistsError):
        FT.create(spark, root, ["c_custkey"], df=c)


def test_zorder_refused_on_clustered(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    root = scratch_path(spark, "t-cl")
    V.write_version(o, root)
    Y.cluster_by(spark, root, ["o_custkey"])
    with pytest.raises(Y.LayoutError):
        Y.zorder(spark, root, ["o_totalprice"])


def test_scan_by_name_and_schema(spark, sf):
    from kiln.sources.tables import scan_table, sink, use_schema
    use_schema(spark, "kiln_test_db")
    n = spark.read.parquet(f"{sf}/nation.parquet")
    sink(n, "nations_named", "overwrite")
    assert sorted(scan_table(spark, "kiln_test_db.nations_named").collect()) == sorted(n.collect())
    spark.catalog.setCurrentDatabase("default")
