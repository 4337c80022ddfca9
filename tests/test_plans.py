"""Plan shape: pushdown, pruning, no Python where an expression does, and
no single-task step over the data."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from kiln.operators import relational as R


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_and_columns_pruned(spark, sf):
    p = plan(E.queries()["filter_gt"](spark, sf))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,30.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in p


def test_replicate_single_scan_no_join(spark, sf):
    p = plan(E.queries()["replicate_n"](spark, sf))
    assert p.count("FileScan parquet") == 1
    assert "Join" not in p and "Union" not in p


def test_flagship_scoring_has_no_python(spark, sf):
    p = plan(E.queries()["linreg_fit"](spark, sf))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_asof_left_side_is_read_once_and_joined_by_cut(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.queries()["join_asof"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(user_id" in p and "Window" not in p
    # the only single-partition exchange is over the cuts, a row per ASOF_ROWS right rows; the left side is scanned once
    assert p.count("SinglePartition") == 1 and p.count("INTERVAL '30' MINUTE") == 1


def test_row_id_window_is_partitioned(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    p = plan(R.with_row_id(o, "rid", "o_orderkey"))
    # the only single-partition exchange is over the per-range totals
    assert p.count("SinglePartition") == 1 and "hashpartitioning(_p" in p
    many = plan(R.with_row_id(o, "rid", "o_orderkey", partitions=500))
    assert len(many) < 1.2 * len(p)  # no expression grows with the ranges


def test_group_fit_uses_aggregates_not_python(spark, sf):
    from kiln.ml import linear as LIN
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    p = plan(LIN.ols(li, ["l_quantity", "l_discount"], "l_extendedprice", ["l_suppkey"]))
    assert "FlatMapGroupsInPandas" not in p and "partial_covar_pop" in p
    p = plan(E.queries()["group_fit"](spark, sf))
    assert "FlatMapGroupsInPandas" not in p and "ArrowEvalPython" not in p


def test_group_count_partial_aggregation(spark, sf):
    p = plan(E.queries()["group_count"](spark, sf))
    assert "partial_count" in p


def test_best_row_per_group_limits_before_shuffle(spark, sf):
    p = plan(E.queries()["best_trial"](spark, sf))
    assert "WindowGroupLimit" in p


def test_rolling_rows_spread_by_range(spark, sf):
    p = plan(E.queries()["rolling_mean_rows"](spark, sf))
    assert "hashpartitioning(user_id" in p and "_p" in p and "SinglePartition" not in p
