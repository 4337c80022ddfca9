"""Queries for rows, joins, aggregates, windows, ordering, sets and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import ranks as RK
from kiln.operators import relational as R
from kiln.plans.registry import query, rnd, table
from kiln.sources import tables as S

LI4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# ---------------------------------------------------------------- sources


@query("scan_path", "SELECT * FROM lineitem")
def scan_path(spark, sf):
    return S.scan_path(spark, f"{sf}/lineitem.parquet")


@query("scan_table", "SELECT * FROM orders")
def scan_table(spark, sf):
    S.register_views(spark, sf, ["orders"])
    return S.scan_table(spark, "orders")


@query("scan_sql", "SELECT * FROM customer")
def scan_sql(spark, sf):
    return S.scan_sql(spark, "SELECT * FROM customer", {"customer": table(spark, sf, "customer")})


# ---------------------------------------------------------------- P


@query("project", "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem")
def project(spark, sf):
    return R.project(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"])


@query("project_except", "SELECT * EXCLUDE (l_shipdate, l_linestatus, l_returnflag) FROM lineitem")
def project_except(spark, sf):
    return R.project_except(table(spark, sf, "lineitem"), ["l_shipdate", "l_linestatus", "l_returnflag"])


@query("filter_gt", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30")
def filter_gt(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return R.filter_cmp(li, "l_quantity", ">", 30)


@query("filter_expr", """
SELECT l_orderkey, l_linenumber, l_discount, l_returnflag FROM lineitem
WHERE l_discount >= 0.05 AND l_returnflag = 'R'""")
def filter_expr(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_returnflag")
    return R.filter_expr(li, "l_discount >= 0.05 AND l_returnflag = 'R'")


@query("derive_column", """
SELECT l_orderkey, l_linenumber,
       round(l_extendedprice * (1 - l_discount), 4) AS net,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross
FROM lineitem""")
def derive_column(spark, sf):
    li = table(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = R.derive(li, net=net, gross=net * (1 + F.col("l_tax")))
    return out.select("l_orderkey", "l_linenumber", rnd("net", 4).alias("net"), rnd("gross", 6).alias("gross"))


@query("drop_if_exists", "SELECT * EXCLUDE (o_orderpriority) FROM orders")
def drop_if_exists(spark, sf):
    return R.drop_if_exists(table(spark, sf, "orders"), "o_orderpriority", "no_such_column")


@query("bin_two", """
SELECT c_custkey, CASE WHEN c_acctbal >= 4000 THEN 'high' ELSE 'low' END AS balance_band
FROM customer""")
def bin_two(spark, sf):
    c = R.bin_by(table(spark, sf, "customer"), "c_acctbal", [4000], ["low", "high"], "balance_band")
    return c.select("c_custkey", "balance_band")


@query("bin_three", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 4000 THEN 'mid'
       ELSE 'high' END AS balance_band
FROM customer""")
def bin_three(spark, sf):
    c = R.bin_by(table(spark, sf, "customer"), "c_acctbal", [0, 4000], ["low", "mid", "high"],
                 "balance_band")
    return c.select("c_custkey", "balance_band")


@query("binary_encode", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS is_final,
       CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS INTEGER) AS is_high
FROM orders""")
def binary_encode(spark, sf):
    o = R.encode_binary(table(spark, sf, "orders"), F.col("o_orderstatus") == "F", "is_final")
    o = R.encode_binary(o, "o_orderpriority IN ('1-URGENT', '2-HIGH')", "is_high")
    return o.select("o_orderkey", "is_final", "is_high")


@query("cast_all_double", """
SELECT TRY_CAST(c_custkey AS DOUBLE) AS c_custkey, TRY_CAST(c_name AS DOUBLE) AS c_name,
       TRY_CAST(c_nationkey AS DOUBLE) AS c_nationkey, TRY_CAST(c_acctbal AS DOUBLE) AS c_acctbal,
       TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment
FROM customer""")
def cast_all_double(spark, sf):
    return R.cast_all(table(spark, sf, "customer"), "double")


@query("select_numeric", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def select_numeric(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*R.numeric_columns(li))


@query("rename_clean", """
SELECT l_orderkey AS lorderkey, l_quantity AS lquantity, l_discount AS ldiscount FROM lineitem""")
def rename_clean(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("l.orderkey"),
                                               F.col("l_quantity").alias("l.quantity"),
                                               F.col("l_discount").alias("l.discount"))
    return R.clean_names(li)


@query("row_id", """
SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_id
FROM orders""")
def row_id(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return R.with_row_id(o, out="row_id", order_by="o_orderkey")


@query("date_month", "SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS o_month FROM orders")
def date_month(spark, sf):
    return R.with_month(table(spark, sf, "orders"), "o_orderdate", "o_month").select("o_orderkey", "o_month")


@query("within_tolerance", """
SELECT l_orderkey, l_linenumber, l_discount,
       CASE WHEN l_discount = 0 THEN NULL ELSE abs(0.05 - l_discount) / l_discount < 0.1 END AS accuracy
FROM lineitem""")
def within_tolerance(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    li = li.withColumn("_pred", F.lit(0.05))
    return R.with_within(li, "_pred", "l_discount", 0.1).drop("_pred")


@query("pack_struct", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem")
def pack_struct(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    packed = R.pack(li, ["l_quantity", "l_discount"], "x")
    return packed.select("l_orderkey", "l_linenumber", "x.*")


@query("drop_nulls", """
SELECT c_custkey, c_acctbal FROM (
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer)
WHERE c_acctbal IS NOT NULL""")
def drop_nulls(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    return R.drop_nulls(c)


# ---------------------------------------------------------------- J


@query("join_inner", """
SELECT o.o_custkey AS custkey, o.o_orderkey, o.o_totalprice, c.c_nationkey, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_inner(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_nationkey", "c_mktsegment")
    return R.join_inner(o, c, ["custkey"])


@query("join_left", """
SELECT c.c_custkey, c.c_name, COALESCE(s.n_orders, 0) AS n_orders, s.total_price
FROM customer c LEFT JOIN (
  SELECT o_custkey AS c_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
  FROM orders GROUP BY o_custkey) s ON c.c_custkey = s.c_custkey""")
def join_left(spark, sf):
    s = (table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.count(F.lit(1)).alias("n_orders"), rnd(F.sum("o_totalprice"), 2).alias("total_price")))
    j = R.join_left(table(spark, sf, "customer").select("c_custkey", "c_name"), s, ["c_custkey"])
    # a customer without orders has 0 orders and no total (null stays null)
    return j.withColumn("n_orders", F.coalesce("n_orders", F.lit(0).cast("long")))


@query("join_asof", """
SELECT r.user_id, r.req_id, r.req_ts, f.ts AS ts_matched, f.value, f.event_id
FROM (SELECT event_id AS req_id, user_id, ts + INTERVAL 30 MINUTE AS req_ts FROM events) r
ASOF LEFT JOIN events f ON r.user_id = f.user_id AND r.req_ts >= f.ts""")
def join_asof(spark, sf):
    ev = table(spark, sf, "events")
    req = ev.select(F.col("event_id").alias("req_id"), "user_id",
                    (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("req_ts"))
    feat = ev.select("user_id", "ts", "value", "event_id")
    return R.join_asof(req, feat, ["user_id"], ts="req_ts", right_ts="ts", cols=["value", "event_id"])


@query("join_cast_key", """
SELECT o.month, o.n_orders, l.n_lines FROM
  (SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n_orders FROM orders GROUP BY 1) o
JOIN
  (SELECT CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n_lines FROM lineitem GROUP BY 1) l
ON o.month = l.month""")
def join_cast_key(spark, sf):
    o = (table(spark, sf, "orders").groupBy(F.month("o_orderdate").alias("month"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    # the other side keys the month as text, as a CSV source would
    li = (table(spark, sf, "lineitem").groupBy(F.month("l_shipdate").cast("string").alias("month"))
          .agg(F.count(F.lit(1)).alias("n_lines")))
    return R.join_cast(o, li, "month", "int")


# ---------------------------------------------------------------- A


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf):
    return R.count_rows(table(spark, sf, "lineitem"))


_DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in LI4)


@query("describe_numeric", _DESCRIBE_SQL)
def describe_numeric(spark, sf):
    d = R.describe_numeric(table(spark, sf, "lineitem"), LI4)
    return d.select("column", "n", rnd("mean", 4).alias("mean"), rnd("stddev", 4).alias("stddev"), "min", "max")


@query("avg_all_numeric", """
SELECT round(avg(l_linenumber), 6) AS avg_l_linenumber, round(avg(l_quantity), 6) AS avg_l_quantity,
       round(avg(l_extendedprice), 4) AS avg_l_extendedprice, round(avg(l_discount), 6) AS avg_l_discount,
       round(avg(l_tax), 6) AS avg_l_tax
FROM lineitem""")
def avg_all_numeric(spark, sf):
    m = R.mean_all(table(spark, sf, "lineitem"))
    return m.select(*[rnd(c, 4 if c == "avg_l_extendedprice" else 6).alias(c) for c in m.columns])


@query("group_count", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_count(spark, sf):
    return R.group_count(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("hit_rate", """
SELECT round(100.0 * count(*) FILTER (WHERE l_discount > 0.05) / count(*), 6) AS pct FROM lineitem""")
def hit_rate(spark, sf):
    return R.hit_rate(table(spark, sf, "lineitem"), "l_discount > 0.05").select(rnd("pct").alias("pct"))


@query("agg_max", "SELECT l_returnflag, max(l_quantity) AS max_l_quantity FROM lineitem GROUP BY l_returnflag")
def agg_max(spark, sf):
    return R.agg_max(table(spark, sf, "lineitem"), "l_quantity", by=["l_returnflag"])


_MV = ["l_quantity", "l_discount", "l_tax"]


@query("median_var", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(median({c}), 6) AS median, round(var_samp({c}), 6) AS var "
    f"FROM lineitem" for c in _MV))
def median_var(spark, sf):
    m = R.median_var(table(spark, sf, "lineitem"), _MV)
    return m.select("column", rnd("median").alias("median"), rnd("var").alias("var"))


_PAIRS = [(a, b) for i, a in enumerate(LI4) for b in LI4[i + 1:]]


@query("corr_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a, b in _PAIRS))
def corr_pairs(spark, sf):
    c = R.corr_pairs(table(spark, sf, "lineitem"), LI4)
    return c.select("a", "b", rnd("r").alias("r"))


@query("group_agg", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(avg(l_discount), 6) AS avg_disc, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty,
       count(*) AS count_order
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_agg(spark, sf):
    return R.group_agg(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "sum_qty": rnd(F.sum("l_quantity"), 2),
        "sum_base_price": rnd(F.sum("l_extendedprice"), 2),
        "sum_disc_price": rnd(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2),
        "avg_disc": rnd(F.avg("l_discount")),
        "min_qty": F.min("l_quantity"),
        "max_qty": F.max("l_quantity"),
        "count_order": F.count(F.lit(1)),
    })


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _clean(v: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in v).lower()


@query("pivot_agg", "SELECT o_orderstatus, " + ", ".join(
    f"round(sum(o_totalprice) FILTER (WHERE o_orderpriority = '{v}'), 2) AS sum_{_clean(v)}" for v in _PRIOS)
    + " FROM orders GROUP BY o_orderstatus")
def pivot_agg(spark, sf):
    p = R.pivot_agg(table(spark, sf, "orders"), ["o_orderstatus"], "o_orderpriority", _PRIOS,
                    F.sum("o_totalprice"), prefix="sum_")
    return p.select("o_orderstatus", *[rnd(f"sum_{_clean(v)}", 2).alias(f"sum_{_clean(v)}") for v in _PRIOS])


# ---------------------------------------------------------------- W


@query("rolling_mean", """
WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, sum(value) AS total FROM events GROUP BY 1, 2)
SELECT event_type, day, round(total, 6) AS total,
       round(CASE WHEN count(total) OVER w = 3 THEN avg(total) OVER w END, 6) AS total_mean3
FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def rolling_mean(spark, sf):
    daily = (table(spark, sf, "events")
             .groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
             .agg(F.sum("value").alias("total")))
    r = R.rolling_mean(daily, ["event_type"], "day", "total", 3, out="total_mean3")
    return r.select("event_type", "day", rnd("total").alias("total"), rnd("total_mean3").alias("total_mean3"))


@query("rolling_mean_rows", """
SELECT event_id, user_id, ts, value,
       round(CASE WHEN count(value) OVER w = 5 THEN avg(value) OVER w END, 6) AS value_mean5
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def rolling_mean_rows(spark, sf):
    """W1 on raw rows: per user, the mean of the last 5 event values,
    spread by day buckets so a hot user is not one task."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    r = R.rolling_mean(ev, ["user_id"], ["ts", "event_id"], "value", 5, out="value_mean5", spread=True)
    return r.select("event_id", "user_id", "ts", "value", rnd("value_mean5").alias("value_mean5"))


# ---------------------------------------------------------------- T


@query("nth_row", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 2")
def nth_row(spark, sf):
    return R.nth_row(table(spark, sf, "orders"), ["o_orderkey"], 2)


@query("best_trial", """
SELECT c_nationkey, c_custkey, c_acctbal FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) = 1""")
def best_trial(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return R.best_row(c, "c_acctbal", "c_custkey", "min", by=["c_nationkey"])


@query("head_n", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def head_n(spark, sf):
    return R.head_n(table(spark, sf, "orders"), [F.col("o_totalprice").desc(), "o_orderkey"], 10)


# ---------------------------------------------------------------- U / R


@query("union_all", "SELECT * FROM nation UNION ALL SELECT * FROM nation UNION ALL SELECT * FROM nation")
def union_all(spark, sf):
    n = table(spark, sf, "nation")
    return R.union_all(n, n, n)


@query("replicate_n", "SELECT CAST(unnest(range(31)) AS INTEGER) AS copy, * FROM supplier")
def replicate_n(spark, sf):
    return R.replicate(table(spark, sf, "supplier"), 31)


@query("shuffle_rows", "SELECT * FROM orders")
def shuffle_rows(spark, sf):
    return R.shuffle_rows(table(spark, sf, "orders"), "o_orderkey", seed=42)


@query("split_train_test", """
SELECT o_orderkey, (o_orderkey * 7919 + 42) % 10007 < 8006 AS is_train FROM orders""")
def split_train_test(spark, sf):
    return R.with_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.8, 42)


@query("split_ratio", """
SELECT o_orderkey, o_totalprice, (o_orderkey * 7919 + 7) % 10007 < 9507 AS is_train FROM orders""")
def split_ratio(spark, sf):
    """R2: a 95/5 split; every row, flagged with its part."""
    return R.with_split(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 0.95, 7)


@query("kfold_assign", """
SELECT o_orderkey, CAST(floor(((o_orderkey * 6007 + 42) % 10007) * 3 / 10007) AS INTEGER) AS fold
FROM orders""")
def kfold_assign(spark, sf):
    return R.with_fold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 3, 42)


_NULL_KEYS = "(SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS k FROM orders)"


@query("split_null_key", f"""
SELECT o_orderkey, coalesce((k * 7919 + 42) % 10007, 42) < 8006 AS is_train,
       coalesce((k * 7919 + 42) % 10007, 42) < 8006 AS is_train_int,
       CAST(floor(coalesce((k * 6007 + 42) % 10007, 42) * 3 / 10007) AS INTEGER) AS fold FROM {_NULL_KEYS}""")
def split_null_key(spark, sf):
    """R1-R3 on a key that is null in every fifth row: each row has its part."""
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("k"))
    o = R.with_fold(R.with_split(o, "k", 0.8, 42), "k", 3, 42)
    return R.with_split(o.withColumn("k", F.col("k").cast("int")), "k", 0.8, 42, "is_train_int").drop("k")


@query("union_wide", "SELECT r_regionkey, r_name FROM region, range(31)")
def union_wide(spark, sf):
    """31 tables in one union."""
    region = table(spark, sf, "region").select("r_regionkey", "r_name")
    return R.union_all(*[region] * 31)


@query("rank_corr", f"""
WITH r AS (SELECT {', '.join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in LI4)}
           FROM lineitem)
""" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM r" for a, b in _PAIRS))
def rank_corr(spark, sf):
    """A8 by average ranks (ties share theirs)."""
    c = RK.rank_corr(table(spark, sf, "lineitem"), LI4)
    return c.select("a", "b", (rnd("r") + F.lit(0.0)).alias("r"))
