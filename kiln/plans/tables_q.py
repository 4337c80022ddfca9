"""Queries for writes, snapshots, feature tables, tracking and layout.

Each query writes under a fresh folder inside the shared checkpoint root
and reads its result back, so the oracle checks what was stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from kiln.ml import evaluation as E
from kiln.ml import models as L
from kiln.operators import feature_tables as FT
from kiln.operators import layout as Y
from kiln.operators import relational as R
from kiln.operators import timing as TM
from kiln.plans.ml_q import _planted_stump, part_linear_stages
from kiln.plans.registry import query, rnd, table
from kiln.session import scratch_path
from kiln.sources import snapshots as V
from kiln.sources import tables as S
from kiln.tracking import store as K

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 3)

# ---------------------------------------------------------------- S4-S11


@query("scan_csv", "SELECT * FROM part")
def scan_csv(spark, sf):
    part = table(spark, sf, "part")
    path = scratch_path(spark, "csv")
    part.write.option("header", True).csv(path)
    return S.scan_csv(spark, path, schema=part.schema)


@query("sink_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def sink_append(spark, sf):
    o, path = table(spark, sf, "orders"), scratch_path(spark, "append")
    S.sink(o, path, "overwrite")
    S.sink(o, path, "append")
    return spark.read.parquet(path)


@query("sink_overwrite", "SELECT * FROM customer WHERE c_acctbal > 0")
def sink_overwrite(spark, sf):
    c, path = table(spark, sf, "customer"), scratch_path(spark, "overwrite")
    S.sink(c, path, "errorifexists")
    S.sink(R.filter_cmp(c, "c_acctbal", ">", 0), path, "overwrite")
    return spark.read.parquet(path)


@query("sink_replace_schema", """
SELECT *, CASE WHEN p_size >= 25 THEN 'big' ELSE 'small' END AS p_size_band FROM part""")
def sink_replace_schema(spark, sf):
    p, path = table(spark, sf, "part"), scratch_path(spark, "replace")
    S.sink(p, path, "overwrite")
    wider = R.bin_by(p, "p_size", [25], ["small", "big"], "p_size_band")
    try:
        S.sink(wider, path, "overwrite")
        raise AssertionError("schema change was not refused")
    except S.SchemaChangeError:
        pass
    S.sink(wider, path, "overwrite", replace_schema=True)
    return spark.read.parquet(path)


@query("sink_ignore", "SELECT * FROM nation")
def sink_ignore(spark, sf):
    path = scratch_path(spark, "ignore")
    S.sink(table(spark, sf, "nation"), path, "errorifexists")
    S.sink(table(spark, sf, "region"), path, "ignore")
    return spark.read.parquet(path)


def orders_versions(spark, sf) -> str:
    """v0 all orders, v1 append of the final ones, v2 overwrite with the open ones."""
    o, root = table(spark, sf, "orders"), scratch_path(spark, "versions")
    V.write_version(o, root, "WRITE", T0)
    V.write_version(o.filter("o_orderstatus = 'F'"), root, "APPEND", T1, mode="append")
    V.write_version(o.filter("o_orderstatus = 'O'"), root, "OVERWRITE", T2, mode="overwrite")
    return root


_ZORDER_APPEND_SQL = """
SELECT l_returnflag, count(*) AS n, CAST(sum(l_orderkey * 8 + l_linenumber) AS BIGINT) AS keys, true AS old_kept
FROM lineitem GROUP BY l_returnflag"""


@query("version_write", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def version_write(spark, sf):
    return V.read_as_of(spark, orders_versions(spark, sf))


@query("read_as_of", "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'")
def read_as_of(spark, sf):
    root = orders_versions(spark, sf)
    return V.read_as_of(spark, root, ts=T1 + dt.timedelta(hours=12))


_HISTORY_SQL = """
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS n_rows FROM orders
UNION ALL SELECT 1, 'APPEND', (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 2, 'OVERWRITE', count(*) FROM orders WHERE o_orderstatus = 'O'"""


@query("table_history", _HISTORY_SQL)
def table_history(spark, sf):
    return V.history(spark, orders_versions(spark, sf)).select("version", "operation", "n_rows")


# ---------------------------------------------------------------- F


def customer_table(spark, sf, ts=T0) -> str:
    root = scratch_path(spark, "ft-customer")
    FT.create(spark, root, ["c_custkey"], df=table(spark, sf, "customer"), ts=ts,
              description="customer features", tags={"team": "demo"})
    return root


@query("ft_create", "SELECT * FROM customer")
def ft_create(spark, sf):
    return FT.read(spark, customer_table(spark, sf))


@query("ft_create_empty", "SELECT * FROM customer")
def ft_create_empty(spark, sf):
    c, root = table(spark, sf, "customer"), scratch_path(spark, "ft-empty")
    FT.create(spark, root, ["c_custkey"], schema=c.schema, ts=T0)
    FT.merge(spark, root, c, ts=T1)
    return FT.read(spark, root)


@query("ft_read", "SELECT * EXCLUDE (c_custkey) FROM customer")
def ft_read(spark, sf):
    root = customer_table(spark, sf)
    meta = FT.metadata(spark, root)
    return FT.read(spark, root).select(*meta["features"])


@query("ft_merge", """
WITH inc AS (
  SELECT c_custkey, CAST(0 AS DOUBLE) AS c_acctbal, 'reset' AS c_flag, NULL AS c_nationkey FROM customer
  WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey + 1000000, c_acctbal, 'new', c_nationkey FROM customer WHERE c_nationkey = 0)
SELECT COALESCE(s.c_custkey, i.c_custkey) AS c_custkey, s.c_name,
       CASE WHEN s.c_custkey IS NULL THEN 0 ELSE s.c_nationkey END AS c_nationkey,
       CASE WHEN i.c_custkey IS NOT NULL THEN i.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
       s.c_mktsegment, i.c_flag
FROM customer s FULL OUTER JOIN inc i ON s.c_custkey = i.c_custkey""")
def ft_merge(spark, sf):
    c = table(spark, sf, "customer")
    root = customer_table(spark, sf)
    reset = c.filter("c_acctbal < 0").select("c_custkey", F.lit(0.0).alias("c_acctbal"),
                                            F.lit("reset").alias("c_flag"))
    new = c.filter("c_nationkey = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_acctbal",
                                            F.lit("new").alias("c_flag"), "c_nationkey")
    FT.merge(spark, root, new, ts=T1)  # new keys, carrying c_nationkey; other columns stay null
    FT.merge(spark, root, reset, ts=T2)  # known keys; columns absent here keep their values
    return FT.read(spark, root)


@query("ft_lookup", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 1000 IN (3, 7) OR c_custkey < 40""")
def ft_lookup(spark, sf):
    """Rows of some keys from a table of several segments; the zone maps
    rule segments out before they are read."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    root = scratch_path(spark, "lookup")
    FT.create(spark, root, ["c_custkey"], df=c.filter("c_custkey < 500"), ts=T0)
    FT.merge(spark, root, c.filter("c_custkey >= 500"), ts=T1)
    return FT.lookup(spark, root, c.filter("c_custkey % 1000 IN (3, 7) OR c_custkey < 40"))


@query("zorder_append", _ZORDER_APPEND_SQL)
def zorder_append(spark, sf):
    """Y3 on a table that grows: the second run orders the new rows only."""
    li, root = table(spark, sf, "lineitem"), scratch_path(spark, "zorder")
    V.write_version(li.filter("l_orderkey % 10 <> 0"), root, "WRITE", T0)
    Y.zorder(spark, root, ["l_quantity", "l_discount"], bits=4, ts=T1)
    V.write_version(li.filter("l_orderkey % 10 = 0"), root, "APPEND", T1, mode="append")
    first = V.latest(spark, root).segments[0]
    Y.zorder(spark, root, ["l_quantity", "l_discount"], bits=4, ts=T2)
    now = V.latest(spark, root)
    kept = F.lit(first in now.segments and len(now.segments) == 2)
    return V.read_as_of(spark, root).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("keys")).withColumn("old_kept", kept)


@query("ft_add_feature", """
SELECT *, CASE WHEN c_acctbal >= 4000 THEN 'high' ELSE 'low' END AS balance_band FROM customer""")
def ft_add_feature(spark, sf):
    root = customer_table(spark, sf)
    cur = FT.read(spark, root)
    upd = R.bin_by(cur, "c_acctbal", [4000], ["low", "high"], "balance_band").select(
        "c_custkey", "balance_band")
    FT.merge(spark, root, upd, ts=T1)
    return FT.read(spark, root)


@query("ft_drop_feature", "SELECT * EXCLUDE (c_mktsegment) FROM customer")
def ft_drop_feature(spark, sf):
    root = customer_table(spark, sf)
    FT.drop_features(spark, root, ["c_mktsegment"], ts=T1)
    return FT.read(spark, root)


@query("ft_as_of", "SELECT * FROM customer")
def ft_as_of(spark, sf):
    root = customer_table(spark, sf)
    FT.drop_features(spark, root, ["c_mktsegment"], ts=T1)
    return FT.read(spark, root, as_of=T0 + dt.timedelta(hours=1))


@query("ft_convert", "SELECT * FROM part")
def ft_convert(spark, sf):
    root = scratch_path(spark, "ft-part")
    FT.convert(table(spark, sf, "part"), root, ["p_partkey"], ts=T0)
    return FT.read(spark, root)


@query("ft_training_set", """
SELECT c.c_acctbal, c.c_nationkey, COALESCE(o.n_orders, 0) AS n_orders
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
ON c.c_custkey = o.o_custkey""")
def ft_training_set(spark, sf):
    root = customer_table(spark, sf)
    feats = FT.read(spark, root).select("c_custkey", "c_acctbal", "c_nationkey")
    labels = (table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.count(F.lit(1)).alias("n_orders")))
    ts = FT.training_set(feats, labels, ["c_custkey"])
    return ts.withColumn("n_orders", F.coalesce("n_orders", F.lit(0).cast("long")))


# ---------------------------------------------------------------- K


def new_store(spark) -> K.Store:
    return K.Store(spark, scratch_path(spark, "tracking"))


@query("log_run", """
SELECT 'run-1' AS run_id, 'n_rows' AS key, CAST(count(*) AS DOUBLE) AS value, CAST(0 AS BIGINT) AS step FROM lineitem
UNION ALL SELECT 'run-1', 'avg_quantity', round(avg(l_quantity), 6), 0 FROM lineitem""")
def log_run(spark, sf):
    st = new_store(spark)
    K.log_run(st, "run-1", params={"source": "lineitem", "seed": 42}, ts=T0, name="profile")
    li = table(spark, sf, "lineitem")
    K.log_metrics_df(st, "run-1", li.agg(F.count(F.lit(1)).alias("n_rows"),
                                         rnd(F.avg("l_quantity")).alias("avg_quantity")))
    return st.table("metrics")


@query("run_tree", """
WITH g AS (SELECT l_returnflag, round(avg(l_quantity), 6) AS v FROM lineitem GROUP BY 1)
SELECT 'parent' AS parent_run_id, 'avg_quantity' AS key, count(*) AS n_children, round(avg(v), 6) AS mean,
       min(v) AS min, max(v) AS max FROM g""")
def run_tree(spark, sf):
    st = new_store(spark)
    K.log_run(st, "parent", ts=T0, name="sweep")
    li = table(spark, sf, "lineitem")
    children = li.groupBy(F.concat(F.lit("child-"), "l_returnflag").alias("run_id")).agg(rnd(F.avg("l_quantity")).alias("avg_quantity"))
    K.log_children(st, "parent", children, ts=T0)
    t = K.run_tree(st)
    return t.select("parent_run_id", "key", "n_children", rnd("mean").alias("mean"), "min", "max")


def _register_two(spark, sf, st):
    """v1 fitted on an 80% split, v2 on a 95% split; champion moves to v2."""
    part = table(spark, sf, "part")
    for ratio in (0.8, 0.95):
        train, _ = R.split(part, "p_partkey", ratio, 42)
        model = L.fit_pipeline(train, part_linear_stages())
        path = scratch_path(spark, "registered")
        L.save_model(model, path)
        run = f"fit-{ratio}"
        K.log_input(st, run, train, "training", "part")
        K.register(st, "part_price", path, run, alias="champion", ts=T0)


@query("register_model", """
SELECT 'part_price' AS name, CAST(1 AS BIGINT) AS version, 'fit-0.8' AS run_id, false AS is_champion,
       count(*) AS n_train FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006
UNION ALL
SELECT 'part_price', 2, 'fit-0.95', true, count(*) FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 9507""")
def register_model(spark, sf):
    st = new_store(spark)
    _register_two(spark, sf, st)
    champ = K.aliases(st).filter("alias = 'champion'").select("name", "version", F.lit(True).alias("_c"))
    ins = st.table("run_inputs").select("run_id", F.col("n_rows").alias("n_train"))
    return (st.table("models").join(champ, ["name", "version"], "left").join(ins, "run_id")
            .select("name", "version", "run_id", F.coalesce("_c", F.lit(False)).alias("is_champion"), "n_train"))


@query("resolve_alias", """
WITH m AS (SELECT regr_intercept(p_retailprice, p_partkey) AS a, regr_slope(p_retailprice, p_partkey) AS b
           FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 9507)
SELECT t.p_partkey, round(m.a + m.b * t.p_partkey, 4) AS prediction FROM part t, m""")
def resolve_alias(spark, sf):
    st = new_store(spark)
    _register_two(spark, sf, st)
    path = K.resolve_or_register(st, "part_price", "champion", make=lambda: (None, None))
    model = L.load_model(path)
    return L.score(model, table(spark, sf, "part")).select("p_partkey", rnd("prediction", 4).alias("prediction"))


@query("schema_check", f"""
SELECT t.p_partkey, round(m.a + m.b * t.p_partkey, 4) AS prediction
FROM part t, (SELECT regr_intercept(p_retailprice, p_partkey) AS a, regr_slope(p_retailprice, p_partkey) AS b
              FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006) m""")
def schema_check(spark, sf):
    part = table(spark, sf, "part")
    train, test = R.split(part, "p_partkey", 0.8, 42)
    model = L.fit_pipeline(train, part_linear_stages())
    sig = K.signature(train, ["p_partkey", "p_retailprice"])
    K.check_signature(part, sig)  # raises on a missing or retyped column
    return L.score(model, part).select("p_partkey", rnd("prediction", 4).alias("prediction"))


@query("run_inputs", """
SELECT 'fit' AS run_id, 'source' AS role, 'part' AS source, count(*) AS n_rows FROM part
UNION ALL SELECT 'fit', 'training', 'part', count(*) FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006
UNION ALL SELECT 'fit', 'test', 'part', count(*) FROM part WHERE (p_partkey * 7919 + 42) % 10007 >= 8006""")
def run_inputs(spark, sf):
    st = new_store(spark)
    part = table(spark, sf, "part")
    train, test = R.split(part, "p_partkey", 0.8, 42)
    for role, d in (("source", part), ("training", train), ("test", test)):
        K.log_input(st, "fit", d, role, "part")
    return st.table("run_inputs").select("run_id", "role", "source", "n_rows")


@query("log_artifact", """
WITH c AS (SELECT (max(l_quantity) FILTER (WHERE l_quantity < 30) + min(l_quantity) FILTER (WHERE l_quantity >= 30)) / 2 AS t
           FROM lineitem)
SELECT 'stump' AS run_id, 'tree_rules.txt' AS name,
       'l_quantity <= ' || CAST(t AS VARCHAR) || ' -> 0.0' || chr(10) || 'l_quantity > ' || CAST(t AS VARCHAR) || ' -> 1.0'
       AS text FROM c""")
def log_artifact(spark, sf):
    st = new_store(spark)
    model, _ = _planted_stump(spark, sf, "l_quantity", 30, "l_discount")
    rules = L.tree_rules(spark, model).orderBy("leaf", "step").collect()  # 2^depth rows at most
    text = "\n".join(f"{r.feature} {r.op} {r.threshold!r} -> {r.prediction!r}" for r in rules)
    K.log_text(st, "stump", "tree_rules.txt", text)
    return st.table("artifacts")


# ---------------------------------------------------------------- Y


def many_files(spark, sf, name: str, files: int = 40) -> str:
    root = scratch_path(spark, f"layout-{name}")
    V.write_version(table(spark, sf, name).repartition(files), root, "WRITE", T0, prepared=True)
    return root


@query("compact", "SELECT * FROM orders")
def compact(spark, sf):
    root = many_files(spark, sf, "orders")
    Y.compact(spark, root, target_bytes=1 << 20, ts=T1)
    return V.read_as_of(spark, root)


@query("expire_snapshots", """
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS n_rows, true AS expired FROM orders
UNION ALL SELECT 1, 'APPEND', (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'), true
UNION ALL SELECT 2, 'OVERWRITE', count(*), false FROM orders WHERE o_orderstatus = 'O'""")
def expire_snapshots(spark, sf):
    root = orders_versions(spark, sf)
    Y.expire(spark, root, hours=1, now=T2 + dt.timedelta(hours=2), dry_run=False, force=True)
    return V.history(spark, root).select("version", "operation", "n_rows", "expired")


Z_CUTS = {"l_quantity": [10, 20, 30, 40], "l_discount": [0.02, 0.04, 0.06, 0.08]}


def _z_sql() -> str:
    bq = " + ".join(f"CAST(l_quantity >= {c} AS INTEGER)" for c in Z_CUTS["l_quantity"])
    bd = " + ".join(f"CAST(l_discount >= {c} AS INTEGER)" for c in Z_CUTS["l_discount"])
    terms = []
    for b in range(3):
        terms.append(f"(((bq >> {b}) & 1) << {2 * b})")
        terms.append(f"(((bd >> {b}) & 1) << {2 * b + 1})")
    return (f"SELECT * EXCLUDE (bq, bd), CAST({' | '.join(terms)} AS BIGINT) AS z FROM "
            f"(SELECT *, CAST({bq} AS BIGINT) AS bq, CAST({bd} AS BIGINT) AS bd FROM lineitem)")


@query("zorder", _z_sql())
def zorder(spark, sf):
    """The z-ordered rewrite keeps every row; z from fixed cuts."""
    root = many_files(spark, sf, "lineitem", 8)
    Y.zorder(spark, root, ["l_quantity", "l_discount"], bits=4, target_bytes=1 << 18, ts=T1)
    out = V.read_as_of(spark, root)
    return out.withColumn("z", Y.z_value(["l_quantity", "l_discount"], Z_CUTS, bits=3))


@query("cluster_by", "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'")
def cluster_by(spark, sf):
    o, root = table(spark, sf, "orders"), scratch_path(spark, "clustered")
    V.write_version(o, root, "WRITE", T0)
    Y.cluster_by(spark, root, ["o_custkey"])
    V.write_version(o.filter("o_orderstatus = 'F'"), root, "APPEND", T1, mode="append")
    return V.read_as_of(spark, root)


@query("layout_report")
def layout_report(spark, sf):
    """A group count timed before and after compaction."""
    root = many_files(spark, sf, "orders", 200)

    def q():
        return R.group_count(V.read_as_of(spark, root), ["o_orderstatus"])
    return TM.layout_report(spark, q, lambda: Y.compact(spark, root, target_bytes=1 << 22, ts=T1),
                            lambda: Y.file_stats(spark, root), runs=3)


@query("layout_gain", """
WITH hit AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O')
SELECT 'files' AS metric, CAST(40 AS BIGINT) AS before, CAST(1 AS BIGINT) AS after
UNION ALL SELECT 'files_met', 40, 1 UNION ALL SELECT 'rows_met', n, n FROM hit""")
def layout_gain(spark, sf):
    """Y6 from the scans: files that a filter meets before and after compaction."""
    root = many_files(spark, sf, "orders", 40)
    old = V.latest(spark, root).version
    Y.compact(spark, root, target_bytes=1 << 28, ts=T1)
    return TM.scan_gain(V.read_as_of(spark, root, version=old), V.read_as_of(spark, root), "o_orderstatus = 'O'")


@query("timing_report")
def timing_report(spark, sf):
    """One job (means of numeric columns) done two ways."""
    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    src = f"{sf}/lineitem.parquet"
    return TM.timed(spark, {
        "one_pass": lambda: R.mean_all(li, cols),
        "per_column_union": lambda: R.union_all(*[li.agg(F.avg(c).alias("avg")) for c in cols]),
        "eval_regression": lambda: E.eval_regression(li.withColumn("p", F.col("l_extendedprice")),
                                                     "l_extendedprice", "p"),
    }, runs=3, inputs={"one_pass": src, "per_column_union": src, "eval_regression": src})
