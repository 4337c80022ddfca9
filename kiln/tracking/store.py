"""Runs, parameters, metrics, model versions, aliases, lineage and text
artifacts as append-only Parquet tables (K1-K7).

Each ``log_*`` call appends one small file to one table under the store
root, in a folder of its own, so concurrent appends share no temporary
files and all land; nothing is updated in place. An alias move is an
appended row; the newest row per (name, alias) wins. Version numbers are
read, then written: registering one model name is for one writer at a time.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.sources import fs

SCHEMAS = {
    "runs": "run_id string, parent_run_id string, name string, ts timestamp",
    "params": "run_id string, key string, value string",
    "metrics": "run_id string, key string, value double, step bigint",
    "models": "name string, version bigint, path string, run_id string, ts timestamp, signature string",
    "aliases": "name string, alias string, version bigint, ts timestamp, seq bigint",
    "run_inputs": "run_id string, role string, source string, n_rows bigint, digest bigint",
    "artifacts": "run_id string, name string, text string",
}


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class Store:
    """Handle on a tracking root (a shared folder)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        p = self.path(name)
        if not fs.exists(self.spark, p):
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).option("recursiveFileLookup", "true").parquet(p)

    def _own(self, name: str) -> str:
        return f"{self.path(name)}/{uuid.uuid4().hex}"

    def append(self, name: str, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(self._own(name))

    def append_df(self, name: str, df: DataFrame) -> None:
        schema = self.spark.createDataFrame([], SCHEMAS[name]).schema
        (df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).coalesce(1)
         .write.parquet(self._own(name)))


def log_run(store: Store, run_id: str, params: dict | None = None, metrics: dict | None = None,
            parent: str | None = None, ts: _dt.datetime | None = None, name: str | None = None,
            step: int = 0) -> None:
    """K1/K2: one run row plus its params and metrics."""
    store.append("runs", [(run_id, parent, name, ts or _now())])
    store.append("params", [(run_id, str(k), json.dumps(v) if not isinstance(v, str) else v)
                            for k, v in (params or {}).items()])
    store.append("metrics", [(run_id, str(k), float(v), int(step)) for k, v in (metrics or {}).items()])


def log_metrics_df(store: Store, run_id: str, df: DataFrame, step: int = 0) -> None:
    """K1 for metrics computed by Spark: every column of a one-row metrics
    frame becomes a (key, value) row, written without a driver round trip."""
    cols = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint")]
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value"))
                                        for c in cols])))
    store.append_df("metrics", long.select(F.lit(run_id).alias("run_id"), "key", "value",
                                           F.lit(step).cast("long").alias("step")))


def log_children(store: Store, parent: str, runs: DataFrame, ts: _dt.datetime | None = None, step: int = 0) -> None:
    """K2: a child run of ``parent`` per row of ``runs(run_id, metrics...)``, and
    every numeric column as its metric: two appends, whatever the number of
    children; none of it passes the driver."""
    cols = [c for c, t in runs.dtypes if c != "run_id" and t in ("double", "float", "int", "bigint", "smallint")]
    if not cols:
        raise ValueError("no numeric column to log")
    runs = runs.checkpoint()                        # read by both appends
    store.append_df("runs", runs.select("run_id", F.lit(parent).alias("parent_run_id"), F.lit(None).alias("name"),
                                        F.lit(ts or _now()).alias("ts")).select(*store.table("runs").columns))
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in cols]))
    store.append_df("metrics", runs.select("run_id", pairs).select("run_id", "key", "value", F.lit(step).cast("long").alias("step")))


def run_tree(store: Store) -> DataFrame:
    """K2: child metrics rolled up to their parent: (parent_run_id, key,
    n_children, mean, min, max)."""
    runs = store.table("runs").filter(F.col("parent_run_id").isNotNull())
    m = store.table("metrics").join(runs.select("run_id", "parent_run_id"), "run_id")
    return m.groupBy("parent_run_id", "key").agg(
        F.count(F.lit(1)).alias("n_children"), F.avg("value").alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def register(store: Store, name: str, path: str, run_id: str, alias: str | None = None,
             ts: _dt.datetime | None = None, signature: str | None = None) -> int:
    """K3: next version number of ``name`` (max + 1), optional alias move."""
    cur = store.table("models").filter(F.col("name") == name).agg(F.max("version")).first()[0]
    version = 1 if cur is None else int(cur) + 1
    store.append("models", [(name, version, path, run_id, ts or _now(), signature)])
    if alias:
        set_alias(store, name, alias, version, ts)
    return version


def set_alias(store: Store, name: str, alias: str, version: int, ts: _dt.datetime | None = None) -> None:
    seq = store.table("aliases").agg(F.max("seq")).first()[0]
    store.append("aliases", [(name, alias, int(version), ts or _now(), 0 if seq is None else int(seq) + 1)])


def aliases(store: Store) -> DataFrame:
    """Current alias -> version map (newest row per name and alias)."""
    w = Window.partitionBy("name", "alias").orderBy(F.col("seq").desc())
    return (store.table("aliases").withColumn("_r", F.row_number().over(w)).filter("_r = 1")
            .select("name", "alias", "version"))


def resolve(store: Store, name: str, alias: str) -> str | None:
    """K4: model path behind an alias, or None when the alias is unset."""
    row = (aliases(store).filter((F.col("name") == name) & (F.col("alias") == alias))
           .join(store.table("models"), ["name", "version"]).select("path").first())
    return None if row is None else row.path


def resolve_or_register(store: Store, name: str, alias: str, make) -> str:
    """K4: resolve; if the alias is unset, call ``make() -> (path, run_id)``,
    register it under the alias, and return its path."""
    path = resolve(store, name, alias)
    if path is None:
        path, run_id = make()
        register(store, name, path, run_id, alias=alias)
    return path


def signature(df: DataFrame, cols=None) -> str:
    """K5: input/output schema as JSON."""
    sub = df.select(*cols) if cols else df
    return sub.schema.json()


class SignatureError(ValueError):
    pass


def check_signature(df: DataFrame, sig: str) -> None:
    """K5: every column of the signature must exist with the same type."""
    want = T.StructType.fromJson(json.loads(sig))
    have = {f.name: f.dataType for f in df.schema}
    bad = [f.name for f in want if have.get(f.name) != f.dataType]
    if bad:
        raise SignatureError(f"columns missing or of another type: {bad}")


def input_digest(df: DataFrame) -> DataFrame:
    """(n_rows, digest): an order-free content digest from the XOR and the
    exact sum of a 64-bit hash of every row (the sum counts repeated rows,
    which an XOR alone cancels), computed as one partial aggregate."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.xxhash64(F.bit_xor(h), F.sum(h.cast("decimal(20,0)")).cast("string")).alias("digest"))


def log_input(store: Store, run_id: str, df: DataFrame, role: str, source: str) -> None:
    """K6: dataset lineage row (role: source / training / test)."""
    d = input_digest(df)
    store.append_df("run_inputs", d.select(F.lit(run_id).alias("run_id"), F.lit(role).alias("role"),
                                           F.lit(source).alias("source"), "n_rows", "digest"))


def log_text(store: Store, run_id: str, name: str, text: str) -> None:
    """K7."""
    store.append("artifacts", [(run_id, name, text)])
