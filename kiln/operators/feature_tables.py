"""Keyed feature tables (F1-F9) on top of versioned tables.

A feature table is a versioned table plus metadata (primary keys, optional
event-time column, partition columns, description, tags). Key validity is
checked by a Spark job; only a handful of offending keys come back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.operators.relational import join_asof
from kiln.sources import snapshots as V
from kiln.sources import zones

REPORT_LIMIT = 10  # offending keys quoted in an error message


class KeyViolation(ValueError):
    """Primary key has nulls or duplicates."""


def offending_keys(df: DataFrame, keys) -> DataFrame:
    """Every key that is null in part or occurs more than once, with its row
    count ``_n`` (one grouped pass; a null key is a group of its own)."""
    any_null = " OR ".join(f"`{k}` IS NULL" for k in keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(f"_n > 1 OR {any_null}")


def check_keys(df: DataFrame, keys) -> None:
    """Raise ``KeyViolation`` unless ``keys`` are non-null and unique. The
    message quotes a few keys; ``offending_keys`` has all of them."""
    keys = list(keys)
    bad = offending_keys(df, keys).limit(REPORT_LIMIT).collect()
    if any(any(r[k] is None for k in keys) for r in bad):
        raise KeyViolation(f"primary key {keys} has null values")
    if bad:
        raise KeyViolation(f"primary key {keys} is not unique, e.g. {[tuple(r)[:-1] for r in bad]}")


def create(spark: SparkSession, root: str, keys, df: DataFrame | None = None, schema: StructType | None = None,
           ts: _dt.datetime | None = None, timestamp_col: str | None = None, partitions=(),
           description: str = "", tags: dict | None = None) -> int:
    """create a table from a frame (keys checked) or from a schema
    alone (empty, filled later by ``merge``)."""
    if df is None and schema is None:
        raise ValueError("need df or schema")
    if V.latest(spark, root) is not None:
        raise FileExistsError(f"feature table exists at {root}")
    data = df if df is not None else spark.createDataFrame([], schema)
    missing = [k for k in keys if k not in data.columns]
    if missing:
        raise KeyViolation(f"key columns {missing} not in the table")
    if df is not None:
        check_keys(df, keys)
    V.write_meta(spark, root, {"primary_keys": list(keys), "timestamp_col": timestamp_col,
                               "partition_by": list(partitions), "description": description,
                               "tags": dict(tags or {})})
    return V.write_version(data, root, "CREATE", ts)


def read(spark: SparkSession, root: str, as_of: _dt.datetime | None = None,
         version: int | None = None) -> DataFrame:
    """the table now, as of a time, or at a version."""
    return V.read_as_of(spark, root, ts=as_of, version=version)


def metadata(spark: SparkSession, root: str) -> dict:
    """stored metadata plus the current feature (non-key) columns."""
    meta = V.read_meta(spark, root)
    cols = read(spark, root).columns
    meta["features"] = [c for c in cols if c not in meta.get("primary_keys", [])]
    return meta


def merge_frames(current: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """F4 core: upsert ``incoming`` into ``current`` by key.

    A row present in the input takes the input's value for every column the
    input carries (an incoming null overwrites); columns the input lacks keep
    the stored values; new columns are null on rows the input does not
    touch. One full outer join on the key, with presence flags so a stored
    null and a missing row are told apart.
    """
    keys = list(keys)
    cur_cols = [c for c in current.columns if c not in keys]
    in_cols = [c for c in incoming.columns if c not in keys]
    s = current.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cur_cols], F.lit(True).alias("_s"))
    i = incoming.select(*keys, *[F.col(c).alias(f"_i_{c}") for c in in_cols], F.lit(True).alias("_i"))
    j = s.join(i, keys, "full_outer")
    out = []
    for c in cur_cols:
        if c in in_cols:
            out.append(F.when(F.col("_i").isNotNull(), F.col(f"_i_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
        else:
            out.append(F.col(f"_s_{c}").alias(c))
    out += [F.col(f"_i_{c}").alias(c) for c in in_cols if c not in cur_cols]
    return j.select(*keys, *out)


def touched_segments(spark: SparkSession, root: str, row, df: DataFrame, keys) -> list[str]:
    """Segments of a version that hold a key of ``df``. The zone maps rule most
    of them out; of the rest, the key columns are semi-joined, and one name per
    segment comes back."""
    keys = list(keys)
    near = zones.met(spark, root, row.segments, df, keys)
    if not near:
        return []
    stored = V.segments_of(spark, row, near).select(*keys, F.col("_metadata.file_path").alias("_file"))
    hit = stored.join(df.select(*keys), keys, "left_semi").select(
        F.regexp_extract("_file", r"/(seg-[0-9]+-[0-9a-f]+)/", 1).alias("_seg")).distinct()
    names = {r["_seg"] for r in hit.collect()}
    return [x for x in near if zones.name_of(x) in names]


def lookup(spark: SparkSession, root: str, keys_df: DataFrame, as_of: _dt.datetime | None = None) -> DataFrame:
    """Rows of the table (now or as of a time) whose key is in ``keys_df``. Only
    segments whose key bounds meet a key are read."""
    keys = V.read_meta(spark, root)["primary_keys"]
    row = V.version_row(spark, root, ts=as_of)
    near = zones.met(spark, root, row.segments, keys_df, keys)
    rows = V.segments_of(spark, row, near) if near else spark.createDataFrame([], read(spark, root, as_of).schema)
    return rows.join(keys_df.select(*keys), keys, "left_semi")


def merge(spark: SparkSession, root: str, df: DataFrame, ts: _dt.datetime | None = None) -> int:
    """write a new version = current upserted with ``df``. Only the
    segments that hold one of its keys are rewritten (with the new rows); the
    others stay as they are."""
    meta = V.read_meta(spark, root)
    keys = meta["primary_keys"]
    check_keys(df, keys)
    cur = V.latest(spark, root)
    if set(meta.get("dropped") or []) & set(df.columns):
        hit = list(cur.segments)      # old files still hold a dropped column of this name
        meta["dropped"] = []
        V.write_meta(spark, root, meta)
    else:
        hit = touched_segments(spark, root, cur, df, keys)
    schema = read(spark, root).schema
    old = V.segments_of(spark, cur, hit) if hit else spark.createDataFrame([], schema)
    return V.write_version(merge_frames(old, df, keys), root, "MERGE", ts, keep=[x for x in cur.segments if x not in hit])


def drop_features(spark: SparkSession, root: str, cols, ts: _dt.datetime | None = None) -> int:
    """new version without ``cols``; key, partition and clustering columns
    are refused. No data is written: the version shows fewer columns. Older
    versions keep them (readable with ``read(as_of=...)``)."""
    meta = V.read_meta(spark, root)
    for what, names in (("key", meta["primary_keys"]), ("partition", meta.get("partition_by") or []),
                        ("clustering", meta.get("cluster_by") or [])):
        bad = [c for c in cols if c in names]
        if bad:
            raise KeyViolation(f"cannot drop {what} columns {bad}")
    schema = StructType([f for f in read(spark, root).schema.fields if f.name not in set(cols)])
    meta["dropped"] = sorted({*(meta.get("dropped") or []), *cols})
    V.write_meta(spark, root, meta)
    return V.write_schema(spark, root, schema, "DROP COLUMNS", ts)


def convert(df: DataFrame, root: str, keys, ts: _dt.datetime | None = None, description: str = "") -> int:
    """F8: turn an existing table into a feature table once its key is
    non-null and unique (the error names offending keys)."""
    return create(df.sparkSession, root, keys, df=df, ts=ts, description=description)


def training_set(features: DataFrame, labels: DataFrame, keys, ts: str | None = None,
                 drop_keys: bool = True) -> DataFrame:
    """feature rows left-joined with labels on the key (as-of on ``ts``
    when given: each label row sees features from its time or earlier),
    keys dropped."""
    keys = list(keys)
    if ts:
        cols = [c for c in features.columns if c not in keys + [ts]]
        out = join_asof(labels, features, keys, ts, cols=cols)
        out = out.drop(f"{ts}_matched")
    else:
        out = features.join(labels, keys, "left")
    return out.drop(*keys) if drop_keys else out
