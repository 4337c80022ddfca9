"""Versioned tables (S9-S11): immutable Parquet segments plus a manifest.

Layout of a table root::

    root/seg-<version>-<id>/part-*.parquet    immutable data segments
    root/_manifest/part-*.parquet             one row per version
    root/_zones/<segment>/part-*.parquet      key bounds of the segment's files
    root/_expired/part-*.parquet              versions whose files were removed
    root/_meta.json                           keys, clustering, description

A version is the list of segments that make up the table at that point.
An append adds one segment and reuses the others, so it never copies old
data; an overwrite starts a new list. The manifest row is written last,
so a failed or retried write leaves an unreferenced segment, never a
half-visible version. One writer per table at a time.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.sources import fs, zones

MANIFEST_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("operation", T.StringType(), False),
    T.StructField("segments", T.ArrayType(T.StringType()), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("n_files", T.IntegerType(), False),
    T.StructField("n_bytes", T.LongType(), False),
    T.StructField("schema", T.StringType(), True),
    # rows, files and bytes of each segment, in the order of ``segments``
    T.StructField("sizes", T.ArrayType(T.ArrayType(T.LongType())), True),
])
EXPIRED_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("expired_at", T.TimestampType(), False),
])


#: Row groups of the segments' files: a read can be split no finer than these.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All manifest rows (a handful per table; metadata only)."""
    path = f"{root}/_manifest"
    if not fs.exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def expired_versions(spark: SparkSession, root: str) -> set[int]:
    path = f"{root}/_expired"
    if not fs.exists(spark, path):
        return set()
    return {r.version for r in spark.read.schema(EXPIRED_SCHEMA).parquet(path).collect()}


def latest(spark: SparkSession, root: str):
    """The newest manifest row, or None for a table with no versions."""
    rows = manifest(spark, root).orderBy(F.col("version").desc()).limit(1).collect()
    return rows[0] if rows else None


def read_meta(spark: SparkSession, root: str) -> dict:
    text = fs.read_text(spark, f"{root}/_meta.json")
    return json.loads(text) if text else {}


def write_meta(spark: SparkSession, root: str, meta: dict) -> None:
    fs.write_text(spark, f"{root}/_meta.json", json.dumps(meta, sort_keys=True))


def _write_segment(df: DataFrame, root: str, version: int, partition_by=()) -> tuple[str, int]:
    """Write one segment; returns (path, rows written). The row count is
    observed on the write itself (metrics of successful write tasks), so
    no second pass over the new files is needed."""
    seg = f"{root}/seg-{version:08d}-{uuid.uuid4().hex[:8]}"
    obs = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").option("parquet.block.size", ROW_GROUP_BYTES)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(seg)
    return seg, int(obs.get["n"])


def _cluster(df: DataFrame, meta: dict) -> DataFrame:
    keys = meta.get("cluster_by") or []
    if not keys:
        return df
    # Range partitioning on the keys gives each output file a narrow key
    # range, so min/max statistics let later scans skip files. The row hash
    # after the keys lets one hot key value span several files.
    return range_layout(df, keys)


def range_layout(df: DataFrame, keys, n: int | None = None) -> DataFrame:
    """Range partitions on ``keys`` plus a deterministic row hash as a
    tie-breaker (equal keys may be split across partitions), sorted inside
    each partition by the keys."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranged = df.withColumn("_tie", tie)
    ranged = (ranged.repartitionByRange(n, *keys, "_tie") if n else ranged.repartitionByRange(*keys, "_tie"))
    return ranged.sortWithinPartitions(*keys).drop("_tie")


def write_version(df: DataFrame, root: str, operation: str = "WRITE", ts: _dt.datetime | None = None,
                  mode: str = "overwrite", partition_by=(), prepared: bool = False, keep=None) -> int:
    """Write ``df`` as the next version of the table at ``root``.

    ``mode="append"`` adds a segment to the current version's segments,
    ``"overwrite"`` replaces them (but for those in ``keep``, which stay as
    they are). Returns the new version number.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    meta = read_meta(spark, root)
    cur = latest(spark, root)
    version = 0 if cur is None else cur.version + 1
    data = df if prepared else _cluster(df, meta)
    seg, new_rows = _write_segment(data, root, version, partition_by or meta.get("partition_by", ()))
    files, nbytes = fs.size_of(spark, seg)
    kept = set(keep or ())
    old = [] if cur is None else [x for x in cur.segments if mode == "append" or x in kept]
    known = {} if cur is None else segment_sizes(spark, cur, old)
    sizes = [known[x] for x in old] + [[new_rows, files, nbytes]]
    n_rows, files, nbytes = (sum(x[i] for x in sizes) for i in range(3))
    columns = [*(meta.get("primary_keys") or []), *(meta.get("cluster_by") or [])]
    if columns:
        zones.write(spark, root, seg, dict.fromkeys(columns), data.schema)
    # stored with the version, so that no read has to open every file's footer
    fields = list(data.schema.fields)
    if mode == "append" and old and cur.schema:
        known = T.StructType.fromJson(json.loads(cur.schema)).fields
        fields = known + [f for f in fields if f.name not in {o.name for o in known}]
    _add_row(spark, root, (version, ts or _now(), operation, [*old, seg], n_rows, files, nbytes, T.StructType(fields).json(), sizes))
    return version


def segment_sizes(spark: SparkSession, row, segments) -> dict[str, list[int]]:
    """Rows, files and bytes of some segments of a version, from its manifest
    row; from the files themselves where an old manifest has no sizes."""
    if row.sizes is not None:
        known = dict(zip(row.segments, row.sizes))
        return {x: list(known[x]) for x in segments}
    return {x: [segments_of(spark, row, [x]).count(), *fs.size_of(spark, x)] for x in segments}


def _add_row(spark: SparkSession, root: str, row: tuple) -> None:
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_manifest")


def write_schema(spark: SparkSession, root: str, schema: T.StructType, operation: str,
                 ts: _dt.datetime | None = None) -> int:
    """A new version of the same segments that shows other columns; no data
    is written."""
    cur = latest(spark, root)
    _add_row(spark, root, (cur.version + 1, ts or _now(), operation, list(cur.segments), cur.n_rows, cur.n_files,
                           cur.n_bytes, schema.json(), cur.sizes))
    return cur.version + 1


def segments_of(spark: SparkSession, row, segments) -> DataFrame:
    """Rows of some segments of a version, with the version's columns."""
    schema = T.StructType.fromJson(json.loads(row.schema)) if row.schema else None
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(*segments)


def read_as_of(spark: SparkSession, root: str, ts: _dt.datetime | None = None,
               version: int | None = None) -> DataFrame:
    """The table as of a timestamp (newest version with ``ts <= t``) or
    as of a version number; the latest version when neither is given."""
    row = version_row(spark, root, ts, version)
    return segments_of(spark, row, row.segments)


def version_row(spark: SparkSession, root: str, ts: _dt.datetime | None = None, version: int | None = None):
    """The manifest row that ``read_as_of`` reads."""
    m = manifest(spark, root)
    if version is not None:
        m = m.filter(F.col("version") == version)
    elif ts is not None:
        m = m.filter(F.col("ts") <= F.lit(ts))
    rows = m.orderBy(F.col("version").desc()).limit(1).collect()
    if not rows:
        raise LookupError(f"no version of {root} matches version={version} ts={ts}")
    row = rows[0]
    if row.version in expired_versions(spark, root):
        raise LookupError(f"version {row.version} of {root} was expired")
    return row


def history(spark: SparkSession, root: str) -> DataFrame:
    """Version history, newest last."""
    exp = f"{root}/_expired"
    m = manifest(spark, root).drop("schema", "sizes")
    if fs.exists(spark, exp):
        e = spark.read.schema(EXPIRED_SCHEMA).parquet(exp).select("version", F.lit(True).alias("_x"))
        m = m.join(e, "version", "left")
        m = m.withColumn("expired", F.coalesce(F.col("_x"), F.lit(False))).drop("_x")
    else:
        m = m.withColumn("expired", F.lit(False))
    return m.orderBy("version")
