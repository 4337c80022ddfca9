"""Table layout jobs on versioned tables.

Each job reads the current version and writes a new one, so readers of
older versions are never disturbed; ``expire`` later removes files no
retained version references.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.exprs import bucket_by_cuts, interleave_bits
from kiln.sources import fs
from kiln.sources import snapshots as V
from kiln.sources import zones

DEFAULT_TARGET_BYTES = 128 * 1024 * 1024
MIN_RETENTION_HOURS = 168


class LayoutError(ValueError):
    pass


def _n_files(nbytes: int, target_bytes: int) -> int:
    return max(1, math.ceil(nbytes / max(1, target_bytes)))


#: Bytes of files that one task of a range layout reads, but for row groups that
#: are larger. It holds their rows unpacked, many times as large, until they are dealt.
SPLIT_BYTES = 16 * 1024 * 1024
_MIN_SPLITS = "spark.sql.files.minPartitionNum"


@contextlib.contextmanager
def fine_splits(spark: SparkSession, nbytes: int):
    """Reads of ``nbytes`` that start inside are split into tasks of about
    ``SPLIT_BYTES`` (never into fewer than without); the setting is put back."""
    was = spark.conf.get(_MIN_SPLITS, None)
    least = was or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
    spark.conf.set(_MIN_SPLITS, str(max(int(least), _n_files(nbytes, SPLIT_BYTES))))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_MIN_SPLITS)
        else:
            spark.conf.set(_MIN_SPLITS, was)


def compact(spark: SparkSession, root: str, target_bytes: int = DEFAULT_TARGET_BYTES,
            ts: _dt.datetime | None = None) -> int:
    """Rewrite the segments whose files are small (under half of
    ``target_bytes`` on average) into files of about that size; others stay.
    ``coalesce`` merges input splits without a shuffle; a clustered table is
    re-clustered, and a partitioned one is dealt by its partition columns, so
    that each partition gets few files."""
    cur = V.latest(spark, root)
    meta = V.read_meta(spark, root)
    small, nbytes = [], 0
    for seg in cur.segments:
        files, size = fs.size_of(spark, seg)
        if files > 1 and size < files * target_bytes / 2 or files == 1 and size < target_bytes / 2:
            small.append(seg)
            nbytes += size
    if len(small) == 1 and fs.size_of(spark, small[0])[0] == 1:
        small = []                                      # one small file is as good as it gets
    if not small:
        return cur.version
    df = V.segments_of(spark, cur, small)
    n = _n_files(nbytes, target_bytes)
    parts = meta.get("partition_by") or []
    if meta.get("cluster_by"):
        out = V.range_layout(df, meta["cluster_by"], n)
    elif parts:
        # n tasks share the partitions; a partition larger than a task's share spans several
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(max(1, n)))
        sizes = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_k"))
        share = F.greatest(F.lit(1), F.ceil(F.col("_k") * n / F.lit(max(1, df.count()))))
        out = (df.join(sizes, parts).withColumn("_s", F.pmod(salt, share)).repartition(n, *parts, "_s").drop("_k", "_s")
               .select(*df.columns))
    else:
        out = df.coalesce(n)
    return V.write_version(out, root, "OPTIMIZE", ts, prepared=True, keep=[x for x in cur.segments if x not in small])


def expire(spark: SparkSession, root: str, hours: float = MIN_RETENTION_HOURS,
           now: _dt.datetime | None = None, dry_run: bool = True, force: bool = False) -> list[str]:
    """Y2: remove segments that only versions older than ``hours`` use.
    The current version is never touched. Retention under the default
    (e.g. 0 hours, which ends time travel) needs ``force=True``. Returns
    the segment paths removed (or that would be, on a dry run)."""
    if hours < MIN_RETENTION_HOURS and not force:
        raise LayoutError(f"retention {hours}h is under {MIN_RETENTION_HOURS}h; pass force=True")
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    cutoff = now - _dt.timedelta(hours=hours)
    rows = V.manifest(spark, root).select("version", "ts", "segments").collect()  # one row per version
    if not rows:
        return []
    current = max(r.version for r in rows)
    already = V.expired_versions(spark, root)
    keep = {r.version for r in rows if r.version == current or r.ts >= cutoff}
    drop = {r.version for r in rows} - keep - already
    live = {s for r in rows if r.version in keep for s in r.segments}
    dead = {s for r in rows if r.version in drop for s in r.segments} - live
    # segments no manifest row names (a write that failed before its
    # manifest row landed), once older than the cutoff
    named = {_norm(s) for r in rows for s in r.segments}
    cutoff_ms = (cutoff - _dt.datetime(1970, 1, 1)).total_seconds() * 1000
    for path, mtime in fs.list_dirs(spark, root):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if name.startswith("seg-") and _norm(path) not in named and mtime < cutoff_ms:
            dead.add(path)
    dead = sorted(dead)
    if not dry_run:
        for seg in dead:
            fs.delete(spark, seg)
        if drop:
            spark.createDataFrame([(v, now) for v in sorted(drop)], V.EXPIRED_SCHEMA).coalesce(1) \
                .write.mode("append").parquet(f"{root}/_expired")
    return dead


def _norm(path: str) -> str:
    """Compare paths without scheme and trailing slash (file:/x vs /x)."""
    p = path.rstrip("/")
    for pre in ("file://", "file:"):
        if p.startswith(pre):
            return p[len(pre):]
    return p


def z_value(cols, cuts: dict, bits: int | None = None, equal: bool = False) -> Column:
    """Z-order value from fixed cut points per column: the bucket of each
    column (number of its cuts <= value) with bits interleaved. With
    ``equal`` the buckets of every column are spread over the same ``bits``,
    so a column with few values does not lose its share of the high bits."""
    bits = bits or max(1, max(math.ceil(math.log2(len(cuts[c]) + 1)) for c in cols))
    buckets = [bucket_by_cuts(c, cuts[c]) for c in cols]
    if equal:
        top = 2 ** bits - 1
        buckets = [F.floor(b * F.lit(top) / F.lit(max(1, len(set(cuts[c]))))) for b, c in zip(buckets, cols)]
    return interleave_bits([F.coalesce(b, F.lit(0)) for b in buckets] if equal else buckets, bits)


def sort_key(df: DataFrame, c: str) -> Column:
    """A double that orders like the column: numbers as they are, dates and
    times by their seconds, text by its first six bytes."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.DateType):
        return F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = F.hex(F.substring(F.col(c).cast("binary"), 1, 6))
        return F.conv(F.rpad(raw, 12, "0"), 16, 10).cast("double")
    return F.col(c).cast("double")


def zorder_cuts(df: DataFrame, cols, bits: int = 8, rel_err: float = 0.001) -> dict:
    """Cut points per column from approximate quantiles: at most
    ``2^bits - 1`` numbers per column reach the driver."""
    k = 2 ** bits
    probs = [i / k for i in range(1, k)]
    qs = df.approxQuantile(list(cols), probs, rel_err)
    return {c: sorted(set(q)) for c, q in zip(cols, qs)}


#: A z-ordered segment joins a rewrite if it is at most so many times as large
#: as what is rewritten anyway: old rows are written again only when the table
#: has grown by a share of them, so a row is written O(log table) times.
MERGE_FACTOR = 2.0


def zorder(spark: SparkSession, root: str, cols, bits: int = 8, target_bytes: int = DEFAULT_TARGET_BYTES,
           ts: _dt.datetime | None = None, recut: bool = False) -> int:
    """Rewrite so rows close in all of ``cols`` (numbers, dates, times or
    text) share files: range partitions on the z-value, sorted inside.

    The first run z-orders the whole version and stores its cut points. Later
    runs with the same columns rewrite only what came since, by the same cut
    points, and those z-ordered segments that are small beside it and whose
    z-values overlap; other narrow segments stay. ``recut`` starts anew (data
    may have moved away from the cut points). Y5: refused on a clustered table."""
    meta = V.read_meta(spark, root)
    if meta.get("cluster_by"):
        raise LayoutError("z-order is not allowed on a table with clustering keys")
    cur = V.latest(spark, root)
    spec = meta.get("zorder") or {}
    if recut or spec.get("cols") != list(cols) or spec.get("bits") != bits:
        spec = {"cols": list(cols), "bits": bits, "cuts": None, "ranges": {}}
    narrow = [s for s in cur.segments if zones.name_of(s) in spec["ranges"]]
    todo = [s for s in cur.segments if s not in narrow]
    if not todo:
        return cur.version
    size = {s: x[2] for s, x in V.segment_sizes(spark, cur, cur.segments).items()}

    def keyed(segments):
        df = V.segments_of(spark, cur, segments)
        return df, df.select("*", *[sort_key(df, c).alias(f"_z{i}") for i, c in enumerate(cols)])

    names = [f"_z{i}" for i in range(len(cols))]
    df, rows = keyed(todo)
    cuts = spec["cuts"] or zorder_cuts(rows.select(*names), names, bits)
    z = z_value(names, cuts, bits, equal=True)
    lo, hi = rows.agg(F.min(z), F.max(z)).first()
    work = sum(size[s] for s in todo)
    for s in sorted(narrow, key=size.get):
        a, b = spec["ranges"][zones.name_of(s)]
        if lo is not None and size[s] <= MERGE_FACTOR * work and a <= hi and lo <= b:
            todo, work, lo, hi = [*todo, s], work + size[s], min(lo, a), max(hi, b)
    if len(todo) > len(cur.segments) - len(narrow):
        df, rows = keyed(todo)
    out = V.range_layout(rows.withColumn("_z", z), ["_z"], _n_files(work, target_bytes)).drop("_z", *names)
    kept = [s for s in cur.segments if s not in todo]
    with fine_splits(spark, work):
        version = V.write_version(out, root, "ZORDER", ts, prepared=True, keep=kept)
    made = zones.name_of(V.latest(spark, root).segments[-1])
    ranges = {n: r for n, r in spec["ranges"].items() if n in {zones.name_of(s) for s in kept}}
    # noted after the version: a run that fails here leaves a segment that is only ordered again
    V.write_meta(spark, root, {**meta, "zorder": {**spec, "cuts": cuts, "ranges": {**ranges, made: [lo or 0, hi or 0]}}})
    return version


def cluster_by(spark: SparkSession, root: str, cols) -> None:
    """Store clustering keys; every later write (append, merge,
    compaction) range-partitions and sorts its new files on them."""
    meta = V.read_meta(spark, root)
    meta["cluster_by"] = list(cols)
    V.write_meta(spark, root, meta)


def file_stats(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """Files and bytes of a version."""
    rows = V.manifest(spark, root)
    row = (rows.filter(F.col("version") == version) if version is not None
           else rows.orderBy(F.col("version").desc())).first()
    return {"version": row.version, "files": row.n_files, "bytes": row.n_bytes}
