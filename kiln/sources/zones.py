"""Zone maps: the least and greatest value of some columns per data file.

A segment's zones are one small table, ``root/_zones/<segment>``, written with
the segment from its own columns only. ``met`` tells which segments a set of
keys can lie in, before any of their data is read: the keys are reduced to the
bounds of at most ``CUTS`` ranges, in one pass, and these are compared with the
files' bounds. It never misses a segment; a segment without zones counts as met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.sources import fs

#: Ranges that a set of keys is reduced to, at most.
CUTS = 512
#: Types that have an order and can be written down as a literal.
ORDERED = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DoubleType, T.FloatType, T.DecimalType)


def name_of(segment: str) -> str:
    return segment.rstrip("/").rsplit("/", 1)[-1]


def write(spark: SparkSession, root: str, segment: str, columns, schema: T.StructType) -> None:
    """Zones of a new segment for the ``columns`` that have an order."""
    cols = [c for c in columns if c in schema.names and isinstance(schema[c].dataType, ORDERED)]
    if not cols:
        return
    rows = spark.read.schema(schema).parquet(segment)
    bounds = [f(F.col(f"`{c}`")).alias(f"{side}{i}") for i, c in enumerate(cols) for side, f in (("lo", F.min), ("hi", F.max))]
    (rows.select(*[F.col(f"`{c}`") for c in cols], F.col("_metadata.file_path").alias("_file")).groupBy("_file")
     .agg(F.count(F.lit(1)).alias("n_rows"), *bounds).withColumn("columns", F.array(*[F.lit(c) for c in cols]))
     .coalesce(1).write.mode("overwrite").parquet(f"{root}/_zones/{name_of(segment)}"))


def read(spark: SparkSession, root: str, segments) -> DataFrame | None:
    """(``_segment``, ``_file``, ``n_rows``, ``lo0``, ``hi0``, ..., ``columns``) of
    the segments that have zones; None if none has."""
    there = {path.rstrip("/").rsplit("/", 1)[-1] for path, _ in fs.list_dirs(spark, f"{root}/_zones")}
    have = [f"{root}/_zones/{name_of(s)}" for s in segments if name_of(s) in there]
    if not have:
        return None
    part = F.regexp_extract(F.input_file_name(), r"/_zones/([^/]+)/", 1)
    return spark.read.parquet(*have).withColumn("_segment", part)


def _bucket(x: Column, cuts: list, lo: int, hi: int) -> Column:
    """How many of the sorted ``cuts`` are at most ``x``, by halving."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi + 1) // 2
    return F.when(x >= F.lit(cuts[mid - 1]), _bucket(x, cuts, mid, hi)).otherwise(_bucket(x, cuts, lo, mid - 1))


def met(spark: SparkSession, root: str, segments, keys: DataFrame, columns) -> list[str]:
    """Segments with a file whose bounds some row of ``keys(columns)`` may lie in."""
    columns, zones = list(columns), read(spark, root, segments)
    if zones is None:
        return list(segments)
    files = zones.collect()                              # one row per file: metadata
    known = {r["_segment"] for r in files}
    use = [c for c in columns if all(c in r["columns"] for r in files)]
    if not use:
        return list(segments)
    at = {(r["_segment"], r["_file"], c): (r[f"lo{r['columns'].index(c)}"], r[f"hi{r['columns'].index(c)}"]) for r in files for c in use}
    cuts = sorted({lo for (_, _, c), (lo, _) in at.items() if c == use[0] and lo is not None})
    if len(cuts) > CUTS:
        cuts = [cuts[i * len(cuts) // CUTS] for i in range(CUTS)]
    bounds = [f(F.col(f"`{c}`")).alias(f"{side}{i}") for i, c in enumerate(use) for side, f in (("lo", F.min), ("hi", F.max))]
    spans = keys.groupBy(_bucket(F.col(f"`{use[0]}`"), cuts, 0, len(cuts)).alias("b")).agg(*bounds).collect()   # at most CUTS + 1

    def inside(segment, file):
        return any(all(s[f"lo{i}"] is not None and at[segment, file, c][0] is not None
                       and s[f"lo{i}"] <= at[segment, file, c][1] and at[segment, file, c][0] <= s[f"hi{i}"]
                       for i, c in enumerate(use)) for s in spans)

    hit = {r["_segment"] for r in files if inside(r["_segment"], r["_file"])}
    return [s for s in segments if name_of(s) in hit or name_of(s) not in known]
