"""Timing harness (Y6, Y7): the same work timed several ways.

Every timed callable returns a DataFrame, which is run to completion into
the ``noop`` sink, so the timing covers the whole job (not just planning,
and without collecting rows to the driver). One warm-up run, then the
median of ``runs``; caches are cleared before each run.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_noop(df: DataFrame) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def time_query(spark: SparkSession, fn: Callable[[], DataFrame], runs: int = 5, warmup: int = 1) -> dict:
    for _ in range(warmup):
        run_noop(fn())
    times = []
    for _ in range(runs):
        spark.catalog.clearCache()
        times.append(run_noop(fn()))
    return {"median_s": statistics.median(times), "min_s": min(times), "max_s": max(times), "runs": runs}


def timed(spark: SparkSession, fns: dict[str, Callable[[], DataFrame]], runs: int = 5,
          warmup: int = 1, inputs: dict[str, str] | None = None) -> DataFrame:
    """One row per named callable: (name, median_s, min_s, max_s, runs,
    files, bytes); files and bytes are those under ``inputs[name]`` (a
    path), when given."""
    from kiln.sources import fs
    rows = []
    for name, fn in fns.items():
        t = time_query(spark, fn, runs, warmup)
        files = nbytes = None
        if inputs and name in inputs:
            files, nbytes = fs.size_of(spark, inputs[name])
        rows.append((name, t["median_s"], t["min_s"], t["max_s"], t["runs"], files, nbytes))
    return spark.createDataFrame(
        rows, "name string, median_s double, min_s double, max_s double, runs int, files int, bytes bigint")


def layout_report(spark: SparkSession, query: Callable[[], DataFrame], job: Callable[[], object],
                  stats: Callable[[], dict], runs: int = 5, warmup: int = 1) -> DataFrame:
    """Time ``query`` and read file stats, run the layout ``job``, time
    and measure again. Rows: (metric, before, after, pct_change)."""
    before_t = time_query(spark, query, runs, warmup)["median_s"]
    before = stats()
    job()
    after_t = time_query(spark, query, runs, warmup)["median_s"]
    after = stats()
    rows = [("query_median_s", before_t, after_t), ("files", float(before["files"]), float(after["files"])),
            ("bytes", float(before["bytes"]), float(after["bytes"]))]
    out = [(m, b, a, (a - b) / b * 100.0 if b else None) for m, b, a in rows]
    return spark.createDataFrame(out, "metric string, before double, after double, pct_change double")


def scan_gain(before: DataFrame, after: DataFrame, predicate: str) -> DataFrame:
    """Y6 from the scans instead of the clock: (metric, before, after) of two
    layouts of the same rows: their files, the files that hold rows of the
    predicate, and those rows. One scan of each, of the predicate's columns."""
    def one(df, name):
        rows = df.select(F.expr(predicate).alias("hit"), F.col("_metadata.file_path").alias("file"))
        per = rows.groupBy("file").agg(F.count_if("hit").alias("k"))
        return per.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("k") > 0).alias("files_met"),
                       F.coalesce(F.sum("k"), F.lit(0)).alias("rows_met")).withColumn("side", F.lit(name))

    both = one(before, "before").unionByName(one(after, "after"))
    long = both.select("side", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v"))
                                                  for m in ("files", "files_met", "rows_met")])))
    return long.groupBy("metric").pivot("side", ["before", "after"]).agg(F.max("v"))
