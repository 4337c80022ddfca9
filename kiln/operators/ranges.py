"""Rows in key ranges: the base of dense numbering, rolling windows and
as-of joins that no single key or value can put into one task.

Ranges come from Spark's own range partitioning, so they follow the data
(a key with a third of all rows spans a third of the ranges), take any
sortable type, and keep nulls (first). They are written once to the shared
folder: every later step sees the same ranges, also after lost executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import scratch_path

#: Rows of a range are numbered in the low bits of Spark's row id.
LOW_BITS = 33


def ranged(df: DataFrame, order, parts: int | None = None) -> DataFrame:
    """``df`` with ``_p`` (number of the range, growing with ``order``) and
    ``_loc`` (1-based position within the range)."""
    spark = df.sparkSession
    order = [order] if isinstance(order, str) else list(order)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("_m", F.monotonically_increasing_id()).write.parquet(path))
    return spark.read.schema(df.withColumn("_m", F.lit(0).cast("long")).schema).parquet(path).select(
        *[F.col(f"`{c}`") for c in df.columns], F.shiftright("_m", LOW_BITS).alias("_p"),
        (F.col("_m").bitwiseAND(F.lit((1 << LOW_BITS) - 1)) + 1).alias("_loc"))


def numbered(df: DataFrame, order, out: str, parts: int | None = None) -> DataFrame:
    """Dense 1..n in ``order``: the position in the range plus the rows of
    all earlier ranges (a table of one row per range)."""
    r = ranged(df, order, parts)
    counts = r.groupBy("_p").agg(F.count(F.lit(1)).alias("_t"))
    before = counts.select("_p", (F.sum("_t").over(Window.orderBy("_p")) - F.col("_t")).alias("_off"))
    return r.join(before, "_p").withColumn(out, F.col("_off") + F.col("_loc")).drop("_p", "_loc", "_off")


def rolling(df: DataFrame, keys, order, c: str, n: int, out: str, parts: int | None = None) -> DataFrame:
    """Mean of ``c`` over the last ``n`` rows per key (null until ``n`` values
    that are not null are in the window).

    Windows run inside (key, range). The last ``n - 1`` rows of a key's range
    are also given to the ranges that follow and still reach back to them, so
    the extra rows are at most ``n - 1`` per key and range.
    """
    keys, order = list(keys), list(order)
    if n < 2:
        return df.withColumn(out, F.col(c).cast("double"))
    r = ranged(df, [*keys, *order], parts)
    counts = r.groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_loc").alias("_first"))
    by_key = Window.partitionBy(*keys).orderBy("_p")
    spans = counts.withColumn("_off", F.sum("_c").over(by_key) - F.col("_c"))
    later = F.collect_list(F.struct("_p", "_off")).over(by_key.rowsBetween(1, n - 1))
    spans = spans.withColumn("_later", later)
    # null keys are equal here, as in the windows
    spans = spans.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_p").alias("_kp"), "_c", "_first",
                         "_off", "_later")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    at = r.join(spans, match & (F.col("_p") == F.col("_kp"))).select(
        *keys, "_p", (F.col("_off") + F.col("_loc") - F.col("_first") + 1).alias("_i"), F.col(c).alias("_v"),
        F.struct(*[F.col(f"`{x}`") for x in df.columns]).alias("_row"), "_off", "_c", "_later")
    tail = at.filter(F.col("_i") > F.col("_off") + F.col("_c") - (n - 1))
    halo = tail.select(*keys, "_i", "_v", F.explode(F.filter("_later", lambda q: F.col("_i") >= q["_off"] - (n - 2))).alias("_q")
                       ).select(*keys, F.col("_q._p").alias("_p"), "_i", "_v",
                                F.lit(None).cast(at.schema["_row"].dataType).alias("_row"))
    both = at.select(*keys, "_p", "_i", "_v", "_row").unionByName(halo)
    w = Window.partitionBy(*keys, "_p").orderBy("_i").rowsBetween(-(n - 1), 0)
    mean = F.when(F.count("_v").over(w) == n, F.avg("_v").over(w))
    return both.withColumn("_mean", mean).filter(F.col("_row").isNotNull()).select("_row.*", F.col("_mean").alias(out))

