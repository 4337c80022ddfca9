"""Connected components of a link table by alternating star contraction.

Large star links every larger neighbour of a node to its smallest neighbour;
small star links the smaller ones. Both keep connectivity and shrink paths;
after O(log^2 n) rounds every node is linked to the smallest of its
component only. A round is joins and aggregates on node ids: neighbourhoods
are never collected, so a hub is only a skewed join key. Every round is
written to the shared folder, which cuts the lineage there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import scratch_path

MAX_ROUNDS = 100


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of links ``(u, v)``."""
    if large:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        new = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        new = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return new.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)`` that is not the
    smallest of its component; both columns long, no nulls. Self-links and
    repeated links do not matter; an empty table gives an empty result."""
    def state(df):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1000003).alias("h")).first()
        return row["n"], row["h"]

    now = _written(links.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u != v").distinct(), "links")
    before = state(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        now = _written(_star(_star(now, True), False), "links")
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
