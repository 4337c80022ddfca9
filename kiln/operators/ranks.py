"""Dictionaries and ranks of column values without collecting them.

Values are counted first (with partial sums), the counts are put into key ranges
and numbered there, and the numbers are joined back to the rows. A value that
many rows share cannot fill one task: the *hot* ones (at most four per shuffle
partition, by the share of the rows that makes them hot) are joined by a
broadcast of that bound, all others by their value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.ranges import ranged

#: A value with more than 1 / (HOT * partitions) of the rows is hot.
HOT = 4


def looked_up(df: DataFrame, entries: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """``df`` left-joined with ``entries`` (one per value of ``keys``, no nulls;
    ``count`` rows of ``df`` each, ``total`` in all). Hot entries are
    broadcast: there are at most ``HOT`` per shuffle partition."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = [c for c in entries.columns if c not in keys and c != count]
    hot = entries.filter(F.col(count) * (HOT * n) > total).select(*keys, F.struct(*found).alias("_lk_hot"))
    cold = entries.filter(F.col(count) * (HOT * n) <= total).select(*keys, F.struct(*found).alias("_lk_cold"))
    first = df.join(F.broadcast(hot), keys, "left")
    # rows that are found leave the shuffle's hot keys: their key there is null
    spare = [F.when(F.col("_lk_hot").isNull(), F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    match = [F.col(f"_k{i}") == F.col(f"_e{i}") for i in range(len(keys))]
    cold = cold.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], "_lk_cold")
    rows = first.select("*", *spare)
    done = rows.filter(F.col("_lk_hot").isNotNull()).withColumn("_lk_cold", F.lit(None).cast(cold.schema["_lk_cold"].dataType))
    rest = rows.filter(F.col("_lk_hot").isNull()).join(cold, match, "left")
    both = done.select(*df.columns, "_lk_hot", "_lk_cold").unionByName(rest.select(*df.columns, "_lk_hot", "_lk_cold"))
    return both.select(*df.columns, *[F.coalesce(F.col("_lk_hot")[c], F.col("_lk_cold")[c]).alias(c) for c in found])


def dictionary(df: DataFrame, c: str, out: str = "index") -> DataFrame:
    """(value, n, index): the values of a column numbered from 0 by falling
    frequency, ties by value; nulls are no value."""
    counts = df.select(F.col(c).alias("value")).na.drop().groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    placed = ranged(counts.withColumn("_falling", -F.col("n")), ["_falling", "value"])
    per = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_t"))
    before = per.select("_p", (F.sum("_t").over(Window.orderBy("_p")) - F.col("_t")).alias("_off"))   # a row per range
    return placed.join(before, "_p").select("value", "n", (F.col("_off") + F.col("_loc") - 1).alias(out))


def index_values(df: DataFrame, c: str, out: str) -> DataFrame:
    """M8 for columns of very many values: ``df`` with the number of the value
    (a double, as the indexer stage gives; null stays null). The labels never
    reach the driver."""
    entries = dictionary(df, c, out).withColumn(out, F.col(out).cast("double")).withColumnRenamed("value", c)
    total = df.filter(F.col(c).isNotNull()).count()
    return looked_up(df, entries.withColumnRenamed("n", "_n"), [c], "_n", total)


def value_ranks(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n, rank): the average rank (from 1) of every value of
    each column, in one plan for all columns. Nulls are no values."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols]))
    counts = df.select(cells.alias("_")).select("_.*").na.drop().groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = ranged(counts, ["column", "value"])
    per = placed.groupBy("column", "_p").agg(F.sum("n").alias("_t"))
    by = Window.partitionBy("column").orderBy("_p")                              # a row per range
    before = per.select("column", "_p", (F.sum("_t").over(by) - F.col("_t")).alias("_off"))
    inside = Window.partitionBy("column", "_p").orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
    rank = F.col("_off") + F.sum("n").over(inside) - (F.col("n") - 1) / 2
    return placed.join(before, ["column", "_p"]).select("column", "value", "n", rank.alias("rank"))


def rank_corr(df: DataFrame, cols: list[str]) -> DataFrame:
    """A8 by ranks: Spearman's r (average ranks for ties) of every unordered
    pair, (a, b, r), over the rows without a null in ``cols``. Every cell (row,
    column) looks its rank up once, whatever the number of pairs."""
    clean = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).na.drop()
    ranks = value_ranks(clean, cols)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols]))
    long = clean.withColumn("_row", F.monotonically_increasing_id()).select("_row", cells.alias("_")).select("_row", "_.*")
    total = long.count()
    wide = looked_up(long, ranks, ["column", "value"], "n", total).groupBy("_row").agg(
        *[F.max(F.when(F.col("column") == c, F.col("rank"))).alias(f"r{i}") for i, c in enumerate(cols)])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    one = wide.agg(*[F.corr(f"r{i}", f"r{j}").alias(f"c{i}_{j}") for i, j in pairs])
    return one.select(F.inline(F.array(*[F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.col(f"c{i}_{j}").alias("r"))
                                         for i, j in pairs])))
