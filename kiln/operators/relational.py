"""Relational operators: projections, filters, joins, aggregates, windows,
sorting, set operations and splits (P*, J*, A*, W*, T*, U*, R*).

Everything is a declarative DataFrame plan, so Catalyst prunes columns,
pushes filters into the Parquet scan and combines partial aggregates
before the shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, MapType, NumericType, StringType, StructType

from kiln.functions.exprs import (col_of, fold_of, is_integral, split_bucket,
                                  split_threshold, within_tolerance)
from kiln.operators.ranges import numbered, ranged, rolling
from kiln.session import scratch_path

# ---------------------------------------------------------------- P: rows


def project(df: DataFrame, cols) -> DataFrame:
    """P1."""
    return df.select(*cols)


def project_except(df: DataFrame, cols) -> DataFrame:
    """Every column but ``cols``."""
    drop = set(cols)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in drop])


_OPS = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "=": "__eq__",
        "==": "__eq__", "!=": "__ne__"}


def filter_cmp(df: DataFrame, c: str, op: str, k) -> DataFrame:
    """``c <op> k`` (pushed into the scan as a Parquet filter)."""
    return df.filter(getattr(F.col(c), _OPS[op])(F.lit(k)))


def filter_expr(df: DataFrame, text: str) -> DataFrame:
    """Predicate as SQL text."""
    return df.filter(text)


def derive(df: DataFrame, **exprs) -> DataFrame:
    """P5: add or replace columns in one projection."""
    return df.withColumns({k: col_of(v) if isinstance(v, str) else v for k, v in exprs.items()})


def drop_if_exists(df: DataFrame, *cols) -> DataFrame:
    """Missing names are not an error."""
    return df.drop(*cols)


def bin_by(df: DataFrame, c: str, cuts, labels, out: str) -> DataFrame:
    """``labels[i]`` for ``cuts[i-1] <= c < cuts[i]``; null stays null."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label more than cut points")
    x = F.col(c)
    expr = F.when(x.isNull(), F.lit(None).cast(StringType()))
    for cut, lab in zip(cuts, labels[:-1]):
        expr = expr.when(x < F.lit(cut), F.lit(lab))
    return df.withColumn(out, expr.otherwise(F.lit(labels[-1])))


def encode_binary(df: DataFrame, cond, out: str) -> DataFrame:
    """1 where ``cond`` holds, else 0 (null counts as 0)."""
    cond = F.expr(cond) if isinstance(cond, str) else cond
    return df.withColumn(out, F.when(cond, 1).otherwise(0).cast(IntegerType()))


def cast_all(df: DataFrame, type: str = "double", on_error: str = "null") -> DataFrame:  # noqa: A002
    """P10: cast every column; text that does not parse becomes null
    (``on_error="null"``) or raises (``"raise"``)."""
    def cast(c):
        x = F.col(f"`{c}`")
        return x.try_cast(type) if on_error == "null" else x.cast(type)
    return df.select(*[cast(c).alias(c) for c in df.columns])


def numeric_columns(df: DataFrame, types=None) -> list[str]:
    """Names of columns whose type is one of ``types`` (default: all
    numeric types)."""
    if types is None:
        return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    return [f.name for f in df.schema if any(isinstance(f.dataType, t) for t in types)]


def clean_names(df: DataFrame, char: str = ".") -> DataFrame:
    """Strip ``char`` from column names."""
    return df.withColumnsRenamed({c: c.replace(char, "") for c in df.columns if char in c})


def with_row_id(df: DataFrame, out: str = "ID", order_by=None, partitions: int | None = None) -> DataFrame:
    """A 64-bit row id.

    Without ``order_by``: unique, not dense (``monotonically_increasing_id``).
    With ``order_by`` (any sortable columns): dense 1..n in key order, null
    keys first, computed over key ranges; no single-task window. The number
    of ranges never changes the ids of a unique key.
    """
    if order_by is None:
        return df.withColumn(out, F.monotonically_increasing_id())
    return numbered(df, order_by, out, partitions)


def with_month(df: DataFrame, c: str, out: str) -> DataFrame:
    """P14."""
    return df.withColumn(out, F.month(c))


def with_within(df: DataFrame, pred: str, actual: str, tol: float = 0.1,
                out: str = "accuracy") -> DataFrame:
    """Relative error below ``tol``; null where ``actual`` is 0."""
    return df.withColumn(out, within_tolerance(pred, actual, tol))


def pack(df: DataFrame, cols, out: str, keep: bool = False) -> DataFrame:
    """Pack columns into one struct column."""
    res = df.withColumn(out, F.struct(*cols))
    return res if keep else res.drop(*cols)


def drop_nulls(df: DataFrame, cols=None) -> DataFrame:
    """Drop rows with a null in any of ``cols`` (default all)."""
    return df.na.drop(how="any", subset=cols)


# ---------------------------------------------------------------- J: joins


def join_inner(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Equi-join on same-named keys, each key kept once. The strategy
    (broadcast vs sort-merge) is left to Catalyst and AQE, which broadcast
    a side only when its measured size is under the threshold."""
    return left.join(right, keys, "inner")


def join_left(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """J2."""
    return left.join(right, keys, "left")


def join_cast(left: DataFrame, right: DataFrame, key: str, type: str | None = None,  # noqa: A002
              how: str = "inner") -> DataFrame:
    """The key is cast explicitly to the typed side before joining,
    never compared across types implicitly."""
    target = type or left.schema[key].dataType.simpleString()
    if right.schema[key].dataType.simpleString() != target:
        right = right.withColumn(key, F.col(key).cast(target))
    if left.schema[key].dataType.simpleString() != target:
        left = left.withColumn(key, F.col(key).cast(target))
    return left.join(right, key, how)


#: Right rows per cut of the as-of index, and the most cuts it has (they are
#: broadcast: some tens of bytes each).
ASOF_ROWS = 256
ASOF_CUTS = 1_000_000
#: Cuts a left row looks at in one step: each step copies so many into its row, however many cuts there are.
ASOF_FAN = 64


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, MapType)


def _last_not_above(size: Column, above, steps: int) -> Column:
    """Greatest i in [0, size) of which ``above(i)`` is false (-1: none), by
    halving; ``above`` is false up to some i and true after it."""
    def step(at, by):
        return F.when((at + by < size) & ~F.coalesce(above(at + by), F.lit(True)), at + by).otherwise(at)
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(steps, -1, -1)]), F.lit(-1), step)


def join_asof(left: DataFrame, right: DataFrame, keys, ts: str, cols=None, right_ts: str | None = None,
              tolerance: str | None = None, parts: int | None = None, prefix: str = "") -> DataFrame:
    """Point-in-time lookup. For every left row, the right row with the
    same keys and the greatest ``right_ts <= ts`` (an equal time matches; of
    equal times the greatest features). Rows with a null key or time match
    nothing; every left row is kept.

    Only the right side is indexed: its rows, in ranges of (keys, time) written
    once, cut every ``ASOF_ROWS`` rows. The first (keys, time) of every
    cut, a table of at most ``ASOF_CUTS`` rows, is broadcast as a tree of blocks of
    ``ASOF_FAN``; a left row finds its cut block by block, by halving, and joins it
    on (keys, cut), where the match is found by halving again. So the left side is read once, shuffled once and never
    stored or sorted on what it carries; a hot key spans as many cuts as it has
    right rows, and many left rows of one cut are an ordinary skewed join. The
    matched right row travels as one struct, so null feature values are kept as
    values, and features may be of any type.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    right_ts = right_ts or ts
    cols = list(cols) if cols is not None else [c for c in right.columns if c not in keys + [right_ts]]
    feat = F.struct(F.col(right_ts).alias("_ts"), *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    kinds = [f"_k{i}" for i in range(len(keys))]
    # the types in which both sides are compared
    both = [(left.schema[k].dataType, right.schema[k].dataType) for k in keys] + [(left.schema[ts].dataType, right.schema[right_ts].dataType)]
    common = left.sparkSession.range(1).select(*[F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias(f"c{i}")
                                                 for i, (a, b) in enumerate(both)]).schema.fields
    common = [f.dataType for f in common]
    r = right.na.drop(subset=keys + [right_ts]).select(
        *[F.col(k).cast(t).alias(n) for k, n, t in zip(keys, kinds, common)], F.col(right_ts).cast(common[-1]).alias("_t"), feat.alias("_f"))
    plain = _orderable(r.schema["_f"].dataType)
    r = r if plain else r.withColumn("_tie", F.to_json("_f"))
    r = ranged(r, [*kinds, "_t", "_f" if plain else "_tie"], parts)     # of equal times, the last one counts
    most = r.groupBy("_p").agg(F.count(F.lit(1)).alias("n"))
    total = most.agg(F.sum("n"), F.count(F.lit(1))).first()
    each = max(ASOF_ROWS, math.ceil((total[0] or 0) / ASOF_CUTS))
    most_cuts = (total[0] or 0) // each + total[1] + 2
    steps = [int(math.log2(n)) + 1 for n in (ASOF_FAN, each + 1)]           # of halving a block, the rows of a cut
    r = r.withColumn("_c", F.struct("_p", F.expr(f"(_loc - 1) div {each}").alias("_s")))
    firsts = r.filter(F.expr(f"(_loc - 1) % {each} = 0")).select(F.struct(*kinds, "_t").alias("at"), "_c")
    # one row of at most ASOF_CUTS entries, written as numbered rows
    path = scratch_path(left.sparkSession, "cuts")
    cuts = firsts.agg(F.array_sort(F.collect_list(F.struct("at", "_c"))).alias("_cuts")).select(
        F.posexplode("_cuts").alias("_n", "_e")).select("_n", "_e.*")
    cuts.write.parquet(path)
    cuts = left.sparkSession.read.schema(cuts.schema).parquet(path)
    if plain:
        sorted_items = F.array_sort(F.collect_list(F.struct("_t", "_f")))
    else:
        def order(a, b):
            return (F.when(a["_t"] < b["_t"], -1).when(a["_t"] > b["_t"], 1)
                    .when(a["_tie"] < b["_tie"], -1).when(a["_tie"] > b["_tie"], 1).otherwise(0))
        sorted_items = F.array_sort(F.collect_list(F.struct("_t", "_tie", "_f")), order)
    items = r.groupBy(*kinds, "_c").agg(sorted_items.alias("_items"))

    lcols = [c for c in left.columns if c not in keys]
    x = F.struct(*[F.col(k).cast(t).alias(n) for k, n, t in zip(keys, kinds, common)], F.col(ts).cast(common[-1]).alias("_t"))
    whole = F.lit(True)
    for c in [*keys, ts]:
        whole = whole & F.col(c).isNotNull()
    found = left.select(*keys, F.struct(*[F.col(c) for c in lcols]).alias("_l"), F.when(whole, x).alias("_x"))
    span = ASOF_FAN ** max(0, math.ceil(math.log(most_cuts, ASOF_FAN)) - 1)
    top = span
    while span:                                                     # blocks of every span-th cut; ASOF_CUTS bounds what is broadcast
        block = F.array_sort(F.collect_list(F.struct("at", F.expr(f"_n div {span}").alias("_b"), "_c"))).alias("_cuts")
        entries = cuts.filter(F.expr(f"_n % {span} = 0"))
        if span == top:
            found = found.join(F.broadcast(entries.agg(block)))
        else:
            found = found.join(F.broadcast(entries.groupBy(F.expr(f"_n div {span * ASOF_FAN}").alias("_b")).agg(block)), "_b", "left")
        i = _last_not_above(F.size("_cuts"), lambda k: F.get(F.col("_cuts"), k)["at"] > F.col("_x"), steps[0])
        entry = F.when(F.col("_x").isNotNull() & F.col("_cuts").isNotNull(), F.get(F.col("_cuts"), i))
        found = found.select(*keys, "_l", "_x", entry.alias("_e")).select(*keys, "_l", "_x", "_e._b", "_e._c")
        span //= ASOF_FAN
    found = found.select(*keys, "_l", F.col("_x._t").alias("_t"), "_c")
    match = (F.col("_c") == F.col("_rc"))
    for k, n in zip(keys, kinds):
        match = match & (F.col(k) == F.col(n))
    near = found.join(items.withColumnRenamed("_c", "_rc"), match, "left")
    j = _last_not_above(F.size("_items"), lambda k: F.get(F.col("_items"), k)["_t"] > F.col("_t"), steps[1])
    out = near.withColumn("_m", F.when(F.col("_items").isNotNull(), F.get(F.col("_items"), j)["_f"]))
    if tolerance:
        out = out.withColumn("_m", F.when(
            F.col("_m._ts") >= F.col("_t") - F.expr(f"INTERVAL {tolerance}"), F.col("_m")))
    return out.select(*keys, "_l.*", F.col("_m._ts").alias(f"{prefix}{right_ts}_matched"),
                      *[F.col(f"_m.{prefix}{c}").alias(f"{prefix}{c}") for c in cols])


# ---------------------------------------------------------------- A: aggregates


def count_rows(df: DataFrame, out: str = "n") -> DataFrame:
    """A1: row count as a one-row frame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def describe_numeric(df: DataFrame, cols=None) -> DataFrame:
    """A2: (column, n, mean, stddev, min, max) in long form, typed doubles,
    all columns in a single pass."""
    cols = cols or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast(DoubleType())
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"),
                     F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min"),
                     F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def mean_all(df: DataFrame, cols=None) -> DataFrame:
    """A3: ``avg_<col>`` for every numeric column, one pass."""
    cols = cols or numeric_columns(df, types=(DoubleType, IntegerType))
    return df.select(*[F.avg(f"`{c}`").alias(f"avg_{c}") for c in cols])


def group_count(df: DataFrame, keys, out: str = "n") -> DataFrame:
    """A4: partial counts per task, then one small shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def hit_rate(df: DataFrame, pred, out: str = "pct") -> DataFrame:
    """A5: percent of rows where ``pred`` is true, in one pass. A null
    predicate counts in the denominator, not in the numerator."""
    p = F.expr(pred) if isinstance(pred, str) else pred
    return df.agg(F.try_divide(F.lit(100.0) * F.count_if(p), F.count(F.lit(1))).alias(out))


def agg_max(df: DataFrame, c: str, by=(), out: str | None = None) -> DataFrame:
    """A6."""
    return df.groupBy(*by).agg(F.max(c).alias(out or f"max_{c}"))


#: Accuracy of the sketch that brackets an exact quantile.
BRACKET_ACCURACY = 10000
#: Distinct values of one column that are ranked in one task; a bracket that
#: holds more is narrowed again.
BRACKET_VALUES = 1_000_000


def exact_quantiles(df: DataFrame, cols, q: float = 0.5, accuracy: int = BRACKET_ACCURACY,
                    values: int = BRACKET_VALUES) -> DataFrame:
    """Exact, interpolated quantile of each column in ``cols``: (column,
    value); a column without values is left out.

    A mergeable sketch gives two values around the wanted rank. One more pass
    counts the values below them and keeps, per distinct value in between,
    its count (a partial aggregate, so a hot value costs nothing). A bracket
    with many distinct values is narrowed by another sketch. The data itself
    is never shuffled.
    """
    spark = df.sparkSession
    num = {c: F.col(f"`{c}`").cast(DoubleType()) for c in cols}
    stats = df.agg(*[F.count(num[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    state = {c: {"n": stats[i], "rank": (stats[i] - 1) * q + 1, "lo": float("-inf"), "hi": float("nan"), "below": 0,
                 "eps": 2.0 / accuracy} for i, c in enumerate(cols) if stats[i]}      # NaN is the largest double
    out = []
    while state:
        def inside(c):
            return num[c].between(F.lit(state[c]["lo"]), F.lit(state[c]["hi"]))

        aggs, todo = [], list(state)
        for i, c in enumerate(todo):
            s = state[c]
            size = s.get("size", s["n"])
            ends = [max(0.0, (math.floor(s["rank"]) - s["below"] - 1) / size - s["eps"]),
                    min(1.0, (math.ceil(s["rank"]) - s["below"]) / size + s["eps"])]
            aggs.append(F.percentile_approx(F.when(inside(c), num[c]), ends, accuracy).alias(f"b{i}"))
        cut = df.agg(*aggs).first()
        aggs = []
        for i, c in enumerate(todo):
            lo, hi = cut[i]
            v = num[c]
            mid = v.between(F.lit(lo), F.lit(hi))
            aggs += [F.count(F.when(v < F.lit(lo), 1)).alias(f"u{i}"), F.count(F.when(mid, 1)).alias(f"k{i}"),
                     F.approx_count_distinct(F.when(mid, v)).alias(f"d{i}")]
        found = df.agg(*aggs).first()
        ready, many = [], False
        for i, c in enumerate(todo):
            s, (lo, hi) = state[c], cut[i]
            below, size, distinct = found[3 * i:3 * i + 3]
            if below < math.floor(s["rank"]) and math.ceil(s["rank"]) <= below + size:
                narrower = size < s.get("size", s["n"] + 1)
                s.update(lo=lo, hi=hi, below=below, size=size)
                if distinct <= values or not narrower:
                    ready.append(c)
                    many |= distinct > values
            else:                                           # the sketch missed: a wider bracket, up to all values
                s["eps"] *= 8
        if ready:
            parts = [df.filter(inside(c)).select(F.lit(c).alias("column"), num[c].alias("v")) for c in ready]
            counts = reduce(lambda a, b: a.unionByName(b), parts).groupBy("column", "v").agg(F.count(F.lit(1)).alias("k"))
            per = [(c, state[c]["below"], float(math.floor(state[c]["rank"])), float(math.ceil(state[c]["rank"])),
                    state[c]["rank"] - math.floor(state[c]["rank"])) for c in ready]
            want = spark.createDataFrame(per, "column string, below long, a double, b double, part double")
            ranked = (_counted_by_range(counts) if many else counts.withColumn(
                "_upto", F.sum("k").over(Window.partitionBy("column").orderBy("v")))).join(want, "column").withColumn(
                "upto", F.col("below") + F.col("_upto"))

            def at(r):
                return F.max(F.when((F.col("upto") - F.col("k") < F.col(r)) & (F.col("upto") >= F.col(r)), F.col("v")))

            out.append(ranked.groupBy("column").agg(at("a").alias("x"), at("b").alias("y"), F.max("part").alias("part"))
                       .select("column", (F.col("x") + (F.col("y") - F.col("x")) * F.col("part")).alias("value")))
        for c in ready:
            del state[c]
    if not out:
        return spark.createDataFrame([], "column string, value double")
    return reduce(lambda a, b: a.unionByName(b), out)


def _counted_by_range(counts: DataFrame) -> DataFrame:
    """``counts(column, v, k)`` with the running sum of ``k`` per column, over key
    ranges: no task holds more values than its range."""
    placed = ranged(counts, ["column", "v"])
    per = placed.groupBy("column", "_p").agg(F.sum("k").alias("_t"))
    before = per.select("column", "_p", (F.sum("_t").over(Window.partitionBy("column").orderBy("_p")) - F.col("_t")).alias("_off"))
    inside = Window.partitionBy("column", "_p").orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("_s", F.sum("k").over(inside)).join(before, ["column", "_p"]).select(
        "column", "v", "k", (F.col("_off") + F.col("_s")).alias("_upto"))


def median_var(df: DataFrame, cols, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """(column, median, var) per column. ``exact=True`` ranks all
    columns in one distributed pass; ``exact=False`` uses
    ``percentile_approx``."""
    var = df.agg(*[F.var_samp(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    var_long = var.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("var")) for i, c in enumerate(cols)])))
    if exact:
        med_long = exact_quantiles(df, cols, 0.5).withColumnRenamed("value", "median")
    else:
        med = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), 0.5, accuracy)
                       .cast("double").alias(f"q{i}") for i, c in enumerate(cols)])
        med_long = med.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"q{i}").alias("median"))
            for i, c in enumerate(cols)])))
    return var_long.join(med_long, "column", "left").select("column", "median", "var")


def corr_pairs(df: DataFrame, cols) -> DataFrame:
    """Pearson r for every unordered pair of ``cols``, one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
                   for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)]
    return one.select(F.inline(F.array(*rows)))


def corr_matrix(df: DataFrame, cols, method: str = "pearson") -> DataFrame:
    """A8 as a matrix: (a, b, r) for every ordered pair, from
    ``ml.stat.Correlation`` (``pearson`` or ``spearman``; the rank-based
    one sorts distributedly). Only the p x p matrix reaches the driver."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    vec = VectorAssembler(inputCols=list(cols), outputCol="_x", handleInvalid="skip").transform(df)
    m = Correlation.corr(vec, "_x", method).first()[0].toArray()
    rows = [(a, b, float(m[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def group_agg(df: DataFrame, keys, aggs: dict) -> DataFrame:
    """``aggs`` maps output name -> aggregate Column."""
    return df.groupBy(*keys).agg(*[v.alias(k) for k, v in aggs.items()])


def pivot_agg(df: DataFrame, keys, pivot: str, values, agg: Column, prefix: str = "") -> DataFrame:
    """A10: pivot with the values given (no extra job to find them).
    Output columns are ``prefix + cleaned value``."""
    res = df.groupBy(*keys).pivot(pivot, list(values)).agg(agg)
    ren = {str(v): prefix + "".join(ch if ch.isalnum() else "_" for ch in str(v)).lower()
           for v in values}
    return res.withColumnsRenamed(ren)


# ---------------------------------------------------------------- W: windows


def rolling_mean(df: DataFrame, keys, order, c: str, n: int, out: str | None = None, spread: bool = False,
                 parts: int | None = None) -> DataFrame:
    """Mean of the last ``n`` rows per key in ``order`` (null until ``n``
    non-null values are in the window, as pandas ``rolling(n).mean()``). Null
    keys form one group and null orders come first; no row is dropped.

    Without ``spread``: one sliding window per key, right for series already
    reduced by a group-by (one row per key and period). With it, windows run
    inside (key, range) over data-driven ranges, so a key that holds a large
    share of all rows is spread out (see ``ranges.rolling``).
    """
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order)
    out = out or f"{c}_mean{n}"
    if spread:
        return rolling(df, keys, order, c, n, out, parts)
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.when(F.count(F.col(c)).over(w) == n, F.avg(F.col(c)).over(w)))


# ---------------------------------------------------------------- T: order


def nth_row(df: DataFrame, order, n: int) -> DataFrame:
    """The row at 0-based position ``n`` in ``order`` (a top-(n+1)
    per partition, no full sort)."""
    return df.orderBy(*order).offset(n).limit(1)


def best_row(df: DataFrame, metric: str, tie: str, mode: str = "min", by=()) -> DataFrame:
    """Best row by ``metric`` (min or max), ties broken by smaller
    ``tie``. Per group, a window top-1 that Spark plans with a partial
    group limit before the shuffle; globally a top-1."""
    m = F.col(metric).asc() if mode == "min" else F.col(metric).desc()
    order = [m, F.col(tie).asc()]
    if not by:
        return df.orderBy(*order).limit(1)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def head_n(df: DataFrame, order, n: int) -> DataFrame:
    """T3."""
    return df.orderBy(*order).limit(n)


# ---------------------------------------------------------------- U/R: sets, samples


def union_all(*dfs: DataFrame) -> DataFrame:
    """Positional union, duplicates kept."""
    return reduce(lambda a, b: a.union(b), dfs)


def replicate(df: DataFrame, n: int, out: str = "copy") -> DataFrame:
    """``n`` copies of every row in one scan: each row is exploded into
    ``n`` rows by a generator, no join and no union chain."""
    return df.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(out), "*")


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A seeded, reproducible full shuffle: a range-partitioned sort on a
    hash of the whole row and the seed, then on ``key``, so that rows of one
    hot key neither stay together nor share a task."""
    row = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return df.orderBy(F.xxhash64(*row, F.lit(seed)), F.col(key))


def split(df: DataFrame, key: str | None, ratio: float = 0.8, seed: int = 42,
          method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Reproducible train/test split by a hash of the key. Unlike a
    random split, the parts do not change with partitioning or retries.
    ``method="random"`` is Spark's ``randomSplit`` (no key needed, but the
    parts depend on the input partitioning)."""
    if method == "random":
        a, b_ = df.randomSplit([ratio, 1.0 - ratio], seed)
        return a, b_
    b = split_bucket(key, seed, is_integral(df, key))
    t = split_threshold(ratio)
    return df.filter(b < t), df.filter(b >= t)


def with_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42, out: str = "is_train") -> DataFrame:
    b = split_bucket(key, seed, is_integral(df, key))
    return df.withColumn(out, b < split_threshold(ratio))


def with_fold(df: DataFrame, key: str, k: int = 3, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number in [0, k) from the key."""
    return df.withColumn(out, fold_of(key, k, seed, is_integral(df, key)))
