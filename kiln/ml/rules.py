"""Fitted trees and ensembles as tables and expressions.

``nodes`` reads the node table that Spark stores with a model: one row per node
with its split, gain and weight, bounded by trees times two to the depth. From
it come

- ``expression``: the whole model as one column expression, so scoring needs no
  model object, pushes down and runs in any SQL engine;
- ``leaves`` and ``score_by_leaves``: every leaf as a box of feature intervals,
  met with the rows by an equi-join on buckets. Rows are first reduced to their
  distinct buckets, so the join grows with these, not with rows times leaves;
- ``importances``: recomputed from gains and weights in one aggregation.

``cells`` reduces rows to distinct feature values with weights, on which a tree
fit finds the same splits: features of few values need no pass per level over
the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.exprs import bucket_by_cuts
from kiln.ml.models import _last_with, expanded_names
from kiln.session import scratch_path

#: Leaves (times classes) up to which a model is scored as one expression.
EXPRESSION_LEAVES = 700


def cells(df: DataFrame, features: list[str], label: str, classes: bool = False) -> DataFrame:
    """Distinct values of ``features`` (and of the label, for ``classes``) with
    their number of rows ``weight``; a numeric label is the mean. Rows with a
    null take no part."""
    clean = df.na.drop(subset=[*features, label])
    if classes:
        return clean.groupBy(*features, label).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return clean.groupBy(*features).agg(F.avg(F.col(label).cast("double")).alias(label),
                                        F.count(F.lit(1)).cast("double").alias("weight"))


def _tree_stage(model):
    return _last_with(model, "featureImportances")


def _kind(stage) -> str:
    """How the trees' values are put together."""
    name = type(stage).__name__
    if "Classification" in name:
        return "margin" if name.startswith("GBT") else "votes"
    return "mean" if name.startswith("RandomForest") else "sum"


def nodes(spark: SparkSession, model) -> DataFrame:
    """(tree, weight, node, left, right, feature, threshold, categories,
    prediction, stats, gain, n) of a fitted tree, forest or boosted ensemble.
    Leaves have no feature; categorical splits have the values that go left."""
    stage = _tree_stage(model)
    path = scratch_path(spark, "tree-nodes")
    stage.write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data")
    if "nodeData" in raw.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").select("tree", "weight")
        raw = raw.select(F.col("treeID").alias("tree"), "nodeData.*").join(weights, "tree")
    else:
        raw = raw.select(F.lit(0).alias("tree"), "*", F.lit(1.0).alias("weight"))
    inner, plain = F.col("leftChild") >= 0, F.col("split.numCategories") < 0
    to = F.col("split.leftCategoriesOrThreshold")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    votes = "Classification" in type(stage).__name__ and not type(stage).__name__.startswith("GBT")
    return raw.select(
        "tree", "weight", F.col("id").alias("node"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & plain, F.get(to, F.lit(0))).alias("threshold"), F.when(inner & ~plain, to).alias("categories"),
        "prediction", F.col("impurityStats").alias("stats"), F.when(inner, F.col("gain")).alias("gain"),
        (total if votes else F.col("impurityStats").getItem(0)).alias("n"))


def _number(x: float) -> str:
    return f"double('{x!r}')" if x != x or x in (float("inf"), float("-inf")) else f"{x!r}D"


def _by_tree(rows) -> dict:
    out: dict = {}
    for r in rows:
        out.setdefault(r["tree"], {})[r["node"]] = r
    return out


def _names(model, names):
    got = names or expanded_names(model, _tree_stage(model))
    if not got:
        raise ValueError("the feature names are not known; give them")
    return got


def expression(spark: SparkSession, model, names: list[str] | None = None) -> Column:
    """The model's prediction as one expression over the columns ``names``
    (default: the assembler's inputs). Null where a feature it uses is null. For
    models of up to about ``EXPRESSION_LEAVES`` leaves (times classes): generated
    code has limits."""
    return _expression(_tree_stage(model), _names(model, names), nodes(spark, model).collect())    # bounded by the model


def _expression(stage, names, rows) -> Column:
    kind, trees = _kind(stage), _by_tree(rows)
    used = sorted({r["feature"] for r in rows if r["feature"] is not None})

    def walk(tree, node, value):
        r = tree[node]
        if r["feature"] is None:
            return value(r)
        x = f"`{names[r['feature']]}`"
        test = (f"{x} <= {_number(r['threshold'])}" if r["categories"] is None
                else f"{x} IN ({', '.join(map(_number, r['categories']))})")
        return f"CASE WHEN {test} THEN {walk(tree, r['left'], value)} ELSE {walk(tree, r['right'], value)} END"

    def added(value):
        parts = [f"{_number(t[0]['weight'])} * {walk(t, 0, value)}" if kind != "votes" else walk(t, 0, value) for t in trees.values()]
        while len(parts) > 1:                       # a balanced sum: no deep nesting
            parts = [f"({' + '.join(parts[i:i + 8])})" for i in range(0, len(parts), 8)]
        return parts[0]

    if kind == "votes":
        votes = [f"struct({added(lambda r, c=c: _number(_share(r, c)))}, {-c})" for c in range(stage.numClasses)]
        out = f"CAST(-array_max(array({', '.join(votes)})).col2 AS DOUBLE)"    # the first class with most votes
    else:
        out = added(lambda r: _number(r["prediction"]))
        out = f"({out}) / {len(trees)}" if kind == "mean" else f"CAST(({out}) > 0 AS DOUBLE)" if kind == "margin" else out
    known = " AND ".join(f"`{names[f]}` IS NOT NULL" for f in used)
    return F.expr(f"CASE WHEN {known} THEN {out} END" if known else out)


def _share(r, c: int) -> float:
    return r["stats"][c] / r["n"] if r["n"] else 0.0


def leaves(spark: SparkSession, model) -> tuple[list[dict], dict[int, list[float]]]:
    """Leaves as boxes: ``tree``, ``weight``, ``prediction``, ``stats`` and, per
    feature, the first and last bucket; and the cut points of each feature.
    Bucket ``b`` holds the values with ``b`` cut points below them."""
    return _leaves(nodes(spark, model).collect())                            # bounded by the model


def _leaves(rows) -> tuple[list[dict], dict[int, list[float]]]:
    if any(r["categories"] is not None for r in rows):
        raise ValueError("categorical splits are no intervals")
    cuts: dict[int, set] = {}
    for r in rows:
        if r["feature"] is not None:
            cuts.setdefault(r["feature"], set()).add(r["threshold"])
    cuts = {f: sorted(c) for f, c in sorted(cuts.items())}
    at = {f: {c: i for i, c in enumerate(cs)} for f, cs in cuts.items()}
    out = []

    def walk(tree, node, box):
        r = tree[node]
        if r["feature"] is None:
            out.append({**{k: r[k] for k in ("tree", "weight", "prediction", "stats", "n")}, "box": box})
            return
        f, i = r["feature"], at[r["feature"]][r["threshold"]]
        lo, hi = box[f]
        if lo <= i:
            walk(tree, r["left"], {**box, f: (lo, min(hi, i))})
        if hi > i:
            walk(tree, r["right"], {**box, f: (max(lo, i + 1), hi)})

    for t in _by_tree(rows).values():
        walk(t, 0, {f: (0, len(c)) for f, c in cuts.items()})
    return out, cuts


def score_by_leaves(df: DataFrame, model, names: list[str] | None = None, out: str = "prediction") -> DataFrame:
    """``df`` with the prediction, from a join of its distinct buckets with the
    leaves. Null where a feature that the model uses is null."""
    return _by_leaves(df, _tree_stage(model), _names(model, names), nodes(df.sparkSession, model).collect(), out)


def _by_leaves(df, stage, names, rows, out):
    spark, kind = df.sparkSession, _kind(stage)
    boxes, cuts = _leaves(rows)
    trees, classes = len(_by_tree(rows)), stage.numClasses if kind == "votes" else 1
    if not cuts:
        return df.withColumn(out, _expression(stage, names, rows))
    key = max(cuts, key=lambda f: len(cuts[f]))                              # most buckets: fewest leaves in each
    rest = [f for f in cuts if f != key]
    values = ((lambda b: [_share(b, c) for c in range(classes)]) if kind == "votes" else (lambda b: [b["weight"] * b["prediction"]]))
    flat = [(*values(b), *b["box"][key], *[x for f in rest for x in b["box"][f]]) for b in boxes]
    schema = "".join(f"v{c} double, " for c in range(classes)) + "k0 int, k1 int" + "".join(f", lo{f} int, hi{f} int" for f in rest)
    table = spark.createDataFrame(flat, schema).withColumn("_k", F.explode(F.sequence("k0", "k1")))
    cell = [f"_c{f}" for f in cuts]
    row = df.select("*", *[bucket_by_cuts(f"`{names[f]}`", cuts[f], strict=True).alias(f"_c{f}") for f in cuts])
    inside = [F.col(f"_c{key}") == F.col("_k")] + [F.col(f"_c{f}").between(F.col(f"lo{f}"), F.col(f"hi{f}")) for f in rest]
    sums = row.select(*cell).na.drop().distinct().join(table, inside).groupBy(*cell).agg(
        *[F.sum(f"v{c}").alias(f"v{c}") for c in range(classes)])
    if kind == "votes":
        got = -F.array_max(F.array(*[F.struct(F.col(f"v{c}").alias("v"), F.lit(-c).alias("c")) for c in range(classes)]))["c"]
        got = got.cast("double")
    else:
        got = F.col("v0") / trees if kind == "mean" else (F.col("v0") > 0).cast("double") if kind == "margin" else F.col("v0")
    return row.join(sums.select(*cell, got.alias(out)), cell, "left").select(*df.columns, out)


def score(df: DataFrame, model, names: list[str] | None = None, out: str = "prediction") -> DataFrame:
    """``df`` with the prediction by the model's rules: an expression for a small
    model, the join with its leaves for a large one."""
    stage, rows = _tree_stage(model), nodes(df.sparkSession, model).collect()
    size = sum(r["feature"] is None for r in rows) * (stage.numClasses if _kind(stage) == "votes" else 1)
    if size <= EXPRESSION_LEAVES or any(r["categories"] is not None for r in rows):
        return df.withColumn(out, _expression(stage, _names(model, names), rows))
    return _by_leaves(df, stage, _names(model, names), rows, out)


def importances(spark: SparkSession, model, names: list[str] | None = None) -> DataFrame:
    """L12 from the split gains: (feature, importance). A tree's gains, weighted
    by the rows of the split, are shares of the tree (of the ensemble, for
    boosting); the shares of all trees add up to one."""
    stage, names = _tree_stage(model), _names(model, names)
    per_tree = not type(stage).__name__.startswith("GBT")
    gains = nodes(spark, model).filter("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    if per_tree:
        total = gains.groupBy("tree").agg(F.sum("g").alias("t"))
        gains = gains.join(total, "tree").select("feature", F.try_divide("g", "t").alias("g"))
    sums = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    every = spark.createDataFrame(list(enumerate(names)), "i int, feature string")
    joined = every.join(sums.withColumnRenamed("feature", "i"), "i", "left")
    whole = sums.agg(F.sum("g").alias("whole"))
    return joined.join(F.broadcast(whole)).select("feature", F.coalesce(F.try_divide("g", "whole"), F.lit(0.0)).alias("importance"))
