"""Estimators, pipelines, persistence, scoring, importances and tree rules
(L1-L13). Fitting and scoring run as Spark ML jobs on the executors; the
driver only holds fitted parameters."""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kiln.ml.boosting import CellGBTRegressor
from kiln.session import checkpoint_root

ESTIMATORS = {
    "linear": LinearRegression,                 # L1, L2 (regParam, elasticNetParam)
    "tree": DecisionTreeRegressor,              # L3
    "forest": RandomForestRegressor,            # L4
    "gbt": CellGBTRegressor,                    # L5, L6
    "tree_clf": DecisionTreeClassifier,         # L7
    "forest_clf": RandomForestClassifier,       # L8
}

# Spark's limit on the depth of a tree.
MAX_TREE_DEPTH = 30


# Boosting and trees checkpoint their per-iteration state every
# ``checkpointInterval`` iterations (Spark's default, 10) into the shared
# checkpoint folder that ``fit_pipeline`` makes sure is set, so a long fit
# never replays its whole lineage after a lost executor.


def estimator(kind: str, features: str = "features", label: str = "label", **params):
    """An unfitted estimator of ``kind`` with its parameters. For deep
    trees pass ``cacheNodeIds=True``, which keeps each row's node between
    levels instead of walking the tree again."""
    if int(params.get("maxDepth", 0)) > MAX_TREE_DEPTH:
        raise ValueError(f"maxDepth={params['maxDepth']}: Spark's trees are at most {MAX_TREE_DEPTH} deep")
    return ESTIMATORS[kind](featuresCol=features, labelCol=label, **params)


def fit_pipeline(df: DataFrame, stages) -> PipelineModel:
    """Fit all stages once, in order (the checkpoint folder is set
    first, so iterative stages can cut their lineage)."""
    checkpoint_root(df.sparkSession)
    return Pipeline(stages=list(stages)).fit(df)


def save_model(model, path: str) -> None:
    """L10."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """L10."""
    return PipelineModel.load(path)


def score(model, df: DataFrame) -> DataFrame:
    """Lazy, distributed scoring (model shipped to the tasks)."""
    return model.transform(df)


def _last_with(model, attr: str):
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    for s in reversed(stages):
        if hasattr(s, attr):
            try:
                getattr(s, attr)
                return s
            except Exception:  # noqa: BLE001 - attribute exists but is not computable
                continue
    raise ValueError(f"no stage with {attr}")


def feature_names(model) -> list[str] | None:
    """Names of the assembled inputs, taken from the assembler stage."""
    stages = model.stages if isinstance(model, PipelineModel) else []
    for s in stages:
        if isinstance(s, VectorAssembler):
            return list(s.getInputCols())
    return None


def importances(spark: SparkSession, model, names=None) -> DataFrame:
    """(feature, importance), names from the assembler's input
    columns (not from the training frame's columns)."""
    m = _last_with(model, "featureImportances")
    imp = m.featureImportances.toArray().tolist()
    names = names or expanded_names(model, m) or [f"f{i}" for i in range(len(imp))]
    if len(names) != len(imp):
        raise ValueError(f"{len(names)} names for {len(imp)} features")
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(list(zip(names, [float(v) for v in imp])), schema)


def _powers(n: int, degree: int):
    """Exponents of the polynomial terms in Spark's order: the last variable
    is the outermost, and the constant is left out."""
    def go(last, left):
        if left == 0 or last < 0:
            yield {}
            return
        for p in range(left + 1):
            for rest in go(last - 1, left - p):
                yield {**rest, last: p} if p else rest
    terms = list(go(n - 1, degree))
    return [t for t in terms if t]


def expanded_names(model, last=None) -> list[str] | None:
    """Names of the features that ``last`` (default: the final stage) sees:
    the assembler's inputs, followed through polynomial expansion, selection
    and other stages. A stage that makes new features gives numbered names."""
    names = None
    for s in model.stages if isinstance(model, PipelineModel) else []:
        if s is last:
            break
        kind = type(s).__name__
        if kind == "VectorAssembler":
            names = list(s.getInputCols())
        elif names and kind == "PolynomialExpansion":
            names = ["*".join(f"{names[i]}^{p}" if p > 1 else names[i] for i, p in sorted(t.items()))
                     for t in _powers(len(names), s.getDegree())]
        elif names and hasattr(s, "selectedFeatures"):
            names = [names[i] for i in s.selectedFeatures]
        elif names and kind == "PCAModel":
            names = [f"pc{i}" for i in range(s.getK())]
    return names


_COND = re.compile(r"(If|Else) \(feature (\d+) (<=|>|in|not in) (.+)\)$")
_PRED = re.compile(r"Predict: (\S+)")

_TREE = re.compile(r"Tree (\d+) \(weight (\S+)\):$")

RULE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("weight", T.DoubleType()),
    T.StructField("leaf", T.IntegerType()), T.StructField("depth", T.IntegerType()),
    T.StructField("step", T.IntegerType()), T.StructField("feature", T.StringType()),
    T.StructField("op", T.StringType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("categories", T.StringType()), T.StructField("prediction", T.DoubleType())])


def tree_rules(spark: SparkSession, model, names=None) -> DataFrame:
    """One row per condition on the path to each leaf: (tree, weight,
    leaf, depth, step, feature, op, threshold, categories, prediction). A
    single tree is tree 0 with weight 1; leaves are numbered per tree. Built
    from the fitted model's text form, bounded by trees times 2^depth."""
    tree = _last_with(model, "toDebugString")
    names = names or expanded_names(model, tree)
    rows, path, leaf, number, weight, base = [], [], 0, 0, 1.0, 2
    for line in tree.toDebugString.splitlines()[1:]:
        indent = len(line) - len(line.lstrip())
        text = line.strip()
        m = _TREE.match(text)
        if m:  # the trees of an ensemble are indented below their headers
            number, weight, leaf, path, base = int(m.group(1)), float(m.group(2)), 0, [], indent + 2
            continue
        m = _COND.match(text)
        if m:
            del path[indent - base:]
            f = int(m.group(2))
            path.append((names[f] if names else f"f{f}", m.group(3), m.group(4)))
            continue
        p = _PRED.match(text)
        if p:
            del path[indent - base:]
            depth = len(path)
            for step, (f, op, thr) in enumerate(path):
                numeric = op in ("<=", ">")
                rows.append((number, weight, leaf, depth, step, f, op, float(thr) if numeric else None,
                             None if numeric else thr, float(p.group(1))))
            if not path:
                rows.append((number, weight, leaf, 0, 0, None, None, None, None, float(p.group(1))))
            leaf += 1
    return spark.createDataFrame(rows, RULE_SCHEMA)
