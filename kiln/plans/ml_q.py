"""Queries for features, models, evaluation, UDF scoring and group models.

Oracles: linear fits against their closed form (``regr_*`` or covariances),
tree stumps against a brute-force split search, evaluators against plain
aggregates. Model-only keys (forests, boosting, PCA) have no SQL twin.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kiln.ml import elastic as EN
from kiln.ml import evaluation as E
from kiln.ml import features as M
from kiln.ml import linear as LIN
from kiln.ml import models as L
from kiln.functions import udfs as U
from kiln.operators import ranks as RK
from kiln.operators import relational as R
from kiln.plans.fit_sql import correlations, descent_sql
from kiln.plans.registry import query, rnd, table
from kiln.session import scratch_path
from kiln.sources import tables as S

# ---------------------------------------------------------------- shared fixtures

PART_TRAIN = "(SELECT * FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006)"
PART_TEST = "(SELECT * FROM part WHERE (p_partkey * 7919 + 42) % 10007 >= 8006)"
PART_FIT = (f"(SELECT regr_intercept(p_retailprice, p_partkey) AS a, "
            f"regr_slope(p_retailprice, p_partkey) AS b FROM {PART_TRAIN})")
PART_PRED_SQL = (f"SELECT t.p_partkey, (t.p_partkey * 7919 + 42) % 10007 < 8006 AS is_train, "
                 f"round(m.a + m.b * t.p_partkey, 4) AS prediction FROM part t, {PART_FIT} m")
LI_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def part_split(spark, sf):
    return R.split(table(spark, sf, "part"), "p_partkey", 0.8, 42)


def part_linear_stages(scale: bool = False):
    stages = [M.assembler(["p_partkey"], "raw")]
    if scale:
        stages.append(M.scaler("raw", "features", mean=True, std=True))
    else:
        stages[0] = M.assembler(["p_partkey"], "features")
    stages.append(L.estimator("linear", "features", "p_retailprice", solver="normal"))
    return stages


def part_linear(spark, sf, scale: bool = False):
    train, test = part_split(spark, sf)
    return L.fit_pipeline(train, part_linear_stages(scale)), train, test


def part_flagged(spark, sf):
    """All part rows with the train/test flag of the 80/20 key split."""
    return R.with_split(table(spark, sf, "part"), "p_partkey", 0.8, 42)


def part_predictions(model, spark, sf):
    return L.score(model, part_flagged(spark, sf)).select(
        "p_partkey", "is_train", rnd("prediction", 4).alias("prediction"))


def lineitem_labeled(spark, sf):
    return table(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))


# ---------------------------------------------------------------- L: models


@query("linreg_fit", PART_PRED_SQL)
def linreg_fit(spark, sf):
    model, _, _ = part_linear(spark, sf)
    return part_predictions(model, spark, sf)


@query("staged_predict", PART_PRED_SQL)
def staged_predict(spark, sf):
    """Assembler -> scaler -> linear model, fitted once."""
    model, _, _ = part_linear(spark, sf, scale=True)
    return part_predictions(model, spark, sf)


@query("model_reload", PART_PRED_SQL)
def model_reload(spark, sf):
    """Save a fitted pipeline, load it back, score with the copy."""
    model, _, _ = part_linear(spark, sf, scale=True)
    path = scratch_path(spark, "model")
    L.save_model(model, path)
    again = L.load_model(path)
    return part_predictions(again, spark, sf)


@query("batch_score", f"""
SELECT t.p_partkey, t.p_retailprice, round(m.a + m.b * t.p_partkey, 4) AS prediction
FROM part t, {PART_FIT} m""")
def batch_score(spark, sf):
    model, _, _ = part_linear(spark, sf)
    return L.score(model, table(spark, sf, "part")).select(
        "p_partkey", "p_retailprice", rnd("prediction", 4).alias("prediction"))


@query("sink_predictions", f"""
SELECT t.p_partkey, t.p_retailprice, CAST(t.p_partkey AS DOUBLE) AS feature0,
       round(m.a + m.b * t.p_partkey, 4) AS prediction
FROM part t, {PART_FIT} m""")
def sink_predictions(spark, sf):
    """Features (as array), label and prediction written, read back."""
    model, _, _ = part_linear(spark, sf)
    scored = L.score(model, table(spark, sf, "part")).select("p_partkey", "features", "p_retailprice",
                                                            "prediction")
    path = scratch_path(spark, "predictions")
    S.sink_predictions(scored, path)
    back = spark.read.parquet(path)
    return back.select("p_partkey", "p_retailprice", F.col("features").getItem(0).alias("feature0"),
                       rnd("prediction", 4).alias("prediction"))


RIDGE_LAMBDA = 1.0


@query("linreg_ridge", f"""
WITH s AS (SELECT avg(p_partkey) AS mx, avg(p_retailprice) AS my, covar_pop(p_partkey, p_retailprice) AS cxy,
                  var_pop(p_partkey) AS vx, stddev_pop(p_retailprice) AS sy FROM {PART_TRAIN}),
m AS (SELECT cxy / (vx * (1 + {RIDGE_LAMBDA} / sy)) AS b, mx, my FROM s)
SELECT t.p_partkey, (t.p_partkey * 7919 + 42) % 10007 < 8006 AS is_train,
       round(m.my - m.b * m.mx + m.b * t.p_partkey, 4) AS prediction
FROM part t, m""")
def linreg_ridge(spark, sf):
    """L2 with the mixing at 0 (ridge). With standardisation, Spark's
    objective penalises the coefficient on the standardised feature, scaled by
    the label's (population) deviation, so one feature has the closed form
    b = cov(x, y) / (var(x) * (1 + lambda / sd(y)))."""
    train, _ = part_split(spark, sf)
    model = L.fit_pipeline(train, [M.assembler(["p_partkey"], "features"),
                                   L.estimator("linear", "features", "p_retailprice", regParam=RIDGE_LAMBDA,
                                               elasticNetParam=0.0, solver="normal")])
    return part_predictions(model, spark, sf)


LI_ROWS = ("SELECT l_orderkey, l_linenumber, (l_orderkey * 7919 + 42) % 10007 < 8006 AS is_train, "
           "l_quantity AS x0, l_extendedprice AS x1, l_discount AS x2, l_tax AS x3, "
           "l_extendedprice * (1 - l_discount) AS y FROM lineitem")
LI_X = ["x0", "x1", "x2", "x3"]


@query("linreg_elastic", f"""
WITH RECURSIVE l AS ({LI_ROWS}),
c AS (SELECT 0 AS id, 0.1 AS reg, 0.5 AS mix, {correlations(LI_X, 'y')} FROM l WHERE is_train),
{descent_sql(4, 'c', ['id'], 600)}
SELECT l_orderkey, l_linenumber, is_train, round(y, 4) AS net,
       round(a + b0 * x0 + b1 * x1 + b2 * x2 + b3 * x3, 2) AS prediction
FROM l, fit""")
def linreg_elastic(spark, sf):
    """L2: one elastic net from the moments of the training rows, against the
    same optimum by coordinate descent in SQL."""
    li = R.with_split(lineitem_labeled(spark, sf), "l_orderkey", 0.8, 42)
    a, b, _ = EN.elastic_fit(li.filter("is_train"), LI_FEATS, "net", 0.1, 0.5)
    return li.select("l_orderkey", "l_linenumber", "is_train", rnd("net", 4).alias("net"),
                     F.round(EN.linear_expr(a, b, LI_FEATS), 2).alias("prediction"))


def _stump_sql(x: str, y: str, src: str) -> str:
    """Best variance split of ``y`` on ``x`` by brute force over midpoints
    of consecutive distinct values, and the two leaf means."""
    return f"""
WITH g AS (SELECT {x} AS x, count(*) AS n, sum({y}) AS s, sum(({y}) * ({y})) AS q FROM {src} GROUP BY 1),
c AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n) OVER (ORDER BY x) AS nl,
             sum(s) OVER (ORDER BY x) AS sl, sum(q) OVER (ORDER BY x) AS ql FROM g),
tot AS (SELECT sum(n) AS nt, sum(s) AS st, sum(q) AS qt FROM g),
cand AS (SELECT (x + nx) / 2 AS thr, nl, sl, ql, nt - nl AS nr, st - sl AS sr, qt - ql AS qr
         FROM c, tot WHERE nx IS NOT NULL),
best AS (SELECT * FROM cand ORDER BY (ql - sl * sl / nl) + (qr - sr * sr / nr), thr LIMIT 1)
SELECT 0 AS leaf, 1 AS depth, 0 AS step, '{x}' AS feature, '<=' AS op, round(thr, 6) AS threshold,
       CAST(NULL AS VARCHAR) AS categories, round(sl / nl, 4) AS prediction FROM best
UNION ALL
SELECT 1, 1, 0, '{x}', '>', round(thr, 6), CAST(NULL AS VARCHAR), round(sr / nr, 4) FROM best"""


def _rules_out(rules):
    return rules.select("leaf", "depth", "step", "feature", "op", rnd("threshold").alias("threshold"),
                        "categories", rnd("prediction", 4).alias("prediction"))


@query("tree_reg", _stump_sql("l_quantity", "l_extendedprice * (1 - l_discount)", "lineitem"))
def tree_reg(spark, sf):
    """L3 at depth 1: the split found must be the brute-force best."""
    li = lineitem_labeled(spark, sf)
    model = L.fit_pipeline(li, [M.assembler(["l_quantity"], "features"),
                                L.estimator("tree", "features", "net", maxDepth=1, maxBins=64)])
    return _rules_out(L.tree_rules(spark, model))


def _planted_sql(x: str, cut: float) -> str:
    return f"""
WITH c AS (SELECT (max({x}) FILTER (WHERE {x} < {cut}) + min({x}) FILTER (WHERE {x} >= {cut})) / 2 AS t
           FROM lineitem)
SELECT 0 AS leaf, 1 AS depth, 0 AS step, '{x}' AS feature, '<=' AS op, round(t, 6) AS threshold,
       CAST(NULL AS VARCHAR) AS categories, CAST(0 AS DOUBLE) AS prediction FROM c
UNION ALL SELECT 1, 1, 0, '{x}', '>', round(t, 6), CAST(NULL AS VARCHAR), CAST(1 AS DOUBLE) FROM c"""


def _planted_stump(spark, sf, x: str, cut: float, other: str):
    li = table(spark, sf, "lineitem").withColumn("label", (F.col(x) >= cut).cast("int"))
    model = L.fit_pipeline(li, [M.assembler([x, other], "features"),
                                L.estimator("tree_clf", "features", "label", impurity="gini",
                                            maxDepth=1, minInstancesPerNode=5, maxBins=64)])
    return model, li


@query("tree_clf", _planted_sql("l_quantity", 30))
def tree_clf(spark, sf):
    """A planted cut (quantity >= 30) comes back as a stump at the
    midpoint of the neighbouring values."""
    model, _ = _planted_stump(spark, sf, "l_quantity", 30, "l_discount")
    return _rules_out(L.tree_rules(spark, model))


@query("tree_rules", _planted_sql("l_discount", 0.05))
def tree_rules(spark, sf):
    """Rules table of a fitted tree (planted discount cut)."""
    model, _ = _planted_stump(spark, sf, "l_discount", 0.05, "l_tax")
    return _rules_out(L.tree_rules(spark, model))


def _li_tree_model(spark, sf, kind: str, **params):
    """Fitted on the training rows; returns the model and all rows, flagged."""
    li = R.with_split(lineitem_labeled(spark, sf), "l_orderkey", 0.8, 42)
    model = L.fit_pipeline(li.filter("is_train"), [M.assembler(LI_FEATS, "features"),
                                                   L.estimator(kind, "features", "net", **params)])
    return model, li


@query("forest_reg")
def forest_reg(spark, sf):
    model, rows = _li_tree_model(spark, sf, "forest", numTrees=20, maxDepth=5, minInstancesPerNode=1, seed=42)
    return L.score(model, rows).select("l_orderkey", "l_linenumber", "is_train", "net", "prediction")


@query("gbt_reg")
def gbt_reg(spark, sf):
    model, rows = _li_tree_model(spark, sf, "gbt", maxIter=10, maxDepth=3, stepSize=0.1, seed=42)
    return L.score(model, rows).select("l_orderkey", "l_linenumber", "is_train", "net", "prediction")


@query("gbt_large")
def gbt_large(spark, sf):
    """L6 re-aimed as a cluster fit: 20 rounds of depth 5 by default."""
    model, rows = _li_tree_model(spark, sf, "gbt", maxIter=20, maxDepth=5, stepSize=0.1, seed=42)
    return E.eval_by_group(L.score(model, rows), ["is_train"], "net")


@query("forest_clf")
def forest_clf(spark, sf):
    """Multiclass forest, 100 trees, on the embedding vectors."""
    emb = R.with_split(table(spark, sf, "embeddings").withColumn("features", array_to_vector("embedding")),
                       "vec_id", 0.8, 42)
    model = L.estimator("forest_clf", "features", "label", numTrees=100, maxDepth=5, seed=42).fit(
        emb.filter("is_train"))
    return L.score(model, emb).select("vec_id", "is_train", "label", "prediction")


@query("feature_importance")
def feature_importance(spark, sf):
    model, _ = _li_tree_model(spark, sf, "forest", numTrees=20, maxDepth=5, seed=42)
    return L.importances(spark, model)


@query("fit_score_eval", f"""
WITH RECURSIVE l AS ({LI_ROWS} WHERE l_quantity > 0),
c AS (SELECT 0 AS id, 0.0 AS reg, 0.0 AS mix, {correlations(LI_X, 'y')} FROM l WHERE is_train),
{descent_sql(4, 'c', ['id'], 600)},
e AS (SELECT y, y - (a + b0 * x0 + b1 * x1 + b2 * x2 + b3 * x3) AS e FROM l, fit WHERE NOT is_train)
SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(1 - sum(e * e) / (var_pop(y) * count(*)), 10) AS r2, round(avg(e * e), 4) AS mse,
       round(avg(abs(e)), 6) AS mae, count(*) AS n FROM e""")
def fit_score_eval(spark, sf):
    """The flagship: least squares on scaled features, against coordinate
    descent without a penalty in SQL."""
    from kiln.plans.flagship import flagship
    return flagship(spark, sf).select(rnd("rmse").alias("rmse"), rnd("r2", 10).alias("r2"), rnd("mse", 4).alias("mse"),
                                      rnd("mae").alias("mae"), "n")


# ---------------------------------------------------------------- E: evaluation

PART_SCORED_SQL = (f"(SELECT t.p_partkey, t.p_brand, t.p_retailprice AS y, m.a + m.b * t.p_partkey AS yhat "
                   f"FROM {PART_TEST} t, {PART_FIT} m)")


def part_scored(spark, sf):
    model, _, test = part_linear(spark, sf)
    return L.score(model, test)


@query("eval_rmse", f"SELECT round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse FROM {PART_SCORED_SQL}")
def eval_rmse(spark, sf):
    return E.eval_regression(part_scored(spark, sf), "p_retailprice").select(rnd("rmse").alias("rmse"))


@query("eval_r2", f"""
SELECT round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2 FROM {PART_SCORED_SQL}""")
def eval_r2(spark, sf):
    return E.eval_regression(part_scored(spark, sf), "p_retailprice").select(rnd("r2").alias("r2"))


@query("eval_mse_mae", f"""
SELECT round(avg((y - yhat) * (y - yhat)), 4) AS mse, round(avg(abs(y - yhat)), 6) AS mae
FROM {PART_SCORED_SQL}""")
def eval_mse_mae(spark, sf):
    return E.eval_regression(part_scored(spark, sf), "p_retailprice").select(
        rnd("mse", 4).alias("mse"), rnd("mae").alias("mae"))


BIN_SRC = ("(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, "
           "CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS p FROM lineitem)")


def binary_pairs(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                     (F.col("l_discount") >= 0.05).cast("int").alias("prediction"))


@query("eval_binary", f"""
WITH c AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
                  count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = p) AS hit,
                  count(*) AS n FROM {BIN_SRC}),
m AS (SELECT hit / n AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, n FROM c)
SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(2 * precision * recall / (precision + recall), 6) AS f1, n FROM m""")
def eval_binary(spark, sf):
    r = E.eval_binary(binary_pairs(spark, sf), "label", "prediction", 1)
    return r.select(*[rnd(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "n")


@query("confusion_matrix", f"""
SELECT CAST(y AS INTEGER) AS label, CAST(p AS INTEGER) AS prediction, count(*) AS n FROM {BIN_SRC} GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    return E.confusion(binary_pairs(spark, sf), "label", "prediction", labels=(1, 0))


_FLAG_SQL = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"


@query("confusion_grid", f"""
WITH c AS (SELECT {_FLAG_SQL} AS label, CASE WHEN l_quantity > 40 THEN 2 ELSE 0 END AS prediction FROM lineitem),
g AS (SELECT * FROM (VALUES (0), (1), (2)) a(label), (VALUES (0), (1), (2)) b(prediction))
SELECT g.label, g.prediction, count(c.label) AS n FROM g LEFT JOIN c USING (label, prediction) GROUP BY ALL""")
def confusion_grid(spark, sf):
    """E5 on three classes of which one is never predicted: its cells are 0."""
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    rows = table(spark, sf, "lineitem").select(flag.alias("label"), F.when(F.col("l_quantity") > 40, 2).otherwise(0).alias("prediction"))
    return E.confusion(rows, "label", "prediction", labels=(0, 1, 2))


@query("eval_report", """
SELECT CAST(1 AS DOUBLE) AS accuracy, CAST(1 AS DOUBLE) AS precision, CAST(1 AS DOUBLE) AS recall,
       CAST(1 AS DOUBLE) AS f1, count(*) AS n, CAST(1 AS DOUBLE) AS auc FROM lineitem""")
def eval_report(spark, sf):
    """E6 on the planted stump: it separates the classes exactly, so every
    metric is 1 over all rows."""
    model, li = _planted_stump(spark, sf, "l_quantity", 30, "l_discount")
    r = E.eval_report(model, li, "label")
    return r.select(*[rnd(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "n",
                    rnd("auc").alias("auc"))


@query("compare_models", f"""
WITH base AS (SELECT avg(p_retailprice) AS mu FROM {PART_TRAIN}),
u AS (SELECT 'linear' AS model, y, yhat FROM {PART_SCORED_SQL}
      UNION ALL SELECT 'mean', t.p_retailprice, b.mu FROM {PART_TEST} t, base b)
SELECT model, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
       round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2,
       round(avg((y - yhat) * (y - yhat)), 4) AS mse, round(avg(abs(y - yhat)), 6) AS mae, count(*) AS n
FROM u GROUP BY model""")
def compare_models(spark, sf):
    model, train, test = part_linear(spark, sf)
    mu = train.agg(F.avg("p_retailprice")).first()[0]  # the baseline model is one number
    baseline = test.withColumn("prediction", F.lit(float(mu)))
    res = E.compare({"linear": L.score(model, test), "mean": baseline}, "p_retailprice")
    return res.select("model", rnd("rmse").alias("rmse"), rnd("r2").alias("r2"), rnd("mse", 4).alias("mse"),
                      rnd("mae").alias("mae"), "n")


@query("eval_by_group", f"""
SELECT p_brand, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae,
       count(*) AS n
FROM {PART_SCORED_SQL} GROUP BY p_brand""")
def eval_by_group(spark, sf):
    r = E.eval_by_group(part_scored(spark, sf), ["p_brand"], "p_retailprice")
    return r.select("p_brand", rnd("rmse").alias("rmse"), rnd("mae").alias("mae"), "n")


# ---------------------------------------------------------------- M: features

LI_KEY = "l_orderkey, l_linenumber"
LI_TRAIN = "(SELECT * FROM lineitem WHERE (l_orderkey * 7919 + 42) % 10007 < 8006)"
LI_TEST = "(SELECT * FROM lineitem WHERE (l_orderkey * 7919 + 42) % 10007 >= 8006)"


@query("assemble", f"SELECT {LI_KEY}, l_quantity AS f_0, l_discount AS f_1, l_tax AS f_2 FROM lineitem")
def assemble(spark, sf):
    li = table(spark, sf, "lineitem")
    v = M.assembler(["l_quantity", "l_discount", "l_tax"], "f").transform(li)
    return v.select("l_orderkey", "l_linenumber", *M.vector_columns(v, "f", 3))


@query("vector_array", f"""
SELECT {LI_KEY}, l_quantity AS a_0, l_extendedprice AS a_1, l_quantity + l_extendedprice AS a_sum FROM lineitem""")
def vector_array(spark, sf):
    li = table(spark, sf, "lineitem")
    v = M.vector_array(M.assembler(["l_quantity", "l_extendedprice"], "v").transform(li), "v", "a")
    return v.select("l_orderkey", "l_linenumber", F.col("a")[0].alias("a_0"), F.col("a")[1].alias("a_1"),
                    F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x).alias("a_sum"))


def _scaled(spark, sf, mean: bool):
    """Scaler fitted on the training rows, applied to every row."""
    li = R.with_split(table(spark, sf, "lineitem"), "l_orderkey", 0.8, 42)
    stages = [M.assembler(["l_quantity", "l_extendedprice"], "raw"), M.scaler("raw", "z", mean=mean, std=True)]
    model = L.fit_pipeline(li.filter("is_train"), stages)
    z = L.score(model, li)
    return z.select("l_orderkey", "l_linenumber", "is_train", *M.vector_columns(z, "z", 2, digits=6))


@query("scale_mean_std", f"""
WITH s AS (SELECT avg(l_quantity) AS m0, stddev_samp(l_quantity) AS s0, avg(l_extendedprice) AS m1,
                  stddev_samp(l_extendedprice) AS s1 FROM {LI_TRAIN})
SELECT {LI_KEY}, (l_orderkey * 7919 + 42) % 10007 < 8006 AS is_train,
       round((l_quantity - m0) / s0, 6) + 0.0 AS z_0, round((l_extendedprice - m1) / s1, 6) + 0.0 AS z_1
FROM lineitem t, s""")
def scale_mean_std(spark, sf):
    return _scaled(spark, sf, True)


@query("scale_std", f"""
WITH s AS (SELECT stddev_samp(l_quantity) AS s0, stddev_samp(l_extendedprice) AS s1 FROM {LI_TRAIN})
SELECT {LI_KEY}, (l_orderkey * 7919 + 42) % 10007 < 8006 AS is_train,
       round(l_quantity / s0, 6) AS z_0, round(l_extendedprice / s1, 6) AS z_1
FROM lineitem t, s""")
def scale_std(spark, sf):
    return _scaled(spark, sf, False)


@query("poly_expand", f"""
SELECT {LI_KEY}, round(l_quantity, 6) AS p_0, round(l_quantity * l_quantity, 6) AS p_1,
       round(l_discount, 6) AS p_2, round(l_quantity * l_discount, 6) AS p_3,
       round(l_discount * l_discount, 6) AS p_4
FROM lineitem""")
def poly_expand(spark, sf):
    li = table(spark, sf, "lineitem")
    v = M.assembler(["l_quantity", "l_discount"], "x").transform(li)
    p = M.poly("x", "p", 2).transform(v)
    return p.select("l_orderkey", "l_linenumber", *M.vector_columns(p, "p", 5, digits=6))


@query("variance_select", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(var_samp({c}), 2) AS var, var_samp({c}) > 0.5 AS selected FROM lineitem"
    for c in LI_FEATS))
def variance_select(spark, sf):
    li = table(spark, sf, "lineitem")
    v = M.assembler(LI_FEATS, "x").transform(li)
    sel = M.variance_selector("x", "sel", 0.5).fit(v)
    kept = [LI_FEATS[i] for i in sel.selectedFeatures]
    var = li.agg(*[F.var_samp(c).alias(c) for c in LI_FEATS])
    long = var.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("var"))
                                         for c in LI_FEATS])))
    return long.select("feature", rnd("var", 2).alias("var"), F.col("feature").isin(kept).alias("selected"))


@query("pca_project")
def pca_project(spark, sf):
    li = table(spark, sf, "lineitem")
    model = L.fit_pipeline(li, [M.assembler(LI_FEATS, "raw"), M.scaler("raw", "z", True, True),
                                M.pca("z", "pc", 2)])
    pc = L.score(model, li)
    return pc.select("l_orderkey", "l_linenumber", *M.vector_columns(pc, "pc", 2))


@query("string_index", """
WITH f AS (SELECT o_orderpriority, count(*) AS c FROM orders GROUP BY 1),
r AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY c DESC, o_orderpriority) - 1 AS DOUBLE) AS priority_idx
      FROM f)
SELECT o.o_orderkey, o.o_orderpriority, r.priority_idx FROM orders o JOIN r USING (o_orderpriority)""")
def string_index(spark, sf):
    o = table(spark, sf, "orders")
    return M.indexer("o_orderpriority", "priority_idx").fit(o).transform(o).select(
        "o_orderkey", "o_orderpriority", "priority_idx")


@query("index_many", """
WITH f AS (SELECT CAST(l_partkey AS VARCHAR) AS part, count(*) AS c FROM lineitem GROUP BY 1),
r AS (SELECT part, CAST(row_number() OVER (ORDER BY c DESC, part) - 1 AS DOUBLE) AS part_idx FROM f)
SELECT l_orderkey, l_linenumber, part_idx FROM lineitem JOIN r ON part = CAST(l_partkey AS VARCHAR)""")
def index_many(spark, sf):
    """M8 on a column of many values, whose labels stay on the executors."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return RK.index_values(li, "part", "part_idx").drop("part")


# ---------------------------------------------------------------- D: UDFs, group models

OLS2_SQL = f"""
WITH tr AS (SELECT CAST(p_partkey AS DOUBLE) AS x0, CAST(p_size AS DOUBLE) AS x1, p_retailprice AS y
            FROM {PART_TRAIN}),
s AS (SELECT avg(y) AS my, avg(x0) AS m0, avg(x1) AS m1, covar_pop(x0, x0) AS c00, covar_pop(x0, x1) AS c01,
             covar_pop(x1, x1) AS c11, covar_pop(x0, y) AS cy0, covar_pop(x1, y) AS cy1 FROM tr),
b AS (SELECT my, m0, m1, (c11 * cy0 - c01 * cy1) / (c00 * c11 - c01 * c01) AS b0,
             (c00 * cy1 - c01 * cy0) / (c00 * c11 - c01 * c01) AS b1 FROM s)
SELECT t.p_partkey, (t.p_partkey * 7919 + 42) % 10007 < 8006 AS is_train,
       round(b.my - b.b0 * b.m0 - b.b1 * b.m1 + b.b0 * t.p_partkey + b.b1 * t.p_size, 4) AS prediction
FROM part t, b"""


def part_ols2(spark, sf):
    train, _ = part_split(spark, sf)
    model = LIN.ols(train, ["p_partkey", "p_size"], "p_retailprice").first()  # p + 1 numbers
    return model, part_flagged(spark, sf)


@query("udf_score_cols", OLS2_SQL)
def udf_score_cols(spark, sf):
    model, test = part_ols2(spark, sf)
    s = U.score_cols(test, model, ["p_partkey", "p_size"])
    return s.select("p_partkey", "is_train", rnd("prediction", 4).alias("prediction"))


@query("udf_score_struct", OLS2_SQL)
def udf_score_struct(spark, sf):
    model, test = part_ols2(spark, sf)
    s = U.score_struct(test, model, ["p_partkey", "p_size"])
    return s.select("p_partkey", "is_train", rnd("prediction", 4).alias("prediction"))


GROUP_MOMENTS_SQL = """
WITH s AS (SELECT l_suppkey, count(*) AS n_used, avg(l_extendedprice) AS my, avg(l_quantity) AS m0,
                  avg(l_discount) AS m1, covar_pop(l_quantity, l_quantity) AS c00,
                  covar_pop(l_quantity, l_discount) AS c01, covar_pop(l_discount, l_discount) AS c11,
                  covar_pop(l_quantity, l_extendedprice) AS cy0, covar_pop(l_discount, l_extendedprice) AS cy1
           FROM lineitem GROUP BY l_suppkey),
b AS (SELECT l_suppkey, n_used, (c11 * cy0 - c01 * cy1) / (c00 * c11 - c01 * c01) AS b0,
             (c00 * cy1 - c01 * cy0) / (c00 * c11 - c01 * c01) AS b1, my, m0, m1 FROM s),
m AS (SELECT l_suppkey, n_used, b0, b1, my - b0 * m0 - b1 * m1 AS a FROM b)"""


@query("group_fit", GROUP_MOMENTS_SQL + """
SELECT m.l_suppkey, round(m.a, 2) + 0.0 AS intercept, round(m.b0, 4) + 0.0 AS coef_0, round(m.b1, 2) + 0.0 AS coef_1,
       round(avg((l.l_extendedprice - (m.a + m.b0 * l.l_quantity + m.b1 * l.l_discount)) ^ 2), 0) AS mse,
       m.n_used
FROM m JOIN lineitem l USING (l_suppkey)
GROUP BY m.l_suppkey, m.a, m.b0, m.b1, m.n_used""")
def group_fit(spark, sf):
    """D3: one linear model per supplier, from moment aggregates."""
    fit = LIN.group_fit(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_quantity", "l_discount"],
                        "l_extendedprice")
    return fit.select("l_suppkey", rnd("intercept", 2).alias("intercept"),
                      rnd(F.col("coef")[0], 4).alias("coef_0"), rnd(F.col("coef")[1], 2).alias("coef_1"),
                      rnd("mse", 0).alias("mse"), "n_used")


@query("group_score", GROUP_MOMENTS_SQL + """
SELECT l.l_suppkey, l.l_orderkey, l.l_linenumber,
       round(m.a + m.b0 * l.l_quantity + m.b1 * l.l_discount, 1) AS prediction, l.l_extendedprice AS actual
FROM lineitem l JOIN m USING (l_suppkey)""")
def group_score(spark, sf):
    """Models joined to their rows and applied, key kept."""
    li = table(spark, sf, "lineitem")
    models = LIN.ols(li, ["l_quantity", "l_discount"], "l_extendedprice", ["l_suppkey"])
    s = LIN.group_score(li, models, ["l_suppkey"], ["l_quantity", "l_discount"])
    return s.select("l_suppkey", "l_orderkey", "l_linenumber", rnd("prediction", 1).alias("prediction"),
                    F.col("l_extendedprice").alias("actual"))


@query("pandas_roundtrip", "SELECT * FROM orders")
def pandas_roundtrip(spark, sf):
    o = table(spark, sf, "orders")
    ps = U.to_pandas_on_spark(o, index_col="o_orderkey")
    return U.from_pandas_on_spark(ps, index_col="o_orderkey").select(*o.columns)


@query("pandas_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(var_samp({c}), 2) AS var FROM lineitem"
    for c in LI_FEATS))
def pandas_stats(spark, sf):
    s = U.pandas_stats(table(spark, sf, "lineitem"), LI_FEATS)
    return s.select("column", rnd("mean", 4).alias("mean"), rnd("var", 2).alias("var"))
