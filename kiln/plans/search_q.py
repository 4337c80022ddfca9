"""Queries for hyperparameter search. Grid and space sampling on their own
read no table, so they are covered by tests, not registered here."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.ml import elastic as EN
from kiln.ml import evaluation as E
from kiln.ml import features as M
from kiln.ml import models as L
from kiln.ml import search as H
from kiln.operators import relational as R
from kiln.plans.fit_sql import correlations, descent_sql
from kiln.plans.registry import query, rnd, table

GRID = {"regParam": [0.0, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]}
LAMBDAS = [0.0, 1e6, 1e8, 1e9, 1e10]


def part_folds(spark, sf):
    part = table(spark, sf, "part")
    train, test = R.split(part, "p_partkey", 0.8, 42)
    return R.with_fold(train, "p_partkey", 3, 42), test


def part_stages():
    lr = L.estimator("linear", "features", "p_retailprice", tol=1e-14, maxIter=1000)
    return [M.assembler(["p_partkey", "p_size"], "features"), lr], lr


def _elastic_cv_sql(rows: str, p: int, grid: list[tuple[float, float]], sweeps: int) -> str:
    """Trials of a 3-fold cross-validated elastic net over ``rows(fold, x0, ...,
    y)``: every fold's fit by coordinate descent."""
    xs = [f"x{i}" for i in range(p)]
    points = ", ".join(f"({i}, {float(a)!r}, {float(m)!r})" for i, (a, m) in enumerate(grid))
    line = " + ".join(["f.a", *[f"f.b{i} * l.x{i}" for i in range(p)]])
    return f"""
WITH RECURSIVE l AS ({rows}),
t AS (SELECT CAST(trial AS INTEGER) AS trial, CAST(reg AS DOUBLE) AS reg, CAST(mix AS DOUBLE) AS mix
      FROM (VALUES {points}) v(trial, reg, mix)),
m AS (SELECT k, {correlations(xs, 'y')} FROM l, (VALUES (0), (1), (2)) f(k) WHERE l.fold <> k GROUP BY k),
c AS (SELECT t.*, m.* FROM t, m),
{descent_sql(p, 'c', ['trial', 'k'], sweeps)},
e AS (SELECT f.trial, f.k, sqrt(avg((l.y - ({line})) * (l.y - ({line})))) AS rmse
      FROM fit f JOIN l ON l.fold = f.k GROUP BY f.trial, f.k)
SELECT t.trial, t.reg AS "regParam", t.mix AS "elasticNetParam", round(avg(rmse), 4) AS avg_rmse
FROM e JOIN t USING (trial) GROUP BY t.trial, t.reg, t.mix"""


_FOLD = "CAST(floor((({k} * 6007 + 42) % 10007) * 3 / 10007) AS INTEGER) AS fold"
PART_FOLD_ROWS = (f"SELECT {_FOLD.format(k='p_partkey')}, CAST(p_partkey AS DOUBLE) AS x0, CAST(p_size AS DOUBLE) AS x1, "
                  "p_retailprice AS y FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006")
LI_FOLD_ROWS = (f"SELECT {_FOLD.format(k='l_orderkey')}, l_quantity AS x0, l_extendedprice AS x1, l_discount AS x2, l_tax AS x3, "
                "l_extendedprice * (1 - l_discount) AS y FROM lineitem WHERE (l_orderkey * 7919 + 42) % 10007 < 8006")
GRID_POINTS = [(a, m) for m in GRID["elasticNetParam"] for a in GRID["regParam"]]
#: 30 trials: ten penalties, three mixings.
WIDE_POINTS = [(float(a), m) for m in (0.1, 0.5, 0.9) for a in (0, 1, 10, 50, 100, 500, 1000, 5000, 10000, 20000)]


@query("cv_search", _elastic_cv_sql(PART_FOLD_ROWS, 2, GRID_POINTS, 60))
def cv_search(spark, sf):
    """H2: 3 folds x 9 grid points, 4 fits at once."""
    train, _ = part_folds(spark, sf)
    stages, lr = part_stages()
    res = H.cv_search(train, stages, lr, GRID, "p_retailprice", "rmse", "fold", parallelism=4)
    return res.trials.join(_points(spark), ["regParam", "elasticNetParam"]).select(
        F.col("point").alias("trial"), "regParam", "elasticNetParam", rnd("avg_rmse", 4).alias("avg_rmse"))


def _points(spark):
    """The grid in the order of ``GRID_POINTS``."""
    return spark.createDataFrame([(i, a, m) for i, (a, m) in enumerate(GRID_POINTS)],
                                 "point int, regParam double, elasticNetParam double")


@query("elastic_sweep", _elastic_cv_sql(LI_FOLD_ROWS, 4, WIDE_POINTS, 600))
def elastic_sweep(spark, sf):
    """H2/H8: 30 elastic nets in 3 folds, 90 fits from one scan of lineitem."""
    li = table(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    train = R.with_fold(R.split(li, "l_orderkey", 0.8, 42)[0], "l_orderkey", 3, 42)
    xs = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return EN.elastic_sweep(train, xs, "net", WIDE_POINTS, "fold").select(
        "trial", "regParam", "elasticNetParam", rnd("avg_rmse", 4).alias("avg_rmse"))


_TVS_SQL = """
WITH d AS (SELECT CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y,
                  (p_partkey * 7919 + 7) % 10007 < 8006 AS fit_part
           FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006),
g AS (SELECT CAST(trial AS INTEGER) AS trial, CAST(reg AS DOUBLE) AS reg
      FROM (VALUES (0, 0.0), (1, 0.1), (2, 1.0), (3, 10.0)) t(trial, reg)),
s AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS cxy, var_pop(x) AS vx, stddev_pop(y) AS sy
      FROM d WHERE fit_part),
m AS (SELECT g.trial, g.reg, s.cxy / (s.vx * (1 + g.reg / s.sy)) AS b, s.mx, s.my FROM s, g)
SELECT m.trial, m.reg AS regParam,
       round(sqrt(avg((d.y - (m.my - m.b * m.mx + m.b * d.x)) * (d.y - (m.my - m.b * m.mx + m.b * d.x)))), 6) AS rmse
FROM m, d WHERE NOT d.fit_part GROUP BY m.trial, m.reg"""


@query("tvs_search", _TVS_SQL)
def tvs_search(spark, sf):
    """H3: the ridge grid on one reproducible 80/20 key-hash split of the
    training rows (seed 7), each grid point checked against its closed form."""
    train, _ = part_folds(spark, sf)
    stages, lr = ridge_stages()
    res = H.tvs_search(train, stages, lr, {"regParam": RIDGE_GRID}, "p_retailprice", "rmse", 0.8,
                       parallelism=4, seed=7, key="p_partkey")
    return res.trials.select("trial", "regParam", rnd("rmse").alias("rmse"))


RIDGE_GRID = [0.0, 0.1, 1.0, 10.0]

_RIDGE_CV_SQL = """
WITH d AS (SELECT CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y,
                  CAST(floor(((p_partkey * 6007 + 42) % 10007) * 3 / 10007) AS INTEGER) AS fold
           FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006),
g AS (SELECT CAST(trial AS INTEGER) AS trial, CAST(reg AS DOUBLE) AS reg
      FROM (VALUES (0, 0.0), (1, 0.1), (2, 1.0), (3, 10.0)) t(trial, reg)),
k AS (SELECT k FROM (VALUES (0), (1), (2)) f(k)),
s AS (SELECT k.k, avg(d.x) AS mx, avg(d.y) AS my, covar_pop(d.x, d.y) AS cxy, var_pop(d.x) AS vx,
             stddev_pop(d.y) AS sy
      FROM d, k WHERE d.fold <> k.k GROUP BY k.k),
m AS (SELECT g.trial, g.reg, s.k, s.cxy / (s.vx * (1 + g.reg / s.sy)) AS b, s.mx, s.my FROM s, g),
e AS (SELECT m.trial, m.reg, m.k, sqrt(avg((d.y - (m.my - m.b * m.mx + m.b * d.x)) * (d.y - (m.my - m.b * m.mx + m.b * d.x)))) AS rmse
      FROM m JOIN d ON d.fold = m.k GROUP BY m.trial, m.reg, m.k)
SELECT trial, reg AS regParam, round(avg(rmse), 6) AS avg_rmse FROM e GROUP BY trial, reg"""


def ridge_stages():
    lr = L.estimator("linear", "features", "p_retailprice", elasticNetParam=0.0, solver="normal")
    return [M.assembler(["p_partkey"], "features"), lr], lr


def ridge_cv(spark, sf):
    train, test = part_folds(spark, sf)
    stages, lr = ridge_stages()
    res = H.cv_search(train, stages, lr, {"regParam": RIDGE_GRID}, "p_retailprice", "rmse", "fold",
                      parallelism=4)
    return res, train, test


@query("trial_table", _RIDGE_CV_SQL)
def trial_table(spark, sf):
    """H2 + H4: 3-fold cross-validated ridge over a grid of penalties; the
    trial table (trial, regParam, avg_rmse). Each fold's fit has the closed
    form of Spark's standardised ridge, so SQL can check every trial."""
    res, _, _ = ridge_cv(spark, sf)
    return H.trials(res).select("trial", "regParam", rnd("avg_rmse").alias("avg_rmse"))


@query("adaptive_search")
def adaptive_search(spark, sf):
    """H6: 30 trials, 3 random, then density-ratio proposals in batches of 4."""
    part = table(spark, sf, "part")
    train, test = R.split(part, "p_partkey", 0.8, 42)
    train, test = train.cache(), test.cache()

    def fit_eval(p):
        stages, lr = part_stages()
        lr.setRegParam(p["regParam"]).setElasticNetParam(p["elasticNetParam"])
        model = L.fit_pipeline(train, stages)
        return E.eval_regression(L.score(model, test), "p_retailprice").first()["rmse"]

    space = {"regParam": ("float", 0.0, 2.0), "elasticNetParam": ("float", 0.0, 1.0)}
    try:
        # the trial table is built from the metrics, not from the cached frames
        return H.adaptive_search(fit_eval, space, n=30, startup=3, batch=4, seed=123, spark=spark)
    finally:
        train.unpersist()
        test.unpersist()


_SWEEP_SQL = """
WITH d AS (SELECT CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y,
                  CAST(floor(((p_partkey * 6007 + 42) % 10007) * 3 / 10007) AS INTEGER) AS fold
           FROM part WHERE (p_partkey * 7919 + 42) % 10007 < 8006),
f AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx,
             sum(x * y) AS sxy, sum(y * y) AS syy FROM d GROUP BY fold),
t AS (SELECT f.*, sum(n) OVER () - n AS tn, sum(sx) OVER () - sx AS tsx, sum(sy) OVER () - sy AS tsy,
             sum(sxx) OVER () - sxx AS tsxx, sum(sxy) OVER () - sxy AS tsxy FROM f),
g AS (SELECT t.*, l.trial, l.penalty FROM t,
      (SELECT CAST(i - 1 AS INTEGER) AS trial, v AS penalty FROM
         (SELECT unnest([0.0, 1e6, 1e8, 1e9, 1e10]) AS v, unnest(range(1, 6)) AS i)) l),
b AS (SELECT *, (tsxy - tsx * tsy / tn) / ((tsxx - tsx * tsx / tn) + penalty) AS b FROM g),
a AS (SELECT *, (tsy - b * tsx) / tn AS a FROM b)
SELECT trial, penalty, round(avg((syy - 2 * a * sy - 2 * b * sxy + n * a * a + 2 * a * b * sx + b * b * sxx) / n), 4)
       AS avg_mse
FROM a GROUP BY trial, penalty"""


@query("trial_sweep", _SWEEP_SQL)
def trial_sweep(spark, sf):
    """H8: ridge over a grid of penalties, 3-fold CV from fold sums."""
    train, _ = part_folds(spark, sf)
    res = H.ridge_sweep(train, "p_partkey", "p_retailprice", LAMBDAS, "fold")
    return res.select(F.col("trial").cast("int").alias("trial"), F.col("lambda").alias("penalty"),
                      rnd("avg_mse", 4).alias("avg_mse"))


_REFIT_SQL = """
WITH cv AS (""" + _RIDGE_CV_SQL.strip().replace("round(avg(rmse), 6) AS avg_rmse", "avg(rmse) AS avg_rmse") + """),
best AS (SELECT regParam AS reg FROM cv ORDER BY avg_rmse, trial LIMIT 1),
tr AS (SELECT CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y FROM part
       WHERE (p_partkey * 7919 + 42) % 10007 < 8006),
te AS (SELECT CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y FROM part
       WHERE (p_partkey * 7919 + 42) % 10007 >= 8006),
st AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS cxy, var_pop(x) AS vx, stddev_pop(y) AS sy FROM tr),
models AS (SELECT 'tuned' AS model, st.cxy / (st.vx * (1 + best.reg / st.sy)) AS b, st.mx, st.my FROM st, best
           UNION ALL SELECT 'untuned', st.cxy / st.vx, st.mx, st.my FROM st),
p AS (SELECT models.model, te.y, models.my - models.b * models.mx + models.b * te.x AS yhat FROM models, te)
SELECT model, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
       round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) + 0.0 AS r2,
       round(avg((y - yhat) * (y - yhat)), 4) AS mse, round(avg(abs(y - yhat)), 6) AS mae, count(*) AS n
FROM p GROUP BY model"""


@query("refit_best", _REFIT_SQL)
def refit_best(spark, sf):
    """The best penalty of the cross-validated ridge grid, refitted on
    all training rows, compared with the untuned (unpenalised) model on the
    test rows."""
    res, train, test = ridge_cv(spark, sf)
    best_stages, best_lr = ridge_stages()
    tuned = H.refit(train, best_stages, best_lr, res.best_params)
    plain_stages, _ = ridge_stages()
    untuned = L.fit_pipeline(train, plain_stages)
    cmp = E.compare({"tuned": L.score(tuned, test), "untuned": L.score(untuned, test)}, "p_retailprice")
    return cmp.select("model", rnd("rmse").alias("rmse"), rnd("r2").alias("r2"), rnd("mse", 4).alias("mse"),
                      rnd("mae").alias("mae"), "n")


def _tree_stages(kind, **params):
    return [M.assembler(["p_partkey", "p_size"], "features"), L.estimator(kind, "features", "p_retailprice", **params)]


def _searched(spark, sf, stages_of, space, n):
    """A search on the training rows, scored on the test rows."""
    train, test = R.split(table(spark, sf, "part"), "p_partkey", 0.8, 42)
    train, test = train.cache(), test.cache()

    def fit_eval(p):
        model = L.fit_pipeline(train, stages_of(p))
        return E.eval_regression(L.score(model, test), "p_retailprice").first()["rmse"]

    try:
        return H.adaptive_search(fit_eval, space, n=n, startup=4, batch=4, seed=7, spark=spark)
    finally:
        train.unpersist()
        test.unpersist()


CONDITIONAL = {"model": {"linear": {"regParam": ("float", 0.0, 2.0), "elasticNetParam": ("float", 0.0, 1.0)},
                         "tree": {"maxDepth": ("int", 2, 10), "minInstancesPerNode": ("logint", 1, 64)}}}


@query("model_search")
def model_search(spark, sf):
    """H5/H6: the model and its own parameters are searched together."""
    return _searched(spark, sf, lambda p: _tree_stages(p["model"], **{k: v for k, v in p.items() if k != "model"}),
                     CONDITIONAL, 16)


@query("model_search_full")
def model_search_full(spark, sf):
    """H5/H6 with the whole budget of 30 trials."""
    return _searched(spark, sf, lambda p: _tree_stages(p["model"], **{k: v for k, v in p.items() if k != "model"}),
                     CONDITIONAL, 30)


@query("int_search")
def int_search(spark, sf):
    """H7: 20 trials of integer parameters of a tree of limited depth."""
    return _searched(spark, sf, lambda p: _tree_stages("tree", maxDepth=5, **p),
                     {"minInstancesPerNode": ("int", 10, 200), "maxBins": ("int", 2, 32)}, 20)


@query("forest_sweep")
def forest_sweep(spark, sf):
    """H8/H2 over a forest: a grid of tree counts and depths, cross-validated."""
    train, _ = part_folds(spark, sf)
    grid = [{"numTrees": n, "maxDepth": d} for n in (5, 20) for d in (2, 5)]
    return H.sweep(train, grid, lambda p: _tree_stages("forest", seed=42, **p), "p_retailprice")


@query("forest_cv")
def forest_cv(spark, sf):
    """H2 over the forest grid at full size: 3 tree counts x 3 depths x 3 folds."""
    train, _ = part_folds(spark, sf)
    stages = _tree_stages("forest", seed=42)
    res = H.cv_search(train, stages, stages[-1], {"numTrees": [5, 10, 20], "maxDepth": [2, 5, 10]}, "p_retailprice", "rmse",
                      "fold", parallelism=4)
    return res.trials
