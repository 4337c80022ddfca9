"""Hyperparameter search (H1-H10). Every trial is a Spark fit or a Spark
aggregate; the driver only proposes parameters and keeps the trial table
(tens of rows).
"""

from __future__ import annotations

import itertools
import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.ml.trials import run_trials
from kiln.session import scratch_path


@dataclass
class SearchResult:
    best_model: Any
    best_params: dict
    trials: DataFrame


def param_grid(spark: SparkSession, **values) -> DataFrame:
    """H1: the full grid as a table (trial, one column per parameter)."""
    names = list(values)
    rows = [(i, *combo) for i, combo in enumerate(itertools.product(*values.values()))]
    fields = [T.StructField("trial", T.IntegerType())]
    for n in names:
        sample = values[n][0]
        t = T.IntegerType() if isinstance(sample, int) and not isinstance(sample, bool) else T.DoubleType()
        fields.append(T.StructField(n, t))
    rows = [tuple(r[0:1]) + tuple(int(v) if isinstance(f.dataType, T.IntegerType) else float(v)
                                  for v, f in zip(r[1:], fields[1:])) for r in rows]
    return spark.createDataFrame(rows, T.StructType(fields))


def _maps(stage, grid: dict):
    b = ParamGridBuilder()
    for name, vals in grid.items():
        b = b.addGrid(stage.getParam(name), list(vals))
    return b.build()


def _trial_frame(spark: SparkSession, stage, maps, metrics, metric_name: str) -> DataFrame:
    names = sorted({p.name for m in maps for p in m})
    values = {n: [m[stage.getParam(n)] for m in maps] for n in names}

    def number(vs):
        return all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in vs)

    # numbers are doubles; any other parameter keeps its text
    kinds = {n: T.DoubleType() if number(vs) else T.StringType() for n, vs in values.items()}
    rows = [(i, *[float(values[n][i]) if number(values[n]) else str(values[n][i]) for n in names], float(v))
            for i, v in enumerate(metrics)]
    schema = T.StructType([T.StructField("trial", T.IntegerType())]
                          + [T.StructField(n, kinds[n]) for n in names]
                          + [T.StructField(metric_name, T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def _best(maps, metrics, larger_better: bool):
    i = int(np.argmax(metrics) if larger_better else np.argmin(metrics))
    return i, {p.name: v for p, v in maps[i].items()}


def cv_search(df: DataFrame, stages, stage, grid: dict, label: str, metric: str = "rmse",
              fold: str = "fold", parallelism: int = 4, seed: int = 42) -> SearchResult:
    """H2: k-fold grid search over ``stage``'s parameters. Folds come from a
    fold column (``with_fold``), so they repeat on any partitioning; up to
    ``parallelism`` fits run at once."""
    maps = _maps(stage, grid)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    cv = CrossValidator(estimator=Pipeline(stages=list(stages)), estimatorParamMaps=maps, evaluator=ev,
                        foldCol=fold, parallelism=parallelism, seed=seed)
    model = cv.fit(df)
    _, best = _best(maps, model.avgMetrics, ev.isLargerBetter())
    trials = _trial_frame(df.sparkSession, stage, maps, model.avgMetrics, f"avg_{metric}")
    return SearchResult(model.bestModel, best, trials)


def tvs_search(df: DataFrame, stages, stage, grid: dict, label: str, metric: str = "rmse",
               ratio: float = 0.8, parallelism: int = 4, seed: int = 42, key: str | None = None) -> SearchResult:
    """H3: grid search on one train/validation split. With ``key`` the split
    is the reproducible key-hash split (``relational.split``) and the grid
    points are fitted as up to ``parallelism`` trials at once (``df`` is read by
    each: cache or write it before if that is dear); without it,
    Spark's ``TrainValidationSplit`` (whose random split depends on the
    input partitioning)."""
    maps = _maps(stage, grid)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    pipe = Pipeline(stages=list(stages))
    if key is None:
        tvs = TrainValidationSplit(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, trainRatio=ratio,
                                   parallelism=parallelism, seed=seed)
        model = tvs.fit(df)
        metrics, best_model = model.validationMetrics, model.bestModel
    else:
        from kiln.operators.relational import split
        train, valid = split(df, key, ratio, seed)
        done = run_trials(df.sparkSession, [[lambda m=m: ev.evaluate(pipe.fit(train, m).transform(valid))] for m in maps], parallelism)
        for _, e in done:
            if e is not None:
                raise e
        metrics = [r[0] for r, _ in done]
        best_model = pipe.fit(train, maps[_best(maps, metrics, ev.isLargerBetter())[0]])
    _, best = _best(maps, metrics, ev.isLargerBetter())
    trials = _trial_frame(df.sparkSession, stage, maps, metrics, metric)
    return SearchResult(best_model, best, trials)


def trials(result: SearchResult) -> DataFrame:
    """H4: (trial, params..., metric)."""
    return result.trials


# ---------------------------------------------------------------- spaces

# A space maps a parameter to (kind, low, high); kinds: float, int, logint.
# A conditional space: {"model": {"linear": {...}, "tree": {...}}}.


def _draw(kind: str, lo: float, hi: float, u):
    """Map a uniform draw in [0, 1) to the parameter's range (works on
    numpy arrays and on Spark columns)."""
    if kind == "float":
        return lo + (hi - lo) * u
    if kind == "int":
        return F.floor(lo + (hi - lo + 1) * u) if not isinstance(u, (float, np.ndarray)) \
            else np.floor(lo + (hi - lo + 1) * u)
    if kind == "logint":
        a, b = math.log(lo), math.log(hi + 1)
        if isinstance(u, (float, np.ndarray)):
            return np.floor(np.exp(a + (b - a) * u))
        return F.floor(F.exp(F.lit(a) + F.lit(b - a) * u))
    raise ValueError(kind)


def sample_space(spark: SparkSession, space: dict, n: int, seed: int = 42) -> DataFrame:
    """H5: ``n`` trials from a conditional space, drawn with seeded ``rand``
    on one partition so the draws repeat exactly. Columns: trial, model,
    and one nullable double per parameter of any model."""
    models = list(space["model"])
    base = spark.range(0, n, numPartitions=1).withColumnRenamed("id", "trial")
    pick = F.floor(F.rand(seed) * len(models)).cast("int")
    base = base.withColumn("model", F.element_at(F.array(*[F.lit(m) for m in models]), pick + 1))
    names = sorted({p for m in models for p in space["model"][m]})
    cols = []
    for j, name in enumerate(names):
        expr = None
        for m in models:
            if name in space["model"][m]:
                kind, lo, hi = space["model"][m][name]
                v = _draw(kind, lo, hi, F.rand(seed + 1 + j)).cast("double")
                expr = (F.when(F.col("model") == m, v) if expr is None
                        else expr.when(F.col("model") == m, v))
        cols.append(expr.alias(name))
    return base.select("trial", "model", *cols)


def _to_unit(kind, lo, hi, v):
    if kind == "logint":
        a, b = math.log(lo), math.log(hi + 1)
        return (math.log(max(v, lo)) - a) / (b - a)
    span = (hi - lo + (1 if kind == "int" else 0)) or 1.0
    return (v - lo) / span


def _parzen(x: np.ndarray, pts: np.ndarray, bw: float) -> np.ndarray:
    """Mean of Gaussian kernels at ``pts`` (unit cube), evaluated at ``x``."""
    d = ((x[:, None, :] - pts[None, :, :]) / bw) ** 2
    return np.exp(-0.5 * d.sum(-1)).mean(1) + 1e-12


def _decode(space: dict, u) -> dict:
    """Parameters of a point of the unit cube."""
    out = {}
    for k, (name, (kind, lo, hi)) in enumerate(space.items()):
        v = _draw(kind, lo, hi, np.clip(u[k], 0, 1 - 1e-12))
        out[name] = int(v) if kind in ("int", "logint") else float(v)
    return out


def _propose(rng, space: dict, hist: list[tuple[dict, float]], k: int, gamma: float, candidates: int) -> list[dict]:
    """The ``k`` candidates with the best ratio of a kernel density over the
    good trials (best ``gamma`` share) to one over the rest."""
    names = list(space)
    unit = np.array([[_to_unit(*space[nm], p[nm]) for nm in names] for p, _ in hist])
    order = np.argsort(np.array([m for _, m in hist]))
    n_good = max(1, int(math.ceil(gamma * len(hist))))
    good, bad = unit[order[:n_good]], unit[order[n_good:]]
    bw = max(0.05, 0.5 * len(hist) ** (-1.0 / (len(names) + 4)))
    centres = good[rng.integers(0, len(good), candidates)]
    cand = np.clip(centres + rng.normal(0, bw, centres.shape), 0, 1 - 1e-12)
    ratio = _parzen(cand, good, bw) / (_parzen(cand, bad, bw) if len(bad) else 1.0)
    return [_decode(space, cand[i]) for i in np.argsort(-ratio)[:k]]


def _arms(rng, arms: list, hist: list[tuple[dict, float]], k: int, gamma: float) -> list:
    """Models for the next ``k`` trials, drawn in proportion to how often each
    is among the good trials rather than the rest."""
    order = sorted(hist, key=lambda h: h[1])
    n_good = max(1, int(math.ceil(gamma * len(hist))))
    good, bad = ([p["model"] for p, _ in part] for part in (order[:n_good], order[n_good:]))
    w = np.array([(good.count(a) + 1) / (bad.count(a) + 1) for a in arms])
    return [arms[i] for i in rng.choice(len(arms), k, p=w / w.sum())]


def adaptive_search(fit_eval, space: dict, n: int, startup: int = 3, batch: int = 4, seed: int = 123,
                    gamma: float = 0.25, candidates: int = 64, spark: SparkSession | None = None, timeout: float | None = None):
    """H6/H7: sequential model-based search. The first ``startup`` trials are
    random; after that, each batch is proposed from a kernel density over the
    good trials against one over the rest. In a conditional space (``{"model":
    {name: space, ...}}``) the model is drawn first, by its share among the
    good trials, then its own parameters from its own trials (random while it
    has fewer than ``startup``); every parameter set then names its ``model``.

    ``fit_eval(params) -> metric`` (lower is better) runs a Spark fit; a batch
    runs in parallel threads. A failing trial scores inf and its message is
    kept in ``error``; if all fail, the last error is raised. With ``spark``, the
    trials of a batch are jobs of their own (``trials.run_trials``), cancelled
    after ``timeout`` seconds. Returns the
    trial table as a DataFrame (or a list of (parameters, metric) without
    ``spark``)."""
    models = space["model"] if isinstance(space.get("model"), dict) else None
    rng = np.random.default_rng(seed)
    hist: list[tuple[dict, float]] = []
    errors: list[BaseException | None] = []

    def run(params):
        try:
            return float(fit_eval(params)), None
        except Exception as e:  # noqa: BLE001 - a failed trial is recorded, not fatal
            return float("inf"), e

    def random_params(own):
        return _decode(own, rng.random(len(own)))

    def proposals(k):
        first = len(hist) < startup
        if models is None:
            return [random_params(space) for _ in range(k)] if first else _propose(rng, space, hist, k, gamma, candidates)
        names = list(models)
        chosen = [names[(len(hist) + i) % len(names)] for i in range(k)] if first else _arms(rng, names, hist, k, gamma)
        out = []
        for name in names:
            count = chosen.count(name)
            mine = [(p, m) for p, m in hist if p["model"] == name]
            if not count:
                continue
            made = ([random_params(models[name]) for _ in range(count)] if len(mine) < startup or not models[name]
                    else _propose(rng, models[name], mine, count, gamma, candidates))
            out += [{"model": name, **p} for p in made]
        return out

    with ThreadPoolExecutor(max_workers=batch) as pool:
        while len(hist) < n:
            k = min(batch, n - len(hist))
            if len(hist) < startup:
                k = min(k, startup - len(hist))
            props = proposals(k)
            if spark is None:
                done = list(pool.map(run, props))
            else:
                done = [(float("inf") if e else float(m[0]), e)
                        for m, e in run_trials(spark, [[lambda p=p: fit_eval(p)] for p in props], batch, timeout)]
            hist.extend((p, m) for p, (m, _) in zip(props, done))
            errors.extend(e for _, e in done)
    if errors and all(errors):
        raise errors[-1]
    if spark is None:
        return hist
    names = list(dict.fromkeys(nm for own in models.values() for nm in own)) if models else list(space)
    lead = [T.StructField("model", T.StringType())] if models else []
    rows = [(i, *([p["model"]] if models else []), *[float(p[nm]) if nm in p else None for nm in names], m,
             None if e is None else f"{type(e).__name__}: {e}"[:500]) for i, ((p, m), e) in enumerate(zip(hist, errors))]
    schema = T.StructType([T.StructField("trial", T.IntegerType()), *lead]
                          + [T.StructField(nm, T.DoubleType()) for nm in names]
                          + [T.StructField("metric", T.DoubleType()), T.StructField("error", T.StringType())])
    return spark.createDataFrame(rows, schema)


def sweep(df: DataFrame, trials: list[dict], stages_of, label: str, metric: str = "rmse", fold: str = "fold",
          parallelism: int = 4, timeout: float | None = None, stored: bool = False) -> DataFrame:
    """H8 for any Spark estimator: cross-validate ``stages_of(params)`` over the
    folds in ``df`` for each parameter set. Returns (trial, params (JSON),
    avg_metric, error); a failing trial, or one that takes over ``timeout``
    seconds, has no metric and keeps its message, its other folds are cancelled,
    and if all fail, the last error is raised. All (trial, fold) fits share the
    ``parallelism``. Each fit reads ``df``: with ``stored`` it is written once to
    the shared folder first; nothing is pinned in memory."""
    spark = df.sparkSession
    if stored:
        path = scratch_path(spark, "sweep")
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect() if r[0] is not None]   # k values
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)

    def score(params, f):
        return ev.evaluate(Pipeline(stages=list(stages_of(params))).fit(df.filter(F.col(fold) != f)).transform(df.filter(F.col(fold) == f)))

    done = run_trials(spark, [[lambda p=p, f=f: score(p, f) for f in folds] for p in trials], parallelism, timeout)
    if done and all(e for _, e in done):
        raise done[-1][1]
    rows = [(i, json.dumps(p, sort_keys=True), None if e else float(np.mean(m)), None if e is None else f"{type(e).__name__}: {e}"[:500])
            for i, (p, (m, e)) in enumerate(zip(trials, done))]
    return spark.createDataFrame(rows, f"trial int, params string, avg_{metric} double, error string")


def _fold_sums(df: DataFrame, xs: list[str], y: str, fold: str) -> DataFrame:
    """One row per fold: n, and sums of x_i, y, x_i*x_j, x_i*y and y*y of the
    rows without nulls, all about the overall means (a large offset in the
    data cancels before anything is squared)."""
    df = df.na.drop(subset=[*xs, y, fold])
    xv = [F.col(c).cast("double") for c in xs]
    yv = F.col(y).cast("double")
    pairs = [(i, j) for i in range(len(xs)) for j in range(i, len(xs))]
    aggs = [F.count(F.lit(1)).cast("double").alias("n"), F.avg(yv).alias("my"), F.var_pop(yv).alias("vy")]
    aggs += [F.avg(xv[i]).alias(f"m{i}") for i in range(len(xs))]
    aggs += [F.covar_pop(xv[i], yv).alias(f"cy{i}") for i in range(len(xs))]
    aggs += [F.covar_pop(xv[i], xv[j]).alias(f"c{i}_{j}") for i, j in pairs]
    per = df.groupBy(fold).agg(*aggs)
    over = Window.partitionBy()  # over the k fold rows only

    def off(m):  # a fold's mean less the overall mean
        return F.col(m) - F.sum(F.col(m) * F.col("n")).over(over) / F.sum("n").over(over)

    per = per.select("*", off("my").alias("dy"), *[off(f"m{i}").alias(f"d{i}") for i in range(len(xs))])
    n, dy = F.col("n"), F.col("dy")
    out = [(n * dy).alias("sy"), (n * (F.col("vy") + dy * dy)).alias("syy")]
    out += [(n * F.col(f"d{i}")).alias(f"sx{i}") for i in range(len(xs))]
    out += [(n * (F.col(f"cy{i}") + F.col(f"d{i}") * dy)).alias(f"sxy{i}") for i in range(len(xs))]
    out += [(n * (F.col(f"c{i}_{j}") + F.col(f"d{i}") * F.col(f"d{j}"))).alias(f"sxx{i}_{j}") for i, j in pairs]
    return per.select(fold, "n", *out)


def ridge_sweep(df: DataFrame, x, y: str, lambdas, fold: str = "fold") -> DataFrame:
    """H8: k-fold CV of ridge regression over a grid of penalties, from
    sufficient statistics. One aggregation makes one row of sums per fold;
    each (fold, penalty) trial is then solved from those k rows, so the
    data is read once whatever the number of trials, and no trial copies
    it. The intercept is not penalised. ``x`` is one column name (solved by
    JVM expressions) or a list (a numpy solve per trial over the k rows).
    Rows with a null feature, label or fold take no part. A trial that cannot
    be solved (a constant feature without a penalty) scores infinity.
    Returns (trial, lambda, avg_mse)."""
    if not isinstance(x, str) and len(x) == 1:
        x = x[0]
    if not isinstance(x, str):
        return _ridge_sweep_multi(df, list(x), y, lambdas, fold)
    st = _fold_sums(df, [x], y, fold).select(
        fold, "n", "sy", "syy", F.col("sx0").alias("sx"), F.col("sxy0").alias("sxy"), F.col("sxx0_0").alias("sxx"))
    allw = Window.partitionBy()  # over the k fold rows only
    tot = {c: F.sum(c).over(allw) - F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy")}
    trials = F.explode(F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(float(v)).alias("lambda"))
                                 for i, v in enumerate(lambdas)]))
    g = st.select("*", *[v.alias(f"t_{k}") for k, v in tot.items()]).select("*", trials.alias("_t"))
    g = g.select("*", "_t.trial", "_t.lambda")
    cxx = F.col("t_sxx") - F.col("t_sx") * F.col("t_sx") / F.col("t_n")
    cxy = F.col("t_sxy") - F.col("t_sx") * F.col("t_sy") / F.col("t_n")
    b = F.try_divide(cxy, cxx + F.col("lambda"))
    a = (F.col("t_sy") - b * F.col("t_sx")) / F.col("t_n")
    g = g.withColumn("b", b).withColumn("a", a)
    sse = (F.col("syy") - 2 * F.col("a") * F.col("sy") - 2 * F.col("b") * F.col("sxy")
           + F.col("n") * F.col("a") * F.col("a") + 2 * F.col("a") * F.col("b") * F.col("sx")
           + F.col("b") * F.col("b") * F.col("sxx"))
    return (g.withColumn("mse", F.coalesce(sse / F.col("n"), F.lit(float("inf")))).groupBy("trial", "lambda")
            .agg(F.avg("mse").alias("avg_mse")))


def _ridge_sweep_multi(df: DataFrame, xs: list[str], y: str, lambdas, fold: str) -> DataFrame:
    p = len(xs)
    st = _fold_sums(df, xs, y, fold)
    names = [c for c in st.columns if c != fold]
    # every fold row carries the totals over all folds: training = total - fold
    allw = Window.partitionBy()
    st = st.select(fold, *names, *[F.sum(c).over(allw).alias(f"t_{c}") for c in names])
    trials = F.explode(F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(float(v)).alias("lambda"))
                                 for i, v in enumerate(lambdas)]))
    g = st.select("*", trials.alias("_t")).select("*", "_t.trial", "_t.lambda").drop("_t")

    def sym(r, pre):
        m = np.empty((p, p))
        for i in range(p):
            for j in range(i, p):
                m[i, j] = m[j, i] = r[f"{pre}sxx{i}_{j}"]
        return m

    def solve(batches):
        for pdf in batches:
            mse = []
            for _, r in pdf.iterrows():
                n = r["t_n"] - r["n"]
                sx = np.array([r[f"t_sx{i}"] - r[f"sx{i}"] for i in range(p)])
                sy = r["t_sy"] - r["sy"]
                sxy = np.array([r[f"t_sxy{i}"] - r[f"sxy{i}"] for i in range(p)])
                sxx = sym(r, "t_") - sym(r, "")
                cxx = sxx - np.outer(sx, sx) / n
                cxy = sxy - sx * sy / n
                try:
                    b = np.linalg.solve(cxx + r["lambda"] * np.eye(p), cxy)
                except np.linalg.LinAlgError:
                    mse.append(float("inf"))
                    continue
                a = (sy - b @ sx) / n
                vx = np.array([r[f"sx{i}"] for i in range(p)])
                vxy = np.array([r[f"sxy{i}"] for i in range(p)])
                sse = (r["syy"] - 2 * a * r["sy"] - 2 * b @ vxy + r["n"] * a * a + 2 * a * (b @ vx)
                       + b @ sym(r, "") @ b)
                mse.append(float(sse / r["n"]))
            yield pd.DataFrame({"trial": pdf["trial"], "lambda": pdf["lambda"], "mse": mse})

    out = g.mapInPandas(solve, "trial int, lambda double, mse double")
    return out.groupBy("trial", "lambda").agg(F.avg("mse").alias("avg_mse"))


def refit(df: DataFrame, stages, stage, params: dict):
    """Fit the pipeline again on all of ``df`` with the best
    parameters found."""
    for name, v in params.items():
        stage.set(stage.getParam(name), v)
    return Pipeline(stages=list(stages)).fit(df)
