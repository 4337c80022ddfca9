"""Full-size trees and ensembles, scored by exported rules.

The features take few values (quantity, a price band, discount), so the fits run
on weighted cells and the SQL twins can grow the same trees and boost them:
every prediction is checked against trees that the oracle engine grew itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.ml import evaluation as E
from kiln.ml import features as M
from kiln.ml import models as L
from kiln.ml import rules as RU
from kiln.plans.fit_sql import boosted_sql
from kiln.plans.registry import query, rnd, table

BAND = 5000
XS = ["f0", "f1", "f2"]
LINES = (f"(SELECT l_orderkey, l_linenumber, l_quantity AS f0, floor(l_extendedprice / {BAND}) AS f1, l_discount AS f2, "
         "l_extendedprice * (1 - l_discount) AS net, l_tax FROM lineitem)")
NET_CELLS = f"cell AS MATERIALIZED (SELECT f0, f1, f2, CAST(count(*) AS DOUBLE) AS n, sum(net) AS s0 FROM {LINES} GROUP BY ALL)"


def lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("f0"), F.floor(F.col("l_extendedprice") / BAND).cast("double").alias("f1"),
        F.col("l_discount").alias("f2"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), "l_tax")


def fitted(rows, kind: str, label: str, classes: bool = False, **params):
    """A model of weighted cells; cells are written once for the many passes."""
    few = RU.cells(rows, XS, label, classes).checkpoint()
    return L.fit_pipeline(few, [M.assembler(XS, "features"),
                                L.estimator(kind, "features", label, weightCol="weight", maxBins=64, **params)])


def scored(spark, model, rows):
    """By the rules: an expression where the model is small, else its leaves."""
    return RU.score(rows, model).select("l_orderkey", "l_linenumber", rnd("prediction", 2).alias("prediction"))


def _net_sql(depth: int, rounds: int = 1) -> str:
    return f"""
WITH RECURSIVE {NET_CELLS}, {boosted_sql(3, depth, rounds)},
fit AS (SELECT f0, f1, f2, pred FROM grown WHERE step = {depth * rounds})
SELECT l_orderkey, l_linenumber, round(pred, 2) AS prediction FROM {LINES} l JOIN fit USING (f0, f1, f2)"""


def _checkpointed(spark):
    from kiln.session import checkpoint_root
    checkpoint_root(spark)


@query("tree_reg_deep", _net_sql(5))
def tree_reg_deep(spark, sf):
    """L3 at depth 5."""
    _checkpointed(spark)
    rows = lines(spark, sf)
    return scored(spark, fitted(rows, "tree", "net", maxDepth=5), rows)


@query("forest_reg_rules", _net_sql(5))
def forest_reg_rules(spark, sf):
    """L4 without sampling, so that every tree is the best one: 20 trees of
    depth 5 put together by their rules."""
    _checkpointed(spark)
    rows = lines(spark, sf)
    return scored(spark, fitted(rows, "forest", "net", numTrees=20, maxDepth=5, bootstrap=False, featureSubsetStrategy="all"), rows)


@query("gbt_reg_rules", _net_sql(5, 20))
def gbt_reg_rules(spark, sf):
    """20 rounds of depth 5."""
    _checkpointed(spark)
    rows = lines(spark, sf)
    model = fitted(rows, "gbt", "net", maxIter=20, maxDepth=5, stepSize=0.1)
    return scored(spark, model, rows)


@query("gbt_full", _net_sql(6, 100))
def gbt_full(spark, sf):
    """L6 at full size: 100 rounds of depth 6, rate 0.1."""
    _checkpointed(spark)
    rows = lines(spark, sf)
    model = fitted(rows, "gbt", "net", maxIter=100, maxDepth=6, stepSize=0.1)
    return scored(spark, model, rows)


THIRDS = "CASE WHEN net < 20000 THEN 0 WHEN net < 45000 THEN 1 ELSE 2 END"
CLASS_CELLS = (f"cell AS MATERIALIZED (SELECT f0, f1, f2, CAST(count(*) AS DOUBLE) AS n, "
               + ", ".join(f"CAST(count(*) FILTER ({THIRDS} = {c}) AS DOUBLE) AS s{c}" for c in range(3))
               + f" FROM {LINES} GROUP BY ALL)")


@query("forest_clf_rules", f"""
WITH RECURSIVE {CLASS_CELLS}, {boosted_sql(3, 4, classes=3)},
leaf AS (SELECT node, sum(s0) AS s0, sum(s1) AS s1, sum(s2) AS s2 FROM grown WHERE step = 4 GROUP BY node),
fit AS (SELECT f0, f1, f2, CASE WHEN l.s0 >= l.s1 AND l.s0 >= l.s2 THEN 0 WHEN l.s1 >= l.s2 THEN 1 ELSE 2 END AS prediction
        FROM grown g JOIN leaf l USING (node) WHERE step = 4)
SELECT l_orderkey, l_linenumber, CAST(prediction AS DOUBLE) AS prediction FROM {LINES} l JOIN fit USING (f0, f1, f2)""")
def forest_clf_rules(spark, sf):
    """100 trees on three classes of the net price, put together by votes."""
    _checkpointed(spark)
    rows = lines(spark, sf).withColumn("label", F.when(F.col("net") < 20000, 0.0).when(F.col("net") < 45000, 1.0).otherwise(2.0))
    model = fitted(rows, "forest_clf", "label", True, numTrees=100, maxDepth=4, bootstrap=False, featureSubsetStrategy="all")
    return scored(spark, model, rows)


@query("importance_gains", f"""
WITH RECURSIVE {NET_CELLS}, {boosted_sql(3, 5)},
split AS (SELECT DISTINCT ON (g.step, before.node) g.step, before.node, g.feature, g.gain
          FROM grown g JOIN grown before ON before.step = g.step - 1 AND before.f0 = g.f0 AND before.f1 = g.f1 AND before.f2 = g.f2
          WHERE g.gain IS NOT NULL),
sums AS (SELECT feature, sum(gain) AS g FROM split GROUP BY feature)
SELECT 'f' || i AS feature, round(coalesce(g, 0) / (SELECT sum(g) FROM sums), 6) AS importance
FROM (VALUES (0), (1), (2)) f(i) LEFT JOIN sums ON feature = i""")
def importance_gains(spark, sf):
    """Importances of a forest from its split gains."""
    _checkpointed(spark)
    model = fitted(lines(spark, sf), "forest", "net", numTrees=5, maxDepth=5, bootstrap=False, featureSubsetStrategy="all")
    return RU.importances(spark, model).select("feature", rnd("importance").alias("importance"))


#: An imperfect classifier: a tree of depth 2 that sees quantity, price band and
#: discount tells whether the net price is above 40,000. Spark merges sibling
#: leaves of one class; so does the twin.
DEAR_CELLS = (f"cell AS MATERIALIZED (SELECT f0, f1, f2, CAST(count(*) AS DOUBLE) AS n, "
              f"CAST(count(*) FILTER (net > 40000) AS DOUBLE) AS s0 FROM {LINES} GROUP BY ALL)")
_REPORT = f"""
WITH RECURSIVE {DEAR_CELLS}, {boosted_sql(3, 2)},
leaf AS (SELECT node, node // 2 AS up, sum(s0) AS s, sum(n) AS n FROM grown WHERE step = 2 GROUP BY node),
pair AS (SELECT *, sum(s) OVER (PARTITION BY up) AS us, sum(n) OVER (PARTITION BY up) AS un,
                count(DISTINCT s / n > 0.5) OVER (PARTITION BY up) = 1 AS flat FROM leaf),
top AS (SELECT *, bool_and(flat) OVER () AND count(DISTINCT us / un > 0.5) OVER () = 1 AS bare, sum(s) OVER () AS rs, sum(n) OVER () AS rn
        FROM pair),
prob AS (SELECT node, CASE WHEN bare THEN rs / rn WHEN flat THEN us / un ELSE s / n END AS p FROM top),
p AS (SELECT l.net > 40000 AS y, prob.p AS score, prob.p > 0.5 AS hit
      FROM {LINES} l JOIN grown g ON g.step = 2 AND g.f0 = l.f0 AND g.f1 = l.f1 AND g.f2 = l.f2 JOIN prob ON prob.node = g.node),
r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM p),
a AS (SELECT (sum(rk) FILTER (y) - np * (np + 1) / 2.0) / (np * (cnt - np)) AS auc
      FROM r, (SELECT CAST(count(*) FILTER (y) AS DOUBLE) AS np, count(*) AS cnt FROM p) GROUP BY np, cnt),
c AS (SELECT count(*) FILTER (y AND hit) AS tp, count(*) FILTER (NOT y AND hit) AS fp, count(*) FILTER (y AND NOT hit) AS fn,
             count(*) FILTER (y = hit) AS ok, count(*) AS n FROM p)
SELECT round(ok / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1, n, round(auc, 6) AS auc FROM c, a"""


@query("eval_report_noisy", _REPORT)
def eval_report_noisy(spark, sf):
    """E6 on a classifier that errs; the area under the curve is exact, with ties."""
    _checkpointed(spark)
    rows = lines(spark, sf).withColumn("label", (F.col("net") > 40000).cast("double"))
    r = E.eval_report(fitted(rows, "tree_clf", "label", True, maxDepth=2), rows, "label")
    return r.select(*[rnd(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "n", rnd("auc").alias("auc"))
