"""Evaluation (E1-E8) as single-pass aggregates: every metric of a scored
table comes from one partial-then-final aggregation, never from pulling
predictions to the driver."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.ranges import ranged
from kiln.operators.relational import union_all


def _regression_aggs(label: str, pred: str) -> list[Column]:
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    e = y - p
    n = F.count(e)
    sse = F.sum(e * e)
    # SST from the numerically stable population variance of the label
    sst = F.var_pop(F.when(e.isNotNull(), y)) * n
    return [F.sqrt(sse / n).alias("rmse"),
            (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
            (sse / n).alias("mse"),
            F.avg(F.abs(e)).alias("mae"),
            n.alias("n")]


def eval_regression(df: DataFrame, label: str, pred: str = "prediction") -> DataFrame:
    """One row (rmse, r2, mse, mae, n); R2 about the label mean."""
    return df.agg(*_regression_aggs(label, pred))


def eval_by_group(df: DataFrame, by, label: str, pred: str = "prediction") -> DataFrame:
    """Regression metrics per group, one aggregation."""
    return df.groupBy(*by).agg(*_regression_aggs(label, pred))


def compare(scored: dict[str, DataFrame], label: str, pred: str = "prediction") -> DataFrame:
    """Metrics of several scored frames, keyed by model name, in one job."""
    parts = [d.select(F.lit(name).alias("model"), F.col(label).cast("double").alias("_y"),
                      F.col(pred).cast("double").alias("_p")) for name, d in scored.items()]
    return eval_by_group(union_all(*parts), ["model"], "_y", "_p")


def eval_binary(df: DataFrame, label: str, pred: str = "prediction", positive=1) -> DataFrame:
    """Accuracy, and precision/recall/F1 of the positive class, from one
    grouped pass; a metric with a zero denominator is 0."""
    y = F.col(label).cast("double") == F.lit(float(positive))
    p = F.col(pred).cast("double") == F.lit(float(positive))
    tp = F.count_if(y & p)
    fp = F.count_if(~y & p)
    fn = F.count_if(y & ~p)
    n = F.count(F.lit(1))
    agg = df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), n.alias("n"),
                 F.count_if(F.col(label).cast("double") == F.col(pred).cast("double")).alias("hit"))
    z = F.lit(0.0)
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), z)
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), z)
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), z)
    return agg.select(F.coalesce(F.try_divide(F.col("hit"), F.col("n")), z).alias("accuracy"),
                      prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), "n")


def confusion(df: DataFrame, label: str, pred: str = "prediction", labels=(1, 0)) -> DataFrame:
    """E5: (label, prediction, n) for every pair of ``labels``; empty cells
    show 0. The grid has len(labels)^2 rows, a parameter, not data."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(int(a), int(b)) for a in labels for b in labels],
                                 "label int, prediction int")
    counts = (df.select(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction"))
              .groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")))
    return (grid.join(counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("n", F.lit(0).cast("long")).alias("n")))


def auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Exact area under the ROC curve, one row (auc, n_pos, n_neg): the share
    of pairs of a positive and a negative row in which the positive one scores
    higher, ties counting half. Null without rows of both classes; rows with a
    null label or score take no part.

    Rows are counted per score first (with partial sums), the scores are put in
    ranges, and the negatives of earlier ranges are added to those below in the
    range: no task sees more scores than its range."""
    y = F.col(label).cast("double") == F.lit(float(positive))
    counts = (df.select(F.col(score).cast("double").alias("score"), y.alias("y")).na.drop().groupBy("score")
              .agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg")))
    placed = ranged(counts, "score")
    per = placed.groupBy("_p").agg(F.sum("neg").alias("t"))
    earlier = per.select("_p", (F.sum("t").over(Window.orderBy("_p")) - F.col("t")).alias("off"))  # a row per range
    lower = F.coalesce(F.sum("neg").over(Window.partitionBy("_p").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0))
    won = F.col("pos").cast("double") * (F.col("off") + F.col("below") + F.col("neg") / 2)
    n_pos, n_neg = F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))
    return (placed.withColumn("below", lower).join(earlier, "_p")
            .agg(F.try_divide(F.sum(won), n_pos.cast("double") * n_neg).alias("auc"), n_pos.alias("n_pos"), n_neg.alias("n_neg")))


def eval_report(model, df: DataFrame, label: str, positive=1) -> DataFrame:
    """E4 metrics plus the exact area under ROC of a fitted classifier, one
    row. The score is the probability of the second class (the second raw
    prediction where a model has no probabilities)."""
    scored = model.transform(df)
    by = "probability" if "probability" in scored.columns else "rawPrediction"
    area = auc(scored.withColumn("_score", vector_to_array(F.col(by)).getItem(1)), label, "_score", positive)
    return eval_binary(scored, label, "prediction", positive).join(F.broadcast(area.select("auc")))   # one row each
