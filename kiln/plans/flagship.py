"""The flagship path: scan -> filter -> key-hash split -> assemble + scale
-> linear regression fitted on train -> score test -> metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.ml import evaluation as E
from kiln.ml import features as M
from kiln.ml import models as L
from kiln.operators import relational as R

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", *FEATURES)
    li = R.filter_cmp(li, "l_quantity", ">", 0)
    li = li.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    train, test = R.split(li, "l_orderkey", 0.8, 42)
    model = L.fit_pipeline(train, [M.assembler(FEATURES, "raw"),
                                   M.scaler("raw", "features", mean=True, std=True),
                                   L.estimator("linear", "features", "net", solver="normal")])
    return E.eval_regression(L.score(model, test), "net")
