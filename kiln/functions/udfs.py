"""Vectorised Python scoring and pandas-on-Spark.

Scoring UDFs are Arrow-batched pandas UDFs; the model (a few floats) is a
broadcast variable, read once per task in the iterator form. Where the
model is linear, ``kiln.ml.linear.predict_expr`` does the same JVM-side
and is the faster choice; the UDFs are for models written in Python.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# pandas-on-Spark asks for this with pyarrow >= 2; set it before first use.
os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")


def _model_dict(model) -> dict:
    """Accept a dict or a Row with ``intercept`` and ``coef``."""
    if hasattr(model, "asDict"):
        model = model.asDict()
    return {"intercept": float(model["intercept"]), "coef": [float(c) for c in model["coef"]]}


def score_cols(df: DataFrame, model, cols, out: str = "prediction") -> DataFrame:
    """Series -> Series pandas UDF over any number of columns; the
    input frame is built with explicit column names."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(_model_dict(model))
    names = list(cols)

    @F.pandas_udf(T.DoubleType())
    def predict(*series: pd.Series) -> pd.Series:
        m = bc.value
        x = pd.concat(series, axis=1, keys=names).astype("float64")
        return pd.Series(x.to_numpy() @ np.asarray(m["coef"]) + m["intercept"])

    return df.withColumn(out, predict(*[F.col(c) for c in names]))


def score_struct(df: DataFrame, model, cols, out: str = "prediction") -> DataFrame:
    """Stored model applied to a struct of the feature columns. The
    iterator form unpacks the model once per task, not once per batch."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(_model_dict(model))
    names = list(cols)

    @F.pandas_udf(T.DoubleType())
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        m = bc.value
        coef, intercept = np.asarray(m["coef"]), m["intercept"]
        for pdf in batches:
            yield pd.Series(pdf[names].astype("float64").to_numpy() @ coef + intercept)

    return df.withColumn(out, predict(F.struct(*[F.col(c) for c in names])))


def to_pandas_on_spark(df: DataFrame, index_col=None):
    """Spark -> pandas-on-Spark, keeping a real column as the index
    (no default sequence index, which would need a global ordering)."""
    return df.pandas_api(index_col=index_col)


def from_pandas_on_spark(psdf, index_col=None) -> DataFrame:
    """Pandas-on-Spark -> Spark, index back as a column."""
    return psdf.to_spark(index_col=index_col)


def pandas_stats(df: DataFrame, cols, index_col=None) -> DataFrame:
    """Mean and sample variance per column through pandas-on-Spark
    (each is one distributed aggregate; only ``len(cols)`` numbers return).
    The median is left to ``median_var``, since pandas-on-Spark's is
    approximate."""
    psdf = to_pandas_on_spark(df.select(*cols), index_col)
    mean, var = psdf.mean(numeric_only=True), psdf.var()
    rows = [(c, float(mean[c]), float(var[c])) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column string, mean double, var double")
