"""Feature stages (M1-M8): thin constructors over Spark ML, plus helpers
that turn vectors into plain columns so any reader can compare them."""

from __future__ import annotations

from pyspark.ml.feature import (PCA, PolynomialExpansion, StandardScaler, StringIndexer,
                                VarianceThresholdSelector, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembler(cols, out: str = "features", invalid: str = "error") -> VectorAssembler:
    """M1: numeric columns -> one vector. ``invalid`` is ``error``,
    ``skip`` or ``keep`` for nulls/NaN."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid)


def vector_array(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """M2: vector -> ``array<double>`` (JVM-side, no Python)."""
    return df.withColumn(out or c, vector_to_array(F.col(c)))


def vector_columns(df: DataFrame, c: str, n: int, prefix: str | None = None, digits: int | None = None):
    """Vector (or array) column -> ``n`` scalar columns ``<prefix>0..``."""
    arr = vector_to_array(F.col(c)) if dict(df.dtypes)[c] == "vector" else F.col(c)
    p = prefix if prefix is not None else f"{c}_"
    cols = []
    for i in range(n):
        e = arr.getItem(i)
        cols.append((F.round(e, digits) if digits is not None else e).alias(f"{p}{i}"))
    return cols


def scaler(c: str, out: str, mean: bool = False, std: bool = True) -> StandardScaler:
    """M3/M4: z-scores with the sample standard deviation; a zero-variance
    column maps to 0. Fit on training rows only."""
    return StandardScaler(inputCol=c, outputCol=out, withMean=mean, withStd=std)


def poly(c: str, out: str, degree: int = 2) -> PolynomialExpansion:
    """M5: for (x, y): x, x^2, y, xy, y^2 at degree 2."""
    return PolynomialExpansion(inputCol=c, outputCol=out, degree=degree)


def variance_selector(c: str, out: str, threshold: float) -> VarianceThresholdSelector:
    """M6: keeps features whose sample variance is strictly above
    ``threshold``."""
    return VarianceThresholdSelector(featuresCol=c, outputCol=out, varianceThreshold=threshold)


def pca(c: str, out: str, k: int) -> PCA:
    """M7."""
    return PCA(inputCol=c, outputCol=out, k=k)


def indexer(c: str, out: str, handle_invalid: str = "error") -> StringIndexer:
    """M8: most frequent value -> 0.0; ties by value ascending."""
    return StringIndexer(inputCol=c, outputCol=out, stringOrderType="frequencyDesc",
                         handleInvalid=handle_invalid)
