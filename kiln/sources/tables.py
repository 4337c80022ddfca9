"""Sources and sinks.

Plain Parquet by default; the format is a parameter. Reads stay lazy so
Catalyst can push filters and prune columns into the scan.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.sources import fs

MODES = ("append", "overwrite", "ignore", "errorifexists", "error")


class SchemaChangeError(ValueError):
    """Raised when an overwrite would replace the schema without opt-in."""


def scan_path(spark: SparkSession, path: str, fmt: str = "parquet",
              schema: StructType | str | None = None) -> DataFrame:
    """Read a table by path."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a table (or view) by catalog name."""
    return spark.read.table(name)


def register_views(spark: SparkSession, sf_dir: str, names) -> None:
    """Expose supplied Parquet tables by name as temporary views."""
    for n in names:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)


def scan_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """S3: run SQL over named frames."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with an explicit schema; inference only when none is given
    (it costs a full extra pass over the files)."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def use_schema(spark: SparkSession, name: str) -> None:
    """Create a database if missing and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def _existing_schema(spark: SparkSession, target: str, fmt: str, by_name: bool):
    """None only where there is no target (or an empty folder); a target that
    cannot be read raises."""
    if by_name:
        return spark.read.table(target).schema if spark.catalog.tableExists(target) else None
    if not fs.exists(spark, target) or fs.size_of(spark, target)[0] == 0:
        return None
    return spark.read.format(fmt).load(target).schema


def sink(df: DataFrame, target: str, mode: str = "errorifexists", replace_schema: bool = False,
         partition_by=(), fmt: str = "parquet", by_name: bool | None = None) -> None:
    """Write by path or by catalog name.

    ``overwrite`` keeps the schema unless ``replace_schema=True`` (S7): the
    old and new schemas are compared first and a change is refused.
    """
    if mode not in MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    spark = df.sparkSession
    if by_name is None:
        by_name = "/" not in target and ":" not in target
    if mode == "overwrite" and not replace_schema:
        old = _existing_schema(spark, target, fmt, by_name)
        if old is not None and [(f.name, f.dataType) for f in old] != [
                (f.name, f.dataType) for f in df.schema]:
            raise SchemaChangeError(
                f"overwrite of {target} changes the schema; pass replace_schema=True")
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if by_name:
        w.saveAsTable(target)
    else:
        w.save(target)


def vectors_to_arrays(df: DataFrame) -> DataFrame:
    """Vector columns become ``array<double>`` so any reader can use them."""
    return df.select(*[
        vector_to_array(F.col(f.name)).alias(f.name) if isinstance(f.dataType, VectorUDT)
        else F.col(f.name) for f in df.schema])


def sink_predictions(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    """Write a scored table (features, label, prediction)."""
    sink(vectors_to_arrays(df), target, mode=mode, replace_schema=True)
