"""Corpus pipeline over ``documents``: each stage applies one operator of
``kiln.llm`` to what the stage before it kept, and is written as Parquet and
read again before the next.

All stages but the last return the columns of ``documents``. Where a stage
changes a text, ``n_chars`` (if there) is the length of the new text. Texts
that lose every word stay as empty texts; a null text fails the quality rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import packing, pii, quality, simhash, substrings
from kiln.session import scratch_path


def _with_text(rows: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """The columns of ``doc`` with another text."""
    # a name of its own first: inside lambdas a column of the same select would win
    rows = rows.select("doc", text.alias("new_text"))
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return rows.select(*[(new[c] if c in new else F.col("doc").getField(c)).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality.repetition_rules(docs).filter("quality.kept").select("doc.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near
    copies (3-word shingles, at most 3 differing bits)."""
    return simhash.near_duplicates(docs).filter("representative").select("doc.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows."""
    return _with_text(substrings.remove_repeats(docs), F.col("text"), docs.columns)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    found = pii.find(docs)
    return _with_text(found, pii.redacted(F.col("text"), F.col("spans")), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length training sequences."""
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                     "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("substring_dedup", substring_dedup),
          ("pii_redaction", pii_redaction), ("packing", pack)]

#: Most stages cannot be put in SQL; ``tests/llm`` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
