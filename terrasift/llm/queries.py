"""Queries p6 to p8 over the text tables, with the SQL that they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import leak, packing, subjects

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: none of these can be told in SQL; tests/llm holds them against brute force, round trips and held-out labels
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "documents"), _table(spark, d, "pack_targets"))


@query
def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(_table(spark, d, "documents"), _table(spark, d, "pack_targets"))


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.spans(_table(spark, d, "documents"), _table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


@query
def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Per leaked item: the documents that leak it and the longest stretch."""
    s = leak.spans(_table(spark, d, "documents"), _table(spark, d, "eval_items"))
    return s.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("covered").alias("most_words"))


@query
def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    """The corpus without the documents that leak."""
    docs = _table(spark, d, "documents")
    return leak.without_leaks(docs, leak.spans(docs, _table(spark, d, "eval_items"))).select("doc_id", "source", "n_chars")


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    return subjects.assign(docs, subjects.fit(docs, _table(spark, d, "subject_labels"), _table(spark, d, "subject_areas"))).distinct()


@query
def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """Documents and characters per subject; ``none`` for the rest."""
    docs = _table(spark, d, "documents")
    found = p8_found(spark, d)
    return docs.select("doc_id", F.length("text").alias("n")).join(found, "doc_id", "left").groupBy(F.coalesce("subject", F.lit("none")).alias("subject")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_chars"))
