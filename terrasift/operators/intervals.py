"""Overlapping intervals to continuous periods and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .scan import carry


def periods_and_gaps(df: DataFrame, key: str, start: str, end: str, shard_width: int = 60_000) -> DataFrame:
    """Rows (key, span_kind, from_cs, to_cs) of the merged periods and of the gaps between them.

    ``start`` and ``end`` are whole numbers. Rows with a null key or bound, or with end <= start, take
    no part; touching or overlapping intervals form one period; repeated rows count once; an empty
    table gives no rows; other columns are ignored.

    Sort by start, compare each start with the running maximum of the ends before it, label islands by
    a running sum, aggregate. The order is never established over a whole key: starts are cut into
    shards of ``shard_width``, and the running maximum and the label enter each shard by a prefix scan.
    A shard holds at most ``shard_width`` distinct starts after the first aggregation.
    """
    k, s, e = F.col(key).alias("_k"), F.col(start).alias("_s"), F.col(end).alias("_e")
    iv = df.select(k, s, e).where("_k is not null and _s is not null and _e > _s").groupBy("_k", "_s").agg(F.max("_e").alias("_e"))
    iv = stored(iv.withColumn("_shard", F.floor(F.col("_s") / shard_width).cast("long")), "intervals")  # read four times
    ends = carry(iv.groupBy("_k", "_shard").agg(F.max("_e").alias("_mx")), ["_k"], "_shard", {"_in": ("max", "_mx")}).drop("_mx")
    w = Window.partitionBy("_k", "_shard").orderBy("_s")
    seen = F.greatest(F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_in"))
    marked = iv.join(ends, ["_k", "_shard"]).withColumn("_prev", seen).withColumn("_new", F.when(F.col("_prev").isNull() | (F.col("_s") > F.col("_prev")), 1).otherwise(0))
    labels = carry(marked.groupBy("_k", "_shard").agg(F.sum("_new").alias("_n")), ["_k"], "_shard", {"_lab": ("sum", "_n")}).drop("_n")
    labelled = marked.join(labels, ["_k", "_shard"]).withColumn("_island", F.col("_lab") + F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # the first row of an island knows the end before it: the gap needs no further window
    spans = labelled.groupBy("_k", "_island").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.max(F.when(F.col("_new") == 1, F.col("_prev"))).alias("_prev"))
    out = F.array(
        F.struct(F.lit("period").alias("span_kind"), F.col("_s").alias("from_cs"), F.col("_e").alias("to_cs")),
        F.struct(F.lit("gap").alias("span_kind"), F.col("_prev").alias("from_cs"), F.col("_s").alias("to_cs")),
    )
    return spans.select(F.col("_k").alias(key), F.inline(out)).where("from_cs is not null")
