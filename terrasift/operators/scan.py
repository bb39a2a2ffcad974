"""Prefix scans over shard summaries, in two levels, so that no key is ever ordered in one task.

A key's rows are cut into shards; each shard is reduced to one summary row; the scan carries state
from shard to shard. ``WIDTH`` shards form a super-shard: windows run inside super-shards, then over
super-shards, so the largest window holds max(WIDTH, shards / WIDTH) rows even for a key that has a
third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1024


def carry(summaries: DataFrame, keys: Sequence[str], shard: str, what: dict[str, tuple[str, str]], width: int = WIDTH) -> DataFrame:
    """For each shard the state carried in from the other shards of its key.

    ``what``: new column -> (kind, column). Kinds: ``sum`` and ``max`` over all earlier shards,
    ``last`` (latest non-null of the earlier ones), ``next`` (first non-null of the later ones).
    A ``sum`` over nothing is 0, the others are null. One row per (keys, shard) goes in and comes out.
    """
    sup = "_super"
    s = summaries.withColumn(sup, F.floor(F.col(shard) / width).cast("long"))
    inner = Window.partitionBy(*keys, sup).orderBy(shard)
    outer = Window.partitionBy(*keys).orderBy(sup)

    def over(kind: str, c: str, w) -> Column:
        before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
        return {"sum": lambda: F.sum(c).over(before), "max": lambda: F.max(c).over(before), "last": lambda: F.last(c, True).over(before), "next": lambda: F.first(c, True).over(after)}[kind]()

    def total(kind: str, c: str) -> Column:
        return {"sum": lambda: F.sum(c), "max": lambda: F.max(c), "last": lambda: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(shard))), "next": lambda: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(shard)))}[kind]()

    tops = s.groupBy(*keys, sup).agg(*(total(k, c).alias(f"_t_{n}") for n, (k, c) in what.items()))
    tops = tops.select(*keys, sup, *(over(k, f"_t_{n}", outer).alias(f"_b_{n}") for n, (k, c) in what.items()))
    local = s.select("*", *(over(k, c, inner).alias(f"_l_{n}") for n, (k, c) in what.items()))
    both = local.join(tops, [*keys, sup], "left")

    def joined(n: str, kind: str) -> Column:
        near, far = F.col(f"_l_{n}"), F.col(f"_b_{n}")
        if kind == "sum":
            return F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0))
        return F.greatest(near, far) if kind == "max" else F.coalesce(near, far)

    return both.select(*summaries.columns, *(joined(n, k).alias(n) for n, (k, c) in what.items()))


def number_rows(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], name: str = "rn") -> DataFrame:
    """Numbers the rows of each key from 0 in ``order`` without bringing a key together.

    ``bucket`` is a column that rises with the order and cuts a key into groups of bounded size.
    """
    w = Window.partitionBy(*keys, bucket).orderBy(*order)
    counts = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_n"))
    base = carry(counts, keys, bucket, {"_base": ("sum", "_n")}).drop("_n")
    local = df.withColumn("_rn", F.row_number().over(w) - 1)
    return local.join(base, [*keys, bucket]).withColumn(name, (F.col("_rn") + F.col("_base")).cast("long")).drop("_rn", "_base")
