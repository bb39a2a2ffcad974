"""Irregular readings onto a regular grid, filled shard by shard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import carry

SHARD = 64  # slots of one shard


def to_grid(df: DataFrame, key: str, time: str, value: str, step: int, shard: int = SHARD) -> DataFrame:
    """A regular series per key: (key, slot_no, reading, filled, how), slots 0 .. the slot of the last row.

    ``time`` is a whole number, ``slot_no`` = floor(time / step). ``reading`` is the slot's last non-null
    value (ties: the larger value), null where the slot has none. ``filled`` is the reading, else linear between the
    neighbouring readings, else the nearest one, else null when the key has no reading at all; ``how``
    says which: reading, between, after, before, none. Rows with a null key or time or a time below 0
    take no part; rows with a null value still extend the series; repeated rows change nothing.

    Each key is cut into shards of ``shard`` slots. A shard is summarised by its first and last reading,
    a two-level prefix scan carries the last reading forward and the next one back, and every shard,
    also one without any row, is then filled on its own.
    """
    # the slots of a key are known at once; only its last slot is looked up for the whole key
    d = df.select(F.col(key).alias("_k"), F.col(time).alias("_t"), F.col(value).alias("_v")).where("_k is not null and _t >= 0")
    d = d.withColumn("_slot", F.floor(F.col("_t") / step).cast("long"))
    per_slot = d.groupBy("_k", "_slot").agg(F.max(F.when(F.col("_v").isNotNull(), F.struct("_t", "_v"))).alias("_r"))
    per_shard = per_slot.groupBy("_k", F.floor(F.col("_slot") / shard).cast("long").alias("_shard")).agg(
        F.collect_list(F.when(F.col("_r").isNotNull(), F.struct("_slot", F.col("_r._v").alias("_v")))).alias("_got"), F.max("_slot").alias("_last")
    )
    lasts = per_shard.groupBy("_k").agg(F.max("_last").alias("_end")).withColumn("_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_end") / shard).cast("long"))))
    shards = lasts.join(per_shard.drop("_last"), ["_k", "_shard"], "left").withColumn("_got", F.coalesce("_got", F.array()))
    shards = shards.withColumns({"_lo": F.array_min("_got"), "_hi": F.array_max("_got")})
    shards = carry(shards, ["_k"], "_shard", {"_before": ("last", "_hi"), "_after": ("next", "_lo")})
    first = F.col("_shard") * shard
    slots = F.sequence(first, F.least(first + (shard - 1), F.col("_end")))
    found = F.map_from_entries("_got")

    def fill(slot):
        lo = F.coalesce(F.array_max(F.filter("_got", lambda g: g["_slot"] < slot)), F.col("_before"))
        hi = F.coalesce(F.array_min(F.filter("_got", lambda g: g["_slot"] > slot)), F.col("_after"))
        return F.struct(slot.alias("slot_no"), F.col("_found")[slot].alias("reading"), lo.alias("lo"), hi.alias("hi"))

    rows = shards.withColumn("_found", found).select("_k", F.explode(F.transform(slots, fill)).alias("r")).select("_k", "r.*")
    part = (F.col("slot_no") - F.col("lo._slot")) / (F.col("hi._slot") - F.col("lo._slot"))
    between = F.col("lo._v") + (F.col("hi._v") - F.col("lo._v")) * part
    return rows.select(
        F.col("_k").alias(key), "slot_no", "reading",
        F.coalesce("reading", between, "lo._v", "hi._v").alias("filled"),
        F.when(F.col("reading").isNotNull(), "reading").when(between.isNotNull(), "between").when(F.col("lo").isNotNull(), "after").when(F.col("hi").isNotNull(), "before").otherwise("none").alias("how"),
    )
