"""Analytics of sampled run metrics and stage calls.

Windows per run are taken over (run, time bucket) with the state of earlier buckets carried in by a
prefix scan, so that a run of any length is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import carry


def _lagged(df: DataFrame, key: str, time: str, tie: str, value: str, bucket: int) -> DataFrame:
    """Adds ``_prev``: the value of the row before, by (time, tie), in the whole key."""
    d = df.withColumn("_b", F.floor(F.col(time) / bucket).cast("long"))
    last = d.groupBy(key, "_b").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(time, tie)).alias("_last"))
    base = carry(last, [key], "_b", {"_in": ("last", "_last")}).drop("_last")
    w = Window.partitionBy(key, "_b").orderBy(time, tie)
    j = d.join(base, [key, "_b"])
    return j.withColumn("_prev", F.when(F.row_number().over(w) == 1, F.col("_in.v")).otherwise(F.lag(value).over(w))).drop("_in", "_b")


def differences(df: DataFrame, key: str, time: str, tie: str, value: str, bucket: int = 60_000) -> DataFrame:
    """Adds ``delta``: the step of a cumulative counter; 0 in the first row of a key."""
    return _lagged(df, key, time, tie, value, bucket).withColumn("delta", F.coalesce(F.col(value) - F.col("_prev"), F.lit(0.0))).drop("_prev")


def non_decreasing(df: DataFrame, key: str, time: str, tie: str, value: str, bucket: int = 60_000) -> DataFrame:
    """(key, n, share): the share of steps that don't go down; null for a single row."""
    d = _lagged(df, key, time, tie, value, bucket)
    up = F.when(F.col("_prev").isNotNull() & F.col(value).isNotNull(), (F.col(value) >= F.col("_prev")).cast("double"))
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(up).alias("share"))


def running_max(df: DataFrame, key: str, time: str, tie: str, value: str, bucket: int = 60_000) -> DataFrame:
    """Adds ``so_far``: the largest value up to and including each row."""
    d = df.withColumn("_b", F.floor(F.col(time) / bucket).cast("long"))
    base = carry(d.groupBy(key, "_b").agg(F.max(value).alias("_m")), [key], "_b", {"_in": ("max", "_m")}).drop("_m")
    w = Window.partitionBy(key, "_b").orderBy(time, tie).rowsBetween(Window.unboundedPreceding, 0)
    return d.join(base, [key, "_b"]).withColumn("so_far", F.greatest(F.max(value).over(w), "_in")).drop("_in", "_b")


def in_stages(samples: DataFrame, stages: DataFrame, key: str, bucket: int = 3_000) -> DataFrame:
    """Samples with each stage call that they lie in, both ends included.

    Calls are spread over the time buckets that they touch: an equi-join by (key, bucket), then the bounds.
    """
    b = lambda c: F.floor(F.col(c) / bucket).cast("long")
    s = stages.where("s_cs <= e_cs").withColumn("_b", F.explode(F.sequence(b("s_cs"), b("e_cs"))))
    return samples.withColumn("_b", b("t_cs")).join(s, [key, "_b"]).where("t_cs between s_cs and e_cs").drop("_b")


def stage_stats(joined: DataFrame, group: list[str], least: int = 3) -> DataFrame:
    """First, last and largest memory, growth, mean and largest cpu per group of at least ``least`` samples."""
    at = F.struct("t_cs", "sample_id")
    g = joined.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.min_by("rss_tree_mb", at).alias("first_mb"), F.max_by("rss_tree_mb", at).alias("last_mb"), F.max("rss_tree_mb").alias("peak_mb"),
        F.avg("cpu_tree_pct").alias("mean_cpu"), F.max("cpu_tree_pct").alias("max_cpu"),
    )
    return g.where(F.col("n") >= least).withColumn("growth_mb", F.col("last_mb") - F.col("first_mb"))


def stalls(df: DataFrame, group: str, cpu: str, delta: str, low_cpu: float = 30.0, low_delta: float = 1.0) -> DataFrame:
    """Rows per group that neither compute nor receive, and their share."""
    hit = (F.col(cpu) < low_cpu) & (F.col(delta) < low_delta)
    return df.groupBy(group).agg(F.count_if(hit).alias("n_stalled"), F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n_stalled") / F.col("n"))


def pivot_stages(df: DataFrame, row: str, column: str, names: list[str], value: str) -> DataFrame:
    """One column per listed stage with the sum of the value; absent stages stay null."""
    return df.groupBy(row).pivot(column, names).agg(F.sum(value))


def speedup(df: DataFrame, key: str, workers: str, wall: str) -> DataFrame:
    """Wall time of the one-worker row over each row's, per key."""
    base = df.where(F.col(workers) == 1).groupBy(key).agg(F.min(wall).alias("_base"))
    return df.join(base, key, "left").withColumn("speedup", F.try_divide("_base", F.col(wall))).drop("_base")


def two_point_slope(df: DataFrame, group: str, x: str, y: str, to: float) -> DataFrame:
    """Slope between the rows of the smallest and the largest x, and the value it gives at ``to``."""
    g = df.groupBy(group).agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min_by(y, F.struct(x, y)).alias("y0"), F.max_by(y, F.struct(x, y)).alias("y1"))
    slope = F.try_divide(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    return g.withColumn("slope", slope).withColumn("at", F.col("y1") + F.col("slope") * (to - F.col("x1")))


def reclaimed(df: DataFrame, group: str, time: str, tie: str, value: str) -> DataFrame:
    """Share of the peak that is gone at the end."""
    g = df.groupBy(group).agg(F.max(value).alias("peak"), F.max_by(value, F.struct(time, tie)).alias("now"))
    return g.withColumn("reclaimed_pct", F.try_divide(100.0 * (F.col("peak") - F.col("now")), F.col("peak")))


def tree_counter(df: DataFrame, member: str, time: str, tie: str, value: str, bucket: int = 3_600) -> DataFrame:
    """Adds ``total``: the sum over all members of their last-seen cumulative counter, as of each row.

    A member that is gone keeps its last value in the sum. Each row changes the sum by its step within its
    member; the running sum over everything is a prefix scan over time buckets, so no task sees all rows.
    """
    step = _lagged(df, member, time, tie, value, bucket).withColumn("_d", F.coalesce(value, F.lit(0.0)) - F.coalesce("_prev", F.lit(0.0))).drop("_prev")
    step = step.withColumns({"_all": F.lit(0), "_b": F.floor(F.col(time) / bucket).cast("long")})
    base = carry(step.groupBy("_all", "_b").agg(F.sum("_d").alias("_s")), ["_all"], "_b", {"_in": ("sum", "_s")}).drop("_s")
    w = Window.partitionBy("_all", "_b").orderBy(time, tie).rowsBetween(Window.unboundedPreceding, 0)
    return step.join(base, ["_all", "_b"]).withColumn("total", F.col("_in") + F.sum("_d").over(w)).drop("_in", "_d", "_all", "_b")
