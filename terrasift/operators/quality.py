"""Checks and figures of merit of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def retention(px: DataFrame, group: str, first: str, second: str, crop: list[int]) -> DataFrame:
    """(group, ndvi_px, static_px, retention_pct): how many crop pixels of the first map the second keeps."""
    n = px.groupBy(group).agg(F.count_if(F.col(first).isin(*crop)).alias("ndvi_px"), F.count_if(F.col(second).isin(*crop)).alias("static_px"))
    return n.withColumn("retention_pct", F.try_divide(100.0 * F.col("static_px"), F.col("ndvi_px")))


def share(jobs: DataFrame, group: str, total: str, part: str) -> DataFrame:
    return jobs.groupBy(group).agg(F.sum(part).alias("part"), F.sum(total).alias("whole")).withColumn("share_pct", F.try_divide(100.0 * F.col("part"), F.col("whole")))


def warnings(df: DataFrame, pct: str, tolerance: float = 1.0, low: float | None = None, high: float | None = None) -> DataFrame:
    """Adds ``warning``: the first rule that applies, or null."""
    w = F.when(F.col(pct) <= tolerance, "effectively none").when(F.col(pct) >= 100 - tolerance, "effectively all")
    if low is not None:
        w = w.when(F.col(pct) < low, "below minimum")
    if high is not None:
        w = w.when(F.col(pct) > high, "above maximum")
    return df.withColumn("warning", w)


def acres_total(polygons: DataFrame, group: str, acres: str) -> DataFrame:
    return polygons.groupBy(group).agg(F.sum(acres).alias("acres"), F.count(F.lit(1)).alias("n"))


def tile_minutes(tiles: DataFrame, key: str, seconds: str, wall_s: float, workers: int) -> DataFrame:
    """Mean minutes of a tile, or, where no tile was timed, the wall clock over the rounds of the workers."""
    g = tiles.groupBy(key).agg(F.avg(seconds).alias("_s"), F.count(F.lit(1)).alias("n_tiles"))
    return g.select(key, "n_tiles", F.coalesce(F.col("_s") / 60, F.lit(wall_s) / 60 / F.ceil(F.col("n_tiles") / workers)).alias("minutes"))


def tile_completeness(tiles: DataFrame, key: str, status: str) -> DataFrame:
    """(key, n_tiles, n_failed, complete): a tile without a status or whose status starts with fail makes its run incomplete."""
    s = F.lower(F.trim(status))
    failed = s.isNull() | s.startswith("fail")
    return tiles.groupBy(key).agg(F.count(F.lit(1)).alias("n_tiles"), F.count_if(failed).alias("n_failed")).withColumn("complete", F.col("n_failed") == 0)


def tally(jobs: DataFrame, status: str) -> DataFrame:
    return jobs.groupBy(F.when(F.col(status).startswith("failed"), "failed").otherwise("ok").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def refuse_empty(px: DataFrame, value: str) -> DataFrame:
    """(n_px, n_data) of a raster; the query fails when it runs if no pixel has data."""
    n = px.agg(F.count(F.lit(1)).alias("n_px"), F.count(value).alias("n_data"))
    return n.withColumn("n_data", F.when(F.col("n_data") > 0, F.col("n_data")).otherwise(F.raise_error(F.lit("no pixel has data")).cast("long")))


def area_ratio(raster: DataFrame, vector: DataFrame, key: str, low: float = 0.15, high: float = 1.05) -> DataFrame:
    """Vector over raster acreage per key, flagged outside plausible bounds."""
    j = raster.join(vector, key, "full").withColumn("ratio", F.try_divide("vector_acres", "raster_acres"))
    return j.withColumn("stale", F.coalesce(~F.col("ratio").between(low, high), F.lit(True)))
