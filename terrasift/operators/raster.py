"""Compositing, mosaicking, masking and comparing rasters as relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def date_windows(spark, start: str, end: str, step: int) -> DataFrame:
    """(k, w_start, w_end): half-open windows of ``step`` days, the last one cut off at ``end``."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = F.sequence(first, F.date_sub(last, 1), F.make_interval(days=F.lit(step)))
    return spark.range(1).select(F.posexplode(days).alias("k", "w_start")).withColumn("w_end", F.least(F.date_add("w_start", step), last))


def in_windows(df: DataFrame, day: str, start: str, end: str, step: int) -> DataFrame:
    """Adds the window of each row's date by arithmetic, so that no join is needed; rows outside drop out."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    d = df.where((F.col(day) >= first) & (F.col(day) < last)).withColumn("k", F.floor(F.datediff(F.col(day), first) / step).cast("int"))
    return d.withColumn("w_end", F.least(F.date_add(first, (F.col("k") + 1) * step), last))


def median_composite(obs: DataFrame, keys: Sequence[str], day: str, bands: Sequence[str], start: str, end: str, step: int) -> DataFrame:
    """Median of each band per key and window, labelled by the window's end; windows without data keep a row of nulls.

    The calendar comes from the arguments and has one row per window, so crossing it with the distinct
    keys makes exactly the rows of the result.
    """
    spark = obs.sparkSession
    m = in_windows(obs, day, start, end, step).groupBy(*keys, "w_end").agg(*(F.median(b).alias(b) for b in bands))
    ends = F.array(*(F.lit(r[0]) for r in date_windows(spark, start, end, step).select("w_end").orderBy("k").toLocalIterator()))
    full = obs.select(*keys).distinct().withColumn("w_end", F.explode(ends))
    return full.join(m, [*keys, "w_end"], "left")


def best_pixel(df: DataFrame, keys: Sequence[str], value: str, penalty: Column, order: str) -> DataFrame:
    """Per key the value of the lowest penalty among valid pixels; ties go to the smaller ``order``."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, F.struct(penalty, F.col(order))).alias(value))


def top_over_bottom(top: DataFrame, bottom: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    t, b = top.select(*keys, F.col(value).alias("_t")), bottom.select(*keys, F.col(value).alias("_b"))
    return t.join(b, [*keys], "full").select(*keys, F.coalesce("_t", "_b").alias(value))


def first_wins(tiles: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Mosaic: per cell the first tile with data; a cell without any data is null."""
    return tiles.groupBy(*keys).agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value))


def histogram(px: DataFrame, value: str) -> DataFrame:
    return px.groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def nearest_cell(row: Column, col: Column, scale: float, off_row: float = 0.0, off_col: float = 0.0) -> tuple[Column, Column]:
    """The source cell whose area holds the centre of a target cell of another resolution."""
    return F.floor((row + 0.5) * scale + off_row).cast("long"), F.floor((col + 0.5) * scale + off_col).cast("long")


def crop_mask(static: DataFrame, classes: DataFrame, crop: Sequence[int], scale: float) -> DataFrame:
    """(row, col) of static cells whose nearest class cell has a crop class: resampling is arithmetic, the mask an equi-join."""
    r, c = nearest_cell(F.col("row"), F.col("col"), scale)
    src = classes.where(F.col("cls").isin(*crop)).select(F.col("row").alias("_r"), F.col("col").alias("_c")).distinct()
    return static.select("row", "col", r.alias("_r"), c.alias("_c")).join(src, ["_r", "_c"], "left_semi").select("row", "col")


def masked_predict(static: DataFrame, mask: DataFrame, predicted: Column, background: int) -> DataFrame:
    """``predicted`` for masked pixels with data (any band not 0), the background class for the others."""
    s = static.join(mask.select("row", "col", F.lit(True).alias("_m")), ["row", "col"], "left")
    has = F.exists("b", lambda x: x != 0)
    return s.select("row", "col", F.when(F.col("_m") & has, predicted).otherwise(F.lit(background)).cast("int").alias("cls"))


def agreement(a: DataFrame, b: DataFrame, cls: int) -> DataFrame:
    """Pixel counts of one class in two maps: in both, in either, and their ratio."""
    x, y = a.where(F.col("cls") == cls).select("row", "col", F.lit(1).alias("_a")), b.where(F.col("cls") == cls).select("row", "col", F.lit(1).alias("_b"))
    j = x.join(y, ["row", "col"], "full")
    out = j.agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"), F.count(F.lit(1)).alias("either"), F.count("_a").alias("n_a"), F.count("_b").alias("n_b"))
    return out.withColumn("iou", F.try_divide(F.col("both").cast("double"), F.col("either")))


def band_delta(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Means and medians of one band in two rasters over the cells that both have."""
    j = a.select("row", "col", F.col(value).alias("_a")).join(b.select("row", "col", F.col(value).alias("_b")), ["row", "col"]).where("_a is not null and _b is not null")
    m = j.agg(F.count(F.lit(1)).alias("n"), F.avg("_a").alias("mean_a"), F.avg("_b").alias("mean_b"), F.median("_a").alias("median_a"), F.median("_b").alias("median_b"))
    return m.withColumn("mean_delta", F.col("mean_b") - F.col("mean_a")).withColumn("median_delta", F.col("median_b") - F.col("median_a"))


def coverage(classes: DataFrame, aoi: DataFrame, crop: Sequence[int], limit: float = 0.90) -> DataFrame:
    """Kept and AOI pixel counts, their ratio, and what the guard says of it."""
    j = aoi.select("row", "col").join(classes, ["row", "col"], "left")
    n = j.agg(F.count_if(F.col("cls").isin(*crop)).alias("kept"), F.count(F.lit(1)).alias("aoi_px"))
    share = F.try_divide(F.col("kept").cast("double"), F.col("aoi_px"))
    return n.select("kept", "aoi_px", share.alias("share"), F.when(F.col("kept") == 0, "empty").when(share >= limit, "degenerate").otherwise("ok").alias("verdict"))


def rank_dates(scenes: DataFrame, key: str, n: int = 2) -> DataFrame:
    """The first ``n`` distinct days per key by penalty from the least cloudy scene.

    Scenes are first reduced to one per key and day, so the window sees at most the days of a key.
    """
    anchor = scenes.groupBy(key).agg(F.min_by("day", F.struct("cloud", "scene_id")).alias("_anchor"))
    p = scenes.join(anchor, key).withColumn("penalty", S.penalty(F.col("day"), F.col("_anchor"), F.col("cloud")))
    per_day = p.groupBy(key, "day").agg(F.min("penalty").alias("penalty"))
    w = Window.partitionBy(key).orderBy("penalty", "day")
    return per_day.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
