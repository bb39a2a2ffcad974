"""Crop presets as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import month_day

SCHEMA = (
    "crop string, classes array<int>, positive int, crop_label int, background int, label int, from_year int, from_md string, to_year int, to_md string, "
    "look_from_year int, look_from_md string, look_to_year int, look_to_md string, step int, sieve_px int, least_acres double"
)
# fixed values: per crop the classes; positive, crop, background and polygon label; start and end of the series and of
# the inference window as year offset and month-day; step in days, sieve size in pixels, smallest polygon in acres
PRESETS = [
    ("cane", [1], 1, 1, 4, 1, -1, "12-24", 0, "11-17", 0, "01-01", 0, "11-15", 8, 20, 0.5),
    ("spr_maize", [1, 4, 5, 6, 7], 1, 1, 8, 3015, -1, "12-24", 0, "07-17", 0, "01-01", 0, "07-15", 8, 20, 0.5),
    ("wheat", [14], 1, 1, 4, 14, -1, "08-24", 0, "07-01", -1, "09-01", 0, "06-30", 8, 20, 0.5),
    ("cotton", [1], 1, 1, 4, 1, 0, "03-24", 0, "12-29", 0, "04-01", 0, "12-29", 8, 20, 0.5),
    ("rice", [1], 1, 1, 4, 1, 0, "05-24", 0, "12-01", 0, "06-01", 0, "11-30", 5, 20, 0.5),
]
# fixed values: static windows by preference; the region is null where one list serves all
WINDOWS = [
    ("cane", None, 1, "11-07", "11-15"), ("cane", None, 2, "11-01", "11-06"), ("cane", None, 3, "10-15", "10-31"), ("cane", None, 4, "11-16", "11-25"),
    ("spr_maize", None, 1, "05-01", "05-10"), ("spr_maize", None, 2, "04-20", "04-30"), ("spr_maize", None, 3, "05-11", "05-20"),
    ("wheat", None, 1, "02-10", "02-25"), ("wheat", None, 2, "01-25", "02-10"), ("wheat", None, 3, "02-26", "03-10"), ("wheat", None, 4, "03-11", "03-20"),
    ("wheat", "punjab", 1, "02-10", "02-25"), ("wheat", "punjab", 2, "01-25", "02-10"), ("wheat", "punjab", 3, "02-26", "03-10"), ("wheat", "punjab", 4, "03-11", "03-20"),
    ("wheat", "sindh", 1, "02-01", "02-20"), ("wheat", "sindh", 2, "01-20", "01-31"), ("wheat", "sindh", 3, "02-21", "02-29"),
]
#: the crop whose model is bound to dates: every step from the first day of its inference window to the last
PINNED = "cotton"


def presets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRESETS, SCHEMA)


def windows(spark: SparkSession, region: str | None = None) -> DataFrame:
    """(crop, rank, from_md, to_md) of a region; crops without lists by region keep their own. An unknown region is an error."""
    known = sorted({r for _, r, *_ in WINDOWS if r})
    if region is not None and region not in known:
        raise ValueError(f"unknown region {region!r}, known ones: {', '.join(known)}")
    own = {c for c, r, *_ in WINDOWS if r}
    rows = [(c, k, a, b) for c, r, k, a, b in WINDOWS if r == (region if region and c in own else None)]
    return spark.createDataFrame(rows, "crop string, rank int, from_md string, to_md string")


def with_series(jobs: DataFrame, spark: SparkSession, crop: str, year: str) -> DataFrame:
    """Jobs with the dates of their crop's series and its step.

    A crop that isn't known fails the query, naming those that are; a null crop leaves the dates null.
    """
    p = presets(spark)
    known = ", ".join(c for c, *_ in PRESETS)
    j = jobs.join(p, jobs[crop] == p.crop, "left").withColumn("_known", p.crop.isNotNull() | jobs[crop].isNull()).drop(p.crop)
    at = lambda y, md: month_day(F.col(year).try_cast("int") + F.col(y), F.col(md))
    step = F.when(F.col("_known"), F.col("step")).otherwise(F.raise_error(F.concat(F.lit("unknown crop "), F.col(crop), F.lit(f", known ones: {known}"))).cast("int"))
    return j.select(*jobs.columns, at("from_year", "from_md").alias("series_start"), at("to_year", "to_md").alias("series_end"), step.alias("step"), "label")


def pinned_dates(spark: SparkSession, year: int) -> DataFrame:
    """The dates that a date-bound model was trained on: its inference window in steps."""
    _, *_, y0, md0, y1, md1, step, _, _ = next(p for p in PRESETS if p[0] == PINNED)
    first, last = (month_day(F.lit(year + y), F.lit(md)) for y, md in ((y0, md0), (y1, md1)))
    return spark.range(1).select(F.explode(F.sequence(first, last, F.expr(f"interval {step} days"))).alias("day"))
