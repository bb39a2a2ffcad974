"""Rasters as relations, and the deterministic raster views of the plain test tables.

A raster source is a Parquet table of pixels or chips; a reader for one more format is a Spark Python
data source with the same columns. The views below give every raster operator an input of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

FIRST_DAY, STEP, DATES = "2025-01-01", 8, 32


def pixel_series(spark: SparkSession, d: str) -> DataFrame:
    """(row, col, dates, red, nir): 32 dates per pixel, nulls where nothing was observed."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    at = F.sequence(F.lit(0), F.lit(DATES - 1))
    value = lambda base, odd: F.transform(at, lambda t: F.when(F.abs(F.get(F.col("e"), 2 * t)) >= 0.02, base + 800 * F.get(F.col("e"), 2 * t + odd)))
    return e.select(
        F.floor(F.col("vec_id") / 25).cast("long").alias("row"), (F.col("vec_id") % 25).alias("col"),
        F.transform(at, lambda t: F.date_add(F.lit(FIRST_DAY).cast("date"), t * STEP)).alias("dates"), value(1000, 0).alias("red"), value(1400, 1).alias("nir"),
    )


def pixel_obs(spark: SparkSession, d: str) -> DataFrame:
    """(row, col, t, date, red, nir), one row per pixel and date."""
    s = pixel_series(spark, d)
    return s.select("row", "col", F.posexplode(F.arrays_zip("dates", "red", "nir")).alias("t", "o")).select("row", "col", "t", F.col("o.dates").alias("date"), F.col("o.red").alias("red"), F.col("o.nir").alias("nir"))


def ndvi_series(spark: SparkSession, d: str) -> DataFrame:
    """(row, col, dates, v): the vegetation index of every pixel and date."""
    from ..functions.scalars import ndvi_array

    return pixel_series(spark, d).select("row", "col", "dates", ndvi_array(F.col("red"), F.col("nir")).alias("v"))


def scenes(spark: SparkSession, d: str) -> DataFrame:
    """(scene_id, tile, ts, day, cloud, scl, qa, sensor, value)."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select(
        F.col("event_id").alias("scene_id"), F.col("user_id").alias("tile"), "ts", F.to_date("ts").alias("day"), F.pmod(F.col("value"), F.lit(100.0)).alias("cloud"),
        F.pmod(F.col("event_id"), F.lit(12)).cast("int").alias("scl"), F.coalesce(k, F.lit(0)).alias("qa"), F.col("event_type").alias("sensor"), "value",
    )


def class_map(spark: SparkSession, d: str, width: int = 100) -> DataFrame:
    """(row, col, cls): class 1 or 4, null where there is no data."""
    return table(spark, d, "events").select(
        F.floor(F.col("event_id") / width).cast("long").alias("row"), (F.col("event_id") % width).alias("col"),
        F.when(F.col("value") >= 5, F.when(F.col("event_type").isin("click", "view", "purchase"), 1).otherwise(4)).cast("int").alias("cls"),
    )


def static_pixels(spark: SparkSession, d: str) -> DataFrame:
    """(row, col, b): six positional bands; a pixel without data has all zeros."""
    e = table(spark, d, "embeddings").select("vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 6).alias("e"))
    b = F.when(F.col("vec_id") % 17 == 0, F.array_repeat(F.lit(0.0), 6)).otherwise(F.transform("e", lambda x: 2000 + 1000 * x))
    return e.select(F.floor(F.col("vec_id") / 25).cast("long").alias("row"), (F.col("vec_id") % 25).alias("col"), b.alias("b"))


def window_scores(spark: SparkSession, d: str) -> DataFrame:
    """(district, rank, start, status, coverage): four candidate windows per district."""
    o = table(spark, d, "orders").select(
        (F.col("o_custkey") % 50).alias("district"), (F.col("o_orderkey") % 4 + 1).alias("rank"), "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "empty").when(F.col("o_orderstatus") == "P", "unscored").otherwise("scored").alias("status"),
        F.when(F.col("o_orderkey") % 11 != 0, F.pmod(F.floor(F.col("o_totalprice")), F.lit(101)).cast("double")).alias("coverage"), F.to_date("o_orderdate").alias("start"),
    )
    return o.groupBy("district", "rank").agg(*(F.min_by(c, "o_orderkey").alias(c) for c in ("start", "status", "coverage")))


def job_results(spark: SparkSession, d: str) -> DataFrame:
    """(job, district, status, crop_acres, seconds)."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("job"), F.col("c_nationkey").alias("district"), F.when(F.col("o_orderstatus") == "F", "failed: tile").otherwise("ok").alias("status"),
        F.col("o_totalprice").alias("crop_acres"), F.when(F.col("o_orderkey") % 5 != 0, F.pmod(F.col("o_totalprice"), F.lit(300.0))).alias("seconds"),
    )


# the same views in SQL
SERIES_SQL = """px_obs as (select vec_id // 25 as "row", vec_id % 25 as col, t, cast(date '2025-01-01' + cast(8 * t as integer) as date) as date,
  case when abs(embedding[2 * t + 1]) >= 0.02 then 1000 + 800 * cast(embedding[2 * t + 1] as double) end as red,
  case when abs(embedding[2 * t + 1]) >= 0.02 then 1400 + 800 * cast(embedding[2 * t + 2] as double) end as nir
  from embeddings, (select unnest(range(0, 32)) as t)),
ndvi_obs as (select *, case when nir + red > 0 then (nir - red) / (nir + red) end as v from px_obs)"""
SCENES_SQL = """scene as (select event_id as scene_id, user_id as tile, ts, cast(ts as date) as day, value % 100.0 as cloud, cast(event_id % 12 as integer) as scl,
  coalesce(cast(json_extract_string(props, '$.k') as integer), 0) as qa, event_type as sensor, value from events)"""
CLASS_SQL = """class_px as (select event_id // 100 as "row", event_id % 100 as col, case when value >= 5 then case when event_type in ('click', 'view', 'purchase') then 1 else 4 end end as cls from events)"""
STATIC_SQL = """static_px as (select vec_id // 25 as "row", vec_id % 25 as col, case when vec_id % 17 = 0 then [0.0::double, 0.0, 0.0, 0.0, 0.0, 0.0]
  else [2000 + 1000 * cast(embedding[i] as double) for i in range(1, 7)] end as b from embeddings)"""
WINDOWS_SQL = """score as (select o_custkey % 50 as district, o_orderkey % 4 + 1 as rank, arg_min(cast(o_orderdate as date), o_orderkey) as start,
  arg_min(case o_orderstatus when 'F' then 'empty' when 'P' then 'unscored' else 'scored' end, o_orderkey) as status,
  arg_min_null(case when o_orderkey % 11 <> 0 then cast(cast(floor(o_totalprice) as bigint) % 101 as double) end, o_orderkey) as coverage from orders group by 1, 2)"""
JOBS_SQL = """job as (select o_orderkey as job, c_nationkey as district, case when o_orderstatus = 'F' then 'failed: tile' else 'ok' end as status, o_totalprice as crop_acres,
  case when o_orderkey % 5 <> 0 then o_totalprice % 300.0 end as seconds from orders join customer on o_custkey = c_custkey)"""
