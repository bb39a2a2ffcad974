"""Tables of a data folder and the columns derived from them that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 from seconds, milli-, micro- or nanoseconds (told apart by size)."""
    return F.when(c > 1e17, c / 1e9).when(c > 1e14, c / 1e6).when(c > 1e11, c / 1e3).otherwise(c)


def sample_time(samples: DataFrame, runs: DataFrame) -> DataFrame:
    """Adds ``t_cs``: whole hundredths of a second since the run's t0; ``elapsed_s`` and ``t_epoch`` go.

    ``elapsed_s`` counts where present, else ``t_epoch - t0_epoch``. Rows for which neither is known
    keep a null ``t_cs``. Only the few rows without ``elapsed_s`` are joined to their run; the others are
    read past the join, so they are neither shuffled nor gathered under a null key.
    """
    rest = [c for c in samples.columns if c not in ("elapsed_s", "t_epoch")]
    t0 = runs.where("run_id is not null").groupBy(F.col("run_id").alias("_run")).agg(F.max("t0_epoch").alias("_t0"))
    direct = samples.where("elapsed_s is not null").select(*rest, F.round(F.col("elapsed_s") * 100).cast("long").alias("t_cs"))
    late = samples.where("elapsed_s is null").withColumnRenamed("run_id", "_r").join(t0, F.col("_r") == F.col("_run"), "left").withColumnRenamed("_r", "run_id")
    since = (epoch_seconds(F.col("t_epoch")) - F.col("_t0")) * 100
    return direct.unionByName(late.select(*rest, F.round(since).cast("long").alias("t_cs")))
