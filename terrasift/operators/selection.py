"""Choosing acquisition windows and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import month_day


def choose(scores: DataFrame, key: str, floor: float = 80.0, margin: float = 5.0) -> DataFrame:
    """Per key the chosen window: (key, rank, coverage, label).

    Scored windows with coverage of at least ``floor`` are eligible; the earliest within ``margin`` of the
    best eligible one is taken. If none is eligible, the largest coverage is, the earliest on ties, and the
    label says so; a null coverage counts as -1. Keys without a scored window give no row.
    """
    c = F.coalesce("coverage", F.lit(-1.0))
    s = scores.where(F.col("status") == "scored").withColumn("_c", c)
    best = s.groupBy(key).agg(F.max(F.when(F.col("_c") >= floor, F.col("_c"))).alias("_best"), F.max_by("rank", F.struct("_c", -F.col("rank"))).alias("_fallback"))
    j = s.join(best, key)
    ok = F.when(F.col("_best").isNotNull(), (F.col("_c") >= floor) & (F.col("_c") >= F.col("_best") - margin)).otherwise(F.col("rank") == F.col("_fallback"))
    pick = j.where(ok).groupBy(key).agg(F.min_by(F.struct("rank", "coverage", "_best"), "rank").alias("p"))
    return pick.select(key, "p.rank", "p.coverage", F.when(F.col("p._best").isNull(), "below floor").otherwise("ok").alias("label"))


def blocking(scores: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """(key, n_unscored_before, verdict): does an unscored window that was preferred stand above the choice.

    ``error`` where nothing was scored and something is unscored, ``none`` where nothing is scored or
    unscored at all, ``warn`` where a preferred window is unscored, else ``ok``.
    """
    j = scores.join(chosen.select(key, F.col("rank").alias("_chosen")), key, "left")
    g = j.groupBy(key).agg(F.max("_chosen").alias("_chosen"), F.count_if((F.col("status") == "unscored") & (F.col("rank") < F.col("_chosen"))).alias("n_unscored_before"), F.count_if(F.col("status") == "unscored").alias("_u"))
    verdict = F.when(F.col("_chosen").isNull() & (F.col("_u") > 0), "error").when(F.col("_chosen").isNull(), "none").when(F.col("n_unscored_before") > 0, "warn").otherwise("ok")
    return g.select(key, "n_unscored_before", verdict.alias("verdict"))


def expanded(scores: DataFrame, key: str, days: int, times: int = 3) -> DataFrame:
    """(key, k, start, end) of the leading window widened by k * days on each side, where nothing was scored."""
    g = scores.groupBy(key).agg(F.count_if(F.col("status") == "scored").alias("_s"), F.min_by("start", "rank").alias("start")).where("_s = 0")
    k = F.explode(F.sequence(F.lit(1), F.lit(times)))
    return g.select(key, k.alias("k"), "start").select(key, "k", F.date_sub("start", F.col("k") * days).alias("w_start"), F.date_add("start", F.col("k") * days).alias("w_end"))


def from_rank(scores: DataFrame, first: int) -> DataFrame:
    """Windows from a preferred place on."""
    return scores.where(F.col("rank") >= first)


def resolved_windows(presets: DataFrame, year: Column) -> DataFrame:
    """MM-DD windows of a preset as dates of a year; February 29 becomes the month's last day."""
    return presets.select("*", month_day(year, F.col("from_md")).alias("w_start"), month_day(year, F.col("to_md")).alias("w_end"))


def contract(selected: DataFrame, trained: DataFrame, key: str) -> DataFrame:
    """(key, missing, extra, same_order): how the selected dates differ from those a model was trained on."""
    j = selected.join(trained, key)
    miss, extra = F.array_except("trained", "selected"), F.array_except("selected", "trained")
    return j.select(key, F.array_sort(miss).alias("missing"), F.array_sort(extra).alias("extra"), (F.col("trained") == F.col("selected")).alias("same_order"))


def greedy_dates(cover: DataFrame, key: str, date: str, cell: str, n: int = 2) -> DataFrame:
    """(key, place, date, added): dates taken one by one, each the one that adds most uncovered cells.

    Ties go to the earlier date. Each round is one aggregation over what is still uncovered.
    """
    left = cover.select(key, date, cell).distinct()
    taken = None
    for k in range(1, n + 1):
        gain = left.groupBy(key, date).agg(F.count(F.lit(1)).alias("added"))
        w = Window.partitionBy(key).orderBy(F.desc("added"), date)  # as many rows as a key has dates
        best = gain.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(key, F.lit(k).alias("place"), date, "added")
        taken = best if taken is None else taken.unionByName(best)
        gone = left.join(best.select(key, date), [key, date], "left_semi").select(key, cell)
        left = left.join(gone, [key, cell], "left_anti")
    return taken
