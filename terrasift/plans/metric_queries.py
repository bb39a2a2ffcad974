"""Queries of the run-metric analytics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import metrics as M
from ..sources import rasters as X
from ..sources.tables import sample_time, table
from .core_problems import TIMED

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples once each, with their time."""
    s = sample_time(table(spark, d, "metric_samples").select("sample_id", "run_id", "elapsed_s", "t_epoch", "stage", "rss_tree_mb", "cpu_tree_pct", "net_recv_mb", "outdir_mb"), table(spark, d, "runs"))
    return s.where("t_cs is not null").dropDuplicates(["sample_id"])


def _calls(spark: SparkSession, d: str) -> DataFrame:
    cs = lambda c: F.round(F.col(c) * 100).cast("long")
    e = table(spark, d, "stage_events").dropDuplicates(["event_id"])
    return e.select("event_id", "run_id", F.lower(F.trim(F.regexp_replace("stage", r"[\s-]+", "_"))).alias("call"), cs("start_s").alias("s_cs"), cs("end_s").alias("e_cs"), "duration_s", "peak_rss_mb_during", "error")


_S = f"{TIMED.strip()}, smp as (select distinct on (sample_id) * from timed where t_cs is not null)"
_C = r"calls as (select distinct on (event_id) event_id, run_id, lower(trim(regexp_replace(stage, '[\s-]+', '_', 'g'))) as call, cast(round(start_s * 100) as bigint) as s_cs, cast(round(end_s * 100) as bigint) as e_cs, duration_s, peak_rss_mb_during, error from stage_events)"


@query("h_interval_stats", f"""with {_S}, {_C}, j as (select c.event_id, s.* from smp s join calls c on s.run_id = c.run_id and s.t_cs between c.s_cs and c.e_cs)
  select event_id, count(*) as n, arg_min_null(rss_tree_mb, (t_cs, sample_id)) as first_mb, arg_max_null(rss_tree_mb, (t_cs, sample_id)) as last_mb, max(rss_tree_mb) as peak_mb, round(avg(cpu_tree_pct), 6) as mean_cpu, max(cpu_tree_pct) as max_cpu,
   round(arg_max_null(rss_tree_mb, (t_cs, sample_id)) - arg_min_null(rss_tree_mb, (t_cs, sample_id)), 6) as growth_mb from j group by 1 having count(*) >= 3""")  # fmt: skip
def h_interval_stats(spark, d):
    j = M.in_stages(_samples(spark, d), _calls(spark, d).select("event_id", "run_id", "s_cs", "e_cs"), "run_id")
    return M.stage_stats(j, ["event_id"]).withColumns({"mean_cpu": F.round("mean_cpu", 6), "growth_mb": F.round("growth_mb", 6)})


@query("h_nondecreasing", f"""with {_S}, l as (select run_id, rss_tree_mb as v, lag(rss_tree_mb) over (partition by run_id order by t_cs, sample_id) as p from smp)
  select run_id, count(*) as n, round(avg(case when p is not null and v is not null then cast(v >= p as integer) end), 6) as share from l group by 1""")
def h_nondecreasing(spark, d):
    return M.non_decreasing(_samples(spark, d), "run_id", "t_cs", "sample_id", "rss_tree_mb").withColumn("share", F.round("share", 6))


_DIFF = "l as (select *, coalesce(net_recv_mb - lag(net_recv_mb) over (partition by run_id order by t_cs, sample_id), 0) as delta from smp)"


@query("h_diff", f"with {_S}, {_DIFF} select sample_id, round(delta, 6) as delta from l")
def h_diff(spark, d):
    return M.differences(_samples(spark, d), "run_id", "t_cs", "sample_id", "net_recv_mb").select("sample_id", F.round("delta", 6).alias("delta"))


@query("h_stalls", f"with {_S}, {_DIFF} select stage, count(*) filter (where cpu_tree_pct < 30 and delta < 1) as n_stalled, count(*) as n, round(count(*) filter (where cpu_tree_pct < 30 and delta < 1) / count(*), 6) as share from l group by 1")
def h_stalls(spark, d):
    x = M.differences(_samples(spark, d), "run_id", "t_cs", "sample_id", "net_recv_mb")
    return M.stalls(x, "stage", "cpu_tree_pct", "delta").withColumn("share", F.round("share", 6))


@query("h_running_max", f"with {_S} select sample_id, max(rss_tree_mb) over (partition by run_id order by t_cs, sample_id rows between unbounded preceding and current row) as so_far from smp")
def h_running_max(spark, d):
    return M.running_max(_samples(spark, d), "run_id", "t_cs", "sample_id", "rss_tree_mb").select("sample_id", "so_far")


@query("h_delta_events", f"""with {_C} select event_id, round(coalesce(peak_rss_mb_during - lag(peak_rss_mb_during) over (partition by run_id order by e_cs, event_id), 0), 6) as delta from calls where e_cs is not null and peak_rss_mb_during is not null""")
def h_delta_events(spark, d):
    c = _calls(spark, d).where("e_cs is not null and peak_rss_mb_during is not null")
    return M.differences(c, "run_id", "e_cs", "event_id", "peak_rss_mb_during").select("event_id", F.round("delta", 6).alias("delta"))


@query("h_log_parse", r"""select event_id, regexp_extract(error, '^(\w+): ', 1) as kind, try_cast(nullif(regexp_extract(error, ' (\d+) s', 1), '') as bigint) as seconds from stage_events where error is not null and regexp_matches(error, '^\w+: ') group by all""")
def h_log_parse(spark, d):
    e = table(spark, d, "stage_events").where(F.col("error").rlike(r"^\w+: "))
    sec = F.nullif(F.regexp_extract("error", r" (\d+) s", 1), F.lit("")).try_cast("long")
    return e.select("event_id", F.regexp_extract("error", r"^(\w+): ", 1).alias("kind"), sec.alias("seconds")).distinct()


@query("h_stage_summary", f"with {_C} select run_id, call, round(sum(duration_s), 4) as seconds, max(peak_rss_mb_during) as peak_mb, count(*) as n from calls group by all")
def h_stage_summary(spark, d):
    return _calls(spark, d).groupBy("run_id", "call").agg(F.round(F.sum("duration_s"), 4).alias("seconds"), F.max("peak_rss_mb_during").alias("peak_mb"), F.count(F.lit(1)).alias("n"))


@query("h_left_join_report", f"with {_C}, g as (select run_id, count(*) as n_calls from calls group by 1) select r.run_id, coalesce(r.district_name, '—') as district, coalesce(cast(g.n_calls as varchar), '—') as n_calls from runs r left join g on r.run_id = g.run_id")
def h_left_join_report(spark, d):
    g = _calls(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_calls"))
    return table(spark, d, "runs").join(g, "run_id", "left").select("run_id", F.coalesce("district_name", F.lit("—")).alias("district"), F.coalesce(F.col("n_calls").cast("string"), F.lit("—")).alias("n_calls"))


_STAGES = ["ndvi_acquire_stac", "ndvi_infer", "sieve", "vector_stage", "qc"]


@query("h_pivot_stage", f"with {_C} select run_id, {', '.join(f"round(sum(case when call = '{s}' then duration_s end), 4) as {s}" for s in _STAGES)} from calls group by 1")
def h_pivot_stage(spark, d):
    p = M.pivot_stages(_calls(spark, d), "run_id", "call", _STAGES, "duration_s")
    return p.select("run_id", *(F.round(s, 4).alias(s) for s in _STAGES))


@query("h_speedup", """with w as (select c_nationkey as k, o_orderkey % 4 + 1 as workers, o_orderkey, o_totalprice as wall from orders join customer on o_custkey = c_custkey), b as (select k, min(wall) as base from w where workers = 1 group by 1)
  select o_orderkey, round(base / wall, 6) as speedup from w left join b using (k)""")
def h_speedup(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    w = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").alias("k"), (F.col("o_orderkey") % 4 + 1).alias("workers"), "o_orderkey", F.col("o_totalprice").alias("wall"))
    return M.speedup(w, "k", "workers", "wall").select("o_orderkey", F.round("speedup", 6).alias("speedup"))


@query("h_slope", f"""with {_S}, g as (select run_id, min(t_cs) as x0, max(t_cs) as x1, arg_min(rss_tree_mb, (t_cs, rss_tree_mb)) as y0, arg_max(rss_tree_mb, (t_cs, rss_tree_mb)) as y1 from smp where rss_tree_mb is not null group by 1)
  select run_id, round(case when x1 > x0 then (y1 - y0) / (x1 - x0) end, 6) as slope, round(y1 + case when x1 > x0 then (y1 - y0) / (x1 - x0) end * (100000 - x1), 3) as at from g""".replace(" as at from g", " as extrapolated from g"))
def h_slope(spark, d):
    g = M.two_point_slope(_samples(spark, d).where("rss_tree_mb is not null"), "run_id", "t_cs", "rss_tree_mb", 100000)
    return g.select("run_id", F.round("slope", 6).alias("slope"), F.round("at", 3).alias("extrapolated"))


@query("h_reclaimed", f"""with {_S}, g as (select run_id, max(outdir_mb) as peak, arg_max(outdir_mb, (t_cs, sample_id)) as now from smp where outdir_mb is not null group by 1) select run_id, peak, now, round(case when peak <> 0 then 100 * (peak - now) / peak end, 6) as reclaimed_pct from g""")
def h_reclaimed(spark, d):
    return M.reclaimed(_samples(spark, d).where("outdir_mb is not null"), "run_id", "t_cs", "sample_id", "outdir_mb").withColumn("reclaimed_pct", F.round("reclaimed_pct", 6))


@query("h_source_delta", f"""with {X.SERIES_SQL}, o as (select 'red' as band, t % 2 as s, red as v from px_obs union all select 'nir', t % 2, nir from px_obs union all select 'ndvi', t % 2, v from ndvi_obs),
  g as (select band, avg(v) filter (where s = 0) as a, avg(v) filter (where s = 1) as b from o group by band) select band, round(a, 6) as mean_a, round(b, 6) as mean_b, round((b - a) / a, 6) as relative from g""")
def h_source_delta(spark, d):
    """Band and index means of two sources (here even and odd dates) and their relative difference; missing values don't count."""
    o = X.pixel_obs(spark, d).withColumn("ndvi", S.ndvi(F.col("red"), F.col("nir")))
    bands = F.array(*(F.struct(F.lit(c).alias("band"), F.col(c).alias("v")) for c in ("red", "nir", "ndvi")))
    g = o.select(F.col("t") % 2, F.inline(bands)).toDF("s", "band", "v").groupBy("band").agg(F.avg(F.when(F.col("s") == 0, F.col("v"))).alias("a"), F.avg(F.when(F.col("s") == 1, F.col("v"))).alias("b"))
    return g.select("band", F.round("a", 6).alias("mean_a"), F.round("b", 6).alias("mean_b"), F.round((F.col("b") - F.col("a")) / F.col("a"), 6).alias("relative"))
