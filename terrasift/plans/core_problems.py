"""Queries p1 to p5 over the run-metric tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals, nested, regular_grid, spikes
from ..sources.tables import sample_time, table
from ..streaming import nearest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


TIMED = """
timed as (
  select m.*, coalesce(cast(round(m.elapsed_s * 100) as bigint), cast(round((case when m.t_epoch > 1e17 then m.t_epoch / 1e9 when m.t_epoch > 1e14 then m.t_epoch / 1e6
    when m.t_epoch > 1e11 then m.t_epoch / 1e3 else m.t_epoch end - r.t0_epoch) * 100) as bigint)) as t_cs
  from metric_samples m left join (select run_id, max(t0_epoch) as t0_epoch from runs group by run_id) r on m.run_id = r.run_id)"""


@query("p1_found")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    s = sample_time(table(spark, d, "metric_samples").select("sample_id", "run_id", "host", "elapsed_s", "t_epoch", "ingest_ts", *spikes.METRICS), table(spark, d, "runs"))
    return spikes.find(s, table(spark, d, "hosts")).select("sample_id", "metric").distinct()


P2_SQL = """
with e as (select distinct run_id, cast(round(start_s * 100) as bigint) as s, cast(round(end_s * 100) as bigint) as e from stage_events
           where run_id is not null and start_s is not null and end_s > start_s),
     m as (select *, max(e) over (partition by run_id order by s, e rows between unbounded preceding and 1 preceding) as p from e),
     l as (select *, sum(case when p is null or s > p then 1 else 0 end) over (partition by run_id order by s, e) as isl from m),
     per as (select run_id, isl, min(s) as a, max(e) as b from l group by run_id, isl),
     gap as (select run_id, lag(b) over (partition by run_id order by a) as a, a as b from per)
select run_id, 'period' as span_kind, a as from_cs, b as to_cs from per
union all select run_id, 'gap' as span_kind, a as from_cs, b as to_cs from gap where a is not null"""


@query("p2_found", P2_SQL)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    cs = lambda c: F.round(F.col(c) * 100).cast("long")
    e = table(spark, d, "stage_events").select("run_id", cs("start_s").alias("s"), cs("end_s").alias("e"))
    return intervals.periods_and_gaps(e, "run_id", "s", "e")


P3_SQL = f"""
with {TIMED.strip()},
     s as (select distinct run_id, sample_id, t_cs from timed where t_cs is not null and run_id is not null),
     b as (select event_id, run_id, 'start' as edge, cast(round(start_s * 100) as bigint) as b_cs from stage_events where start_s is not null
           union select event_id, run_id, 'end' as edge, cast(round(end_s * 100) as bigint) as b_cs from stage_events where end_s is not null)
select event_id, edge, arg_min(sample_id, abs(t_cs - b_cs) * 100000000000000 + t_cs) as sample_id
from b join s on b.run_id = s.run_id and s.t_cs between b.b_cs - 100 and b.b_cs + 100 group by event_id, edge"""


@query("p3_found", P3_SQL)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    samples = sample_time(table(spark, d, "metric_samples").select("sample_id", "run_id", "elapsed_s", "t_epoch"), table(spark, d, "runs"))
    return nearest.nearest_samples(spark, nearest.bounds(table(spark, d, "stage_events")), samples, tolerance_cs=100)


P4_SQL = f"""
with {TIMED.strip()},
     t as (select run_id, t_cs // 200 as slot, rss_tree_mb from timed where run_id is not null and t_cs >= 0),
     e as (select run_id, max(slot) as e from t group by run_id),
     g as (select run_id, unnest(range(0, e + 1)) as slot_no from e)
select g.run_id, cast(g.slot_no as bigint) as slot_no from g where not exists (select 1 from t where t.run_id = g.run_id and t.slot = g.slot_no and t.rss_tree_mb is not null)"""


def _grid(spark: SparkSession, d: str) -> DataFrame:
    s = sample_time(table(spark, d, "metric_samples").select("run_id", "elapsed_s", "t_epoch", "rss_tree_mb"), table(spark, d, "runs"))
    return regular_grid.to_grid(s, "run_id", "t_cs", "rss_tree_mb", 200)


@query("p4_found", P4_SQL)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d).where("how <> 'reading'").select("run_id", "slot_no")


P4_GRID_SQL = f"""
with {TIMED.strip()},
     t as (select run_id, t_cs // 200 as slot, t_cs, rss_tree_mb as v from timed where run_id is not null and t_cs >= 0),
     e as (select run_id, max(slot) as e from t group by run_id),
     g as (select run_id, unnest(range(0, e + 1)) as slot_no from e),
     r as (select run_id, slot, v from (select *, row_number() over (partition by run_id, slot order by t_cs desc, v desc) as n from t where v is not null) where n = 1),
     j as (select g.run_id, g.slot_no, r.v, case when r.v is not null then g.slot_no end as pos from g left join r on g.run_id = r.run_id and g.slot_no = r.slot),
     f as (select *, last_value(pos ignore nulls) over w as la, last_value(v ignore nulls) over w as lv, first_value(pos ignore nulls) over x as na, first_value(v ignore nulls) over x as nv
           from j window w as (partition by run_id order by slot_no rows between unbounded preceding and 1 preceding), x as (partition by run_id order by slot_no rows between 1 following and unbounded following))
select run_id, cast(slot_no as bigint) as slot_no, v as reading,
  round(coalesce(v, lv + (nv - lv) * (cast(slot_no - la as double) / cast(na - la as double)), lv, nv), 4) as filled,
  case when v is not null then 'reading' when lv is not null and nv is not null then 'between' when lv is not null then 'after' when nv is not null then 'before' else 'none' end as how from f"""


@query("p4_grid", P4_GRID_SQL)
def p4_grid(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d).withColumn("filled", F.round("filled", 4))


def _payloads(spark: SparkSession, d: str) -> DataFrame:
    """A payload delivered twice counts once: its earliest delivery. Rows without a payload_id are left out."""
    p = table(spark, d, "config_payloads").select("payload_id", "payload", "received_at").where("payload_id is not null")
    at = F.coalesce("received_at", F.lit("9999-12-31").cast("timestamp"))
    return p.groupBy("payload_id").agg(F.min_by("payload", F.struct(at, "payload")).alias("payload"))


@query("p5_found")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.leaves(_payloads(spark, d), "payload", ["payload_id"])


@query("p5_attempts")
def p5_attempts(spark: SparkSession, d: str) -> DataFrame:
    return nested.attempts_table(_payloads(spark, d), "payload", ["payload_id"])


@query("p5_windows")
def p5_windows(spark: SparkSession, d: str) -> DataFrame:
    return nested.windows_table(_payloads(spark, d), "payload", ["payload_id"])
