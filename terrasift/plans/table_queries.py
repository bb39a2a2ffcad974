"""Queries of set operations, look-ups, run resolution and text scalars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources import files, presets
from ..sources import rasters as X
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


_PRESET_SQL = "p(crop, label, y0, md0, y1, md1, step) as (values " + ", ".join(f"('{c}', {lab}, {a}, '{m}', {b}, '{n}', {s})" for c, _, _, _, _, lab, a, m, b, n, _, _, _, _, s, _, _ in presets.PRESETS) + ")"


def _md_sql(y: str, md: str) -> str:
    first = f"make_date({y}, {md}[1:2]::int, 1)"
    return f"strftime(least({first} + ({md}[4:5]::int - 1), last_day({first})), '%Y-%m-%d')"


@query("preset_lookup", f"""with {_PRESET_SQL}, r as (select run_id, crop, try_cast(crop_year as integer) as y from runs)
  select r.run_id, {_md_sql('y + y0', 'md0')} as series_start, {_md_sql('y + y1', 'md1')} as series_end, step, label from r left join p on r.crop = p.crop""")
def preset_lookup(spark, d):
    r = presets.with_series(table(spark, d, "runs").select("run_id", "crop", "crop_year"), spark, "crop", "crop_year")
    return r.select("run_id", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("series_start", "series_end")), "step", "label")


_WINDOW_SQL = "w(crop, rank, md0, md1) as (values " + ", ".join(f"('{c}', {k}, '{a}', '{b}')" for c, r, k, a, b in presets.WINDOWS if r is None) + ")"


@query("preset_windows", f"""with {_WINDOW_SQL}, r as (select run_id, crop, try_cast(crop_year as integer) as y from runs)
  select r.run_id, w.rank, {_md_sql('y', 'md0')} as w_start, {_md_sql('y', 'md1')} as w_end from r join w on r.crop = w.crop where y is not null""")
def preset_windows(spark, d):
    from ..operators.selection import resolved_windows

    r = table(spark, d, "runs").select("run_id", "crop", F.col("crop_year").try_cast("int").alias("y")).where("y is not null")
    j = resolved_windows(r.join(presets.windows(spark), "crop"), F.col("y"))
    return j.select("run_id", "rank", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("w_start", "w_end")))


@query("latest_run", "select crop, district_name, max(run_id) as latest, max(run_id) + 1 as next from runs group by all")
def latest_run(spark, d):
    return table(spark, d, "runs").groupBy("crop", "district_name").agg(F.max("run_id").alias("latest"), (F.max("run_id") + 1).alias("next"))


@query("run_folders", "select stage, max(n) as latest, count(*) as n_runs from (select 'ndvi' as stage, cast(run_id as integer) as n from runs where run_id % 2 = 0) group by 1")
def run_folders(spark, d):
    p = table(spark, d, "runs").select(F.concat(F.when(F.col("run_id") % 2 == 0, "/out/ndvi").otherwise("/out/static"), F.lit("_run_"), F.col("run_id").cast("string"), F.when(F.col("run_id") % 3 == 0, "_tag").otherwise("")).alias("p"))
    return files.run_ids(p, "p", "ndvi").groupBy(F.lit("ndvi").alias("stage")).agg(F.max("run_id").alias("latest"), F.count(F.lit(1)).alias("n_runs"))


_SETS = "a as (select distinct tile, day from scene where cloud < 40), b as (select distinct tile, day from scene where scl < 6)"


@query("set_operations", f"""with {X.SCENES_SQL}, {_SETS} select 'union' as op, count(*) as n from (select * from a union select * from b) union all select 'except', count(*) from (select * from a except select * from b)
  union all select 'intersect', count(*) from (select * from a intersect select * from b)""")  # fmt: skip
def set_operations(spark, d):
    s = X.scenes(spark, d)
    a, b = s.where("cloud < 40").select("tile", "day"), s.where("scl < 6").select("tile", "day")
    out = None
    for op, x in (("union", a.union(b).distinct()), ("except", a.distinct().exceptAll(b.distinct())), ("intersect", a.intersect(b))):
        n = x.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("first_two_dates", f"with {X.SCENES_SQL}, x as (select distinct tile, day from scene where cloud < 80), r as (select *, row_number() over (partition by tile order by day) as k from x) select tile, strftime(day, '%d_%b_%Y') as day, cast(k as integer) as k from r where k <= 2")
def first_two_dates(spark, d):
    days = F.array_sort(F.collect_set("day"))  # at most the days of the archive
    s = X.scenes(spark, d).where("cloud < 80").groupBy("tile").agg(F.slice(days, 1, 2).alias("d"))
    return s.select("tile", F.posexplode("d").alias("k", "day")).select("tile", F.date_format("day", "dd_MMM_yyyy").alias("day"), (F.col("k") + 1).alias("k"))


@query("settings", """select o_orderkey, split_part(s, '=', 1) as name, substr(s, length(split_part(s, '=', 1)) + 2) as text, try_cast(substr(s, length(split_part(s, '=', 1)) + 2) as double) as number from
  (select o_orderkey, case o_orderkey % 3 when 0 then 'floor=' || o_custkey when 1 then 'label=a=b' || o_custkey else 'ratio=' || (o_custkey % 7) || '.5' end as s from orders)""")  # fmt: skip
def settings(spark, d):
    c = F.col("o_custkey").cast("string")
    s = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("floor="), c)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("label=a=b"), c)).otherwise(F.concat(F.lit("ratio="), (F.col("o_custkey") % 7).cast("string"), F.lit(".5")))
    parts = F.split("s", "=", 2)
    return table(spark, d, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", F.get(parts, F.lit(0)).alias("name"), F.get(parts, F.lit(1)).alias("text"), F.get(parts, F.lit(1)).try_cast("double").alias("number"))


@query("records", "select user_id, count(*) as n, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total, cast(max(json_array_length(json_array(event_type, value))) as bigint) as width from events group by 1")
def records(spark, d):
    e = table(spark, d, "events").select("user_id", F.from_json("props", "k bigint").alias("p"), F.to_json(F.array(F.col("event_type"), F.col("value").cast("string"))).alias("j"))
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("total"), F.max(F.json_array_length("j")).cast("long").alias("width"))


@query("h_tree_counter", """with e as (select event_id, ts, user_id, value, epoch(ts) as t from events), s as (select *, value - coalesce(lag(value) over (partition by user_id order by floor(t), event_id), 0) as step from e)
  select event_id, round(sum(step) over (order by floor(t), event_id rows between unbounded preceding and current row), 4) as total from s""")
def h_tree_counter(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "value", F.unix_timestamp("ts").alias("t"))
    return M.tree_counter(e, "user_id", "t", "event_id", "value").select("event_id", F.round("total", 4).alias("total"))


@query("path_forms", r"""with p as (select o_orderkey, o_orderkey % 4 as k, case o_orderkey % 4 when 0 then 'C:\a' || o_custkey || '\b' when 1 then '/mnt/d/x/' || o_custkey when 2 then '/e/y' || o_custkey else 'rel/z' || o_custkey end as s from orders)
  select o_orderkey, case k when 0 then s || '|/mnt/c/' || replace(s[4:], '\', '/') || '|/c/' || replace(s[4:], '\', '/') when 1 then s || '|D:\' || replace(s[8:], '/', '\') when 2 then s || '|E:\' || replace(s[4:], '/', '\') else s end as forms from p""")  # fmt: skip
def path_forms(spark, d):
    """Spellings of a path: as given, then a Windows path's WSL and Git-Bash forms or a mounted drive's Windows form."""
    from ..functions.scalars import clean_path, path_spellings

    c, k = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 4
    s = F.when(k == 0, F.concat(F.lit("C:\\a"), c, F.lit("\\b"))).when(k == 1, F.concat(F.lit("/mnt/d/x/"), c)).when(k == 2, F.concat(F.lit("/e/y"), c)).otherwise(F.concat(F.lit("rel/z"), c))
    t = table(spark, d, "orders").select("o_orderkey", clean_path(F.concat(F.lit(" r'"), s, F.lit("' "))).alias("s"))
    return t.select("o_orderkey", F.array_join(path_spellings(F.col("s")), "|").alias("forms"))


@query("path_repair", r"""select o_orderkey, 'C:\temp\new' || o_custkey as fixed from orders""")
def path_repair(spark, d):
    """Backslashes that were read as escapes, put back."""
    from ..functions.scalars import unescaped_path

    return table(spark, d, "orders").select("o_orderkey", unescaped_path(F.concat(F.lit("C:\temp\new"), F.col("o_custkey").cast("string"))).alias("fixed"))


@query("aoi_pixels")
def aoi_pixels(spark, d):
    """Pixels that each area of interest covers, by its projected area."""
    from ..operators.vector import pixel_estimate
    from .raster_queries import aoi_rings

    return pixel_estimate(aoi_rings(spark), 73.0, 31.0, 1e-4, 43)
