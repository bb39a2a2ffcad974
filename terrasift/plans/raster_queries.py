"""Queries of the raster operators over the raster views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import components as C
from ..operators import quality as Q
from ..operators import raster as R
from ..operators import selection as W
from ..operators import smoothing as N
from ..operators import trees as T
from ..operators import vector as V
from ..sources import rasters as X
from ..sources.tables import table
from . import stages as G

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: tuple[str, ...] = ()):
    """Registers a query and its SQL; dates come out as text, which every client reads alike."""

    def add(f):
        QUERIES[name] = (lambda spark, d: f(spark, d).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})) if dates else f
        if sql:
            ORACLE[name] = f"select * replace ({', '.join(f'strftime({c}, \'%Y-%m-%d\') as {c}' for c in dates)}) from ({sql})" if dates else sql
        return f

    return add


def q6(c, name: str):
    return F.round(c, 6).alias(name)


# ---- projections and filters on pixel series


@query(
    "band_parse",
    """with d as (select o_orderkey, case o_orderkey % 5 when 0 then 'red_' when 1 then 'B4_' when 2 then 'nir_' when 3 then 'B8_' else 'qa_' end || strftime(o_orderdate, '%Y_%m_%d') as s from orders)
    select o_orderkey, case when s[1:3] in ('red', 'B4_') then 'red' when s[1:3] in ('nir', 'B8_') then 'nir' end as kind, case when s[1:3] <> 'qa_' then cast(strptime(regexp_extract(s, '\\d{4}_\\d{2}_\\d{2}'), '%Y_%m_%d') as date) end as day from d""", dates=("day",))
def band_parse(spark, d):
    k = F.col("o_orderkey") % 5
    head = F.when(k == 0, "red_").when(k == 1, "B4_").when(k == 2, "nir_").when(k == 3, "B8_").otherwise("qa_")
    s = table(spark, d, "orders").select("o_orderkey", F.concat(head, F.date_format("o_orderdate", "yyyy_MM_dd")).alias("s"))
    return s.select("o_orderkey", S.band_kind(F.col("s")).alias("kind"), S.band_date(F.col("s")).alias("day"))


@query("ndvi", f"""with {X.SERIES_SQL} select "row", col, date, round(v, 6) as ndvi, case when v is not null then cast(least(65535, greatest(0, floor(v * 10000))) as integer) end as scaled from ndvi_obs""", dates=("date",))
def ndvi(spark, d):
    v = S.ndvi(F.col("red"), F.col("nir"))
    return X.pixel_obs(spark, d).select("row", "col", "date", q6(v, "ndvi"), F.when(v.isNotNull(), S.scaled_ndvi(v)).alias("scaled"))


_INSIDE = "date between date '2025-03-01' and date '2025-07-15'"


@query("inference_window", f"""with {X.SERIES_SQL} select "row", col, count(*) as n_dates, count(v) as n_values, round(sum(v), 6) as total from ndvi_obs where {_INSIDE} group by all""")
def inference_window(spark, d):
    s = X.ndvi_series(spark, d)
    z = F.filter(F.arrays_zip("dates", "v"), lambda p: p["dates"].between("2025-03-01", "2025-07-15"))
    s = s.select("row", "col", F.transform(z, lambda p: p["v"]).alias("w"))
    some = F.filter("w", lambda x: x.isNotNull())
    return s.select("row", "col", F.size("w").cast("long").alias("n_dates"), F.size(some).cast("long").alias("n_values"), q6(F.when(F.size(some) > 0, F.aggregate(some, F.lit(0.0), lambda a, x: a + x)), "total"))


@query("has_signal", f"""with {X.SERIES_SQL} select "row", col from ndvi_obs where {_INSIDE} group by all having count(case when v <> 0 then 1 end) > 0""")
def has_signal(spark, d):
    s = X.ndvi_series(spark, d)
    z = F.arrays_zip("dates", "v")
    return s.where(F.exists(z, lambda p: p["dates"].between("2025-03-01", "2025-07-15") & p["v"].isNotNull() & (p["v"] != 0))).select("row", "col")


@query("gap_pattern", f"""with {X.SERIES_SQL} select m as gap_mask, count(*) as n from (select "row", col, cast(sum(case when v is not null then 1::bigint << t else 0 end) as bigint) as m from ndvi_obs group by all) group by m""")
def gap_pattern(spark, d):
    return X.ndvi_series(spark, d).groupBy(S.gap_mask(F.col("v")).alias("gap_mask")).agg(F.count(F.lit(1)).alias("n"))


@query("flat_index", f"""with {X.CLASS_SQL} select "row", col, case when cls is not null then "row" * 100 + col else -1 end as idx from class_px""")
def flat_index(spark, d):
    return X.class_map(spark, d).select("row", "col", S.flat_index(F.col("row"), F.col("col"), 100, F.col("cls").isNotNull()).alias("idx"))


@query("harmonise_l8", """with d as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_suppkey * 7 % 65536 * 0.0000275::double - 0.2::double) * 10000 as b2, (l_suppkey * 31 % 65536 * 0.0000275::double - 0.2::double) * 10000 as b3,
   (l_partkey * 3 % 65536 * 0.0000275::double - 0.2::double) * 10000 as b4, (cast(floor(l_extendedprice) as bigint) % 65536 * 0.0000275::double - 0.2::double) * 10000 as b8 from lineitem),
  e as (select *, (b4 + b8) / 2 as b5, case when b4 + b8 > 0 then (b8 - b4) / (b4 + b8) * 10000 end as nd from d)
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, """ + ", ".join(f"cast(least(65535, greatest(0, floor({c}))) as integer) as {n}" for c, n in (("b2", "blue"), ("b3", "green"), ("b4", "red"), ("b5", "red_edge"), ("b8", "nir"))) + ", case when nd is not null then cast(least(65535, greatest(0, floor(nd))) as integer) end as ndvi from e")
def harmonise_l8(spark, d):
    bands = S.harmonised(F.col("l_suppkey") * 7 % 65536, F.col("l_suppkey") * 31 % 65536, F.col("l_partkey") * 3 % 65536, F.floor("l_extendedprice") % 65536)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", bands.alias("b")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "b.*")


@query("names", """select o_orderkey, 'composite_' || (o_custkey % 50) || '_' || year(o_orderdate) || '_' || strftime(o_orderdate, '%d_%b_%Y') || '_and_' || strftime(o_orderdate + interval 10 day, '%d_%b_%Y') as name from orders""")
def names(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", S.filled(F.lit("composite_{district}_{year}_{dates}"), {"district": F.col("o_custkey") % 50, "year": F.year(day), "dates": S.date_suffix(F.array(day, F.date_add(day, 10)))}).alias("name"))


@query("paths", """with p as (select o_orderkey, case o_orderkey % 3 when 0 then 'gs://bucket' || o_custkey || '/a/b' || o_orderkey || '.tif' when 1 then 'gs://b/x' || o_orderkey || '0000000000-0000002048.tif' else 'gs://b/x' || o_orderkey || '.tif' end as u from orders)
  select o_orderkey, split_part(u, '/', 3) as bucket, substr(u, length('gs://') + length(split_part(u, '/', 3)) + 2) as blob, o_orderkey % 3 > 0 as is_export from p""")  # fmt: skip
def paths(spark, d):
    k = F.col("o_orderkey").cast("string")
    u = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("gs://bucket"), F.col("o_custkey").cast("string"), F.lit("/a/b"), k, F.lit(".tif"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("gs://b/x"), k, F.lit("0000000000-0000002048.tif"))).otherwise(F.concat(F.lit("gs://b/x"), k, F.lit(".tif")))
    t = table(spark, d, "orders").select("o_orderkey", u.alias("u"))
    return t.select("o_orderkey", S.bucket_of(F.col("u")).alias("bucket"), S.blob_of(F.col("u")).alias("blob"), S.is_shard(S.blob_of(F.col("u")), F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).alias("is_export"))


# ---- scenes, windows, composites


@query("scene_filter", f"with {X.SCENES_SQL} select scene_id, tile, day from scene where day >= date '2024-01-05' and day < date '2024-01-20' and cloud < 80", dates=("day",))
def scene_filter(spark, d):
    return X.scenes(spark, d).where((F.col("day") >= "2024-01-05") & (F.col("day") < "2024-01-20") & (F.col("cloud") < S.SCENE_CLOUD_LIMIT)).select("scene_id", "tile", "day")


@query("scl_mask", f"with {X.SCENES_SQL} select tile, count(*) as n, count(*) filter (where scl not in (3, 8, 9, 10)) as n_clear from scene group by tile")
def scl_mask(spark, d):
    return X.scenes(spark, d).groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.count_if(S.clear_scl(F.col("scl"))).alias("n_clear"))


@query("qa_mask", f"with {X.SCENES_SQL} select tile, count(*) as n, count(*) filter (where qa & 24 = 0) as n_clear from scene group by tile")
def qa_mask(spark, d):
    return X.scenes(spark, d).groupBy("tile").agg(F.count(F.lit(1)).alias("n"), F.count_if(S.clear_qa(F.col("qa"))).alias("n_clear"))


_CAL = "(select k, date '2024-01-01' + cast(8 * k as integer) as w_start, least(date '2024-01-01' + cast(8 * k + 8 as integer), date '2024-01-30') as w_end from (select unnest(range(0, 4)) as k))"


@query("date_windows", f"select cast(k as integer) as k, cast(w_start as date) as w_start, cast(w_end as date) as w_end from {_CAL}", dates=("w_start", "w_end"))
def date_windows(spark, d):
    return R.date_windows(spark, "2024-01-01", "2024-01-30", 8)


@query("scene_window_join", f"with {X.SCENES_SQL} select scene_id, cast(k as integer) as k, cast(w_end as date) as w_end from scene join {_CAL} c on day >= w_start and day < w_end", dates=("w_end",))
def scene_window_join(spark, d):
    return R.in_windows(X.scenes(spark, d), "day", "2024-01-01", "2024-01-30", 8).select("scene_id", "k", "w_end")


@query("composite_median", f"""with {X.SCENES_SQL}, t as (select distinct tile from scene),
  m as (select tile, w_end, median(value) as value, median(cloud) as cloud from scene join {_CAL} c on day >= w_start and day < w_end where scl not in (3, 8, 9, 10) and cloud < 80 group by all)
  select t.tile, cast(c.w_end as date) as w_end, round(value, 6) as value, round(cloud, 6) as cloud from t cross join {_CAL} c left join m on m.tile = t.tile and m.w_end = c.w_end""", dates=("w_end",))  # fmt: skip
def composite_median(spark, d):
    s = X.scenes(spark, d)
    clear = S.clear_scl(F.col("scl")) & (F.col("cloud") < S.SCENE_CLOUD_LIMIT)
    s = s.select("tile", "day", *(F.when(clear, F.col(c)).alias(c) for c in ("value", "cloud")))
    return R.median_composite(s, ["tile"], "day", ["value", "cloud"], "2024-01-01", "2024-01-30", 8).select("tile", "w_end", q6("value", "value"), q6("cloud", "cloud"))


@query("best_pixel_mosaic", f"""with {X.SCENES_SQL}, p as (select *, abs(date_diff('day', date '2024-01-15', day)) + cloud / 5 as pen from scene where scl not in (3, 8, 9, 10))
  select tile, round(arg_min(value, (pen, scene_id)), 6) as value from p group by tile""")
def best_pixel_mosaic(spark, d):
    pen = S.penalty(F.col("day"), F.lit("2024-01-15").cast("date"), F.col("cloud"))
    return R.best_pixel(X.scenes(spark, d).where(S.clear_scl(F.col("scl"))), ["tile"], "value", pen, "scene_id").select("tile", q6("value", "value"))


@query("two_date_mosaic", f"""with {X.SCENES_SQL}, a as (select tile, max(value) as v from scene where day = date '2024-01-10' group by tile), b as (select tile, max(value) as v from scene where day = date '2024-01-12' group by tile)
  select coalesce(a.tile, b.tile) as tile, coalesce(a.v, b.v) as value from a full join b on a.tile = b.tile""")
def two_date_mosaic(spark, d):
    s = X.scenes(spark, d)
    one = lambda day: s.where(F.col("day") == day).groupBy("tile").agg(F.max("value").alias("value"))
    return R.top_over_bottom(one("2024-01-10"), one("2024-01-12"), ["tile"], "value")


@query("rank_dates", f"""with {X.SCENES_SQL}, a as (select tile, arg_min(day, (cloud, scene_id)) as anchor from scene group by tile),
  p as (select s.tile, s.day, min(abs(date_diff('day', anchor, day)) + cloud / 5) as penalty from scene s join a on s.tile = a.tile group by all),
  r as (select *, row_number() over (partition by tile order by penalty, day) as place from p) select tile, day, round(penalty, 6) as penalty, cast(place as integer) as place from r where place <= 2""", dates=("day",))  # fmt: skip
def rank_dates(spark, d):
    return R.rank_dates(X.scenes(spark, d), "tile").select("tile", "day", q6("penalty", "penalty"), "place")


# ---- class maps


@query("first_wins_mosaic", f"""with {X.CLASS_SQL}, t as (select "row" % 40 as "row", col, "row" // 40 as tile, cls from class_px) select "row", col, arg_min(cls, tile) as cls from t group by all""")
def first_wins_mosaic(spark, d):
    t = X.class_map(spark, d).select((F.col("row") % 40).alias("row"), "col", F.floor(F.col("row") / 40).alias("tile"), "cls")
    return R.first_wins(t, ["row", "col"], "cls", "tile")


@query("class_histogram", f"with {X.CLASS_SQL} select cls, count(*) as n from class_px group by cls")
def class_histogram(spark, d):
    return R.histogram(X.class_map(spark, d), "cls")


@query("label_check", f"""with {X.CLASS_SQL} select 'unexpected' as what, cast(cls as bigint) as label from (select distinct cls from class_px where cls is not null) where cls not in (1, 3) union all select 'absent', cast(x as bigint) from (select unnest([1, 3]) as x) where x not in (select cls from class_px where cls is not null)""")
def label_check(spark, d):
    seen = X.class_map(spark, d).agg(F.array_compact(F.collect_set("cls")).alias("s"))
    want = F.array(F.lit(1), F.lit(3))
    bad, none = F.transform(F.array_except("s", want), lambda x: F.struct(F.lit("unexpected").alias("what"), x.cast("long").alias("label"))), F.transform(F.array_except(want, "s"), lambda x: F.struct(F.lit("absent").alias("what"), x.cast("long").alias("label")))
    return seen.select(F.inline(F.concat(bad, none)))


@query("crop_mask_join", f"""with {X.CLASS_SQL}, {X.STATIC_SQL} select s."row", s.col from static_px s join class_px c on c."row" = cast(floor((s."row" + 0.5) * 2) as bigint) and c.col = cast(floor((s.col + 0.5) * 2) as bigint) where c.cls = 1""")
def crop_mask_join(spark, d):
    return R.crop_mask(X.static_pixels(spark, d), X.class_map(spark, d), [1], 2.0)


# fixed values: the rings of three areas in grid coordinates: convex, concave, with a hole
AOI = [
    (1, 0, [(5.0, 5.0), (60.0, 8.0), (55.0, 45.0), (10.0, 40.0), (5.0, 5.0)]),
    (2, 0, [(62.0, 50.0), (95.0, 50.0), (95.0, 95.0), (80.0, 60.0), (62.0, 95.0), (62.0, 50.0)]),
    (3, 0, [(5.0, 50.0), (45.0, 50.0), (45.0, 90.0), (5.0, 90.0), (5.0, 50.0)]),
    (3, 1, [(15.0, 60.0), (15.0, 80.0), (35.0, 80.0), (35.0, 60.0), (15.0, 60.0)]),
]
_SIDES_SQL = "sides(poly, x1, y1, x2, y2) as (values " + ", ".join(f"({p}, {a[0]}::double, {a[1]}::double, {b[0]}::double, {b[1]}::double)" for p, _, pts in AOI for a, b in zip(pts, pts[1:], strict=False)) + ")"


def aoi_rings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, r, k, x, y) for p, r, pts in AOI for k, (x, y) in enumerate(pts)], "poly int, ring int, seq int, x double, y double")


_IN_AOI_SQL = f"""{_SIDES_SQL}, in_aoi as (select "row", col, poly, cls from (select "row", col, cls, poly, count(*) filter (where (y1 <= "row" + 0.5) <> (y2 <= "row" + 0.5) and col + 0.5 < x1 + ("row" + 0.5 - y1) * (x2 - x1) / (y2 - y1)) as n
  from class_px, sides group by all) where n % 2 = 1)"""


@query("aoi_semi_join", f"""with {X.CLASS_SQL}, {_IN_AOI_SQL} select "row", col, poly from in_aoi""")
def aoi_semi_join(spark, d):
    return V.inside(X.class_map(spark, d), aoi_rings(spark)).select("row", "col", "poly")


@query("mask_coverage", f"""with {X.CLASS_SQL}, {_IN_AOI_SQL}, n as (select count(*) filter (where cls = 1) as kept, count(*) as aoi_px from in_aoi)
  select kept, aoi_px, round(kept / aoi_px, 6) as share, case when kept = 0 then 'empty' when kept / aoi_px >= 0.9 then 'degenerate' else 'ok' end as verdict from n""")
def mask_coverage(spark, d):
    c = X.class_map(spark, d)
    return R.coverage(c, V.inside(c, aoi_rings(spark)), [1]).select("kept", "aoi_px", q6("share", "share"), "verdict")


def _trees(features: int, rule: str, size: int = 3) -> list[T.Node]:
    """A small deterministic ensemble on vegetation indices: three trees of depth two."""
    out = []
    for t in range(size):
        f, g = (3 * t) % features, (5 * t + 2) % features
        a, b, c = (0.15 + 0.02 * t, 0.16, 0.18) if rule == "mean" else (2000.0 + 10 * t, 1990.0, 2010.0)
        leaf = ((0.9, 0.1), (0.4, 0.6), (0.45, 0.55), (0.8, 0.2)) if rule == "mean" else (0.6, -0.4, 0.3, -0.5)
        out += [T.Node(t, 0, f, a, 1, 2, 0), T.Node(t, 1, g, b, 3, 4, 0), T.Node(t, 2, g, c, 5, 6, 0), *(T.Node(t, 3 + k, -1, 0, 0, 0, leaf[k]) for k in range(4))]
    return out


def _tree_sql(nodes: list[T.Node], x: str, rule: str, out: int | None = None) -> list[str]:
    by = {(n.tree, n.node): n for n in nodes}
    op = "<" if rule == "sum" else "<="

    def go(t: int, k: int) -> str:
        n = by[t, k]
        return f"{n.leaf if out is None else n.leaf[out]}::double" if n.feature < 0 else f"(case when {x}[{n.feature + 1}] {op} {n.threshold}::double then {go(t, n.left)} else {go(t, n.right)} end)"

    return [go(t, 0) for t in sorted({n.tree for n in nodes})]


_RF = _trees(32, "mean")
_RF_SQL = f"""rf as (select "row", col, case when {" + ".join(_tree_sql(_RF, "f", "mean", 1))} > {" + ".join(_tree_sql(_RF, "f", "mean", 0))} then 4 else 1 end as cls
  from (select "row", col, list(coalesce(v, 0.0::double) order by t) as f, count(case when v <> 0 and {_INSIDE} then 1 end) as n from ndvi_obs group by all) where n > 0)"""


def _rf(spark, d):
    s = X.ndvi_series(spark, d)
    signal = F.exists(F.arrays_zip("dates", "v"), lambda p: p["dates"].between("2025-03-01", "2025-07-15") & p["v"].isNotNull() & (p["v"] != 0))
    f = F.transform("v", lambda x: F.coalesce(x, F.lit(0.0)))
    return s.where(signal).select("row", "col", T.expression(_RF, f, "mean", (1, 4)).alias("cls"))


@query("rf_predict", f'with {X.SERIES_SQL}, {_RF_SQL} select "row", col, cls from rf')
def rf_predict(spark, d):
    return _rf(spark, d)


@query("rf_predict_arrow", f'with {X.SERIES_SQL}, {_RF_SQL} select "row", col, cls from rf')
def rf_predict_arrow(spark, d):
    """The same forest through the scorer for large ones."""
    s = X.ndvi_series(spark, d)
    signal = F.exists(F.arrays_zip("dates", "v"), lambda p: p["dates"].between("2025-03-01", "2025-07-15") & p["v"].isNotNull() & (p["v"] != 0))
    return T.predict(s.where(signal).select("row", "col", "v"), _RF, "v", "mean", classes=(1, 4)).select("row", "col", "cls")


def grown(features: int, trees: int, depth: int, low: float, high: float) -> T.Ensemble:
    """A made-up forest of full trees: splits and class shares follow from the numbers of tree and node."""
    nodes = []
    for t in range(trees):
        for k in range(2 ** (depth + 1) - 1):
            h = (t * 2654435761 + k * 40503) % 10007 / 10007
            leaf = k >= 2**depth - 1
            nodes.append(T.Node(t, k, -1, 0.0, 0, 0, (h, 1 - h)) if leaf else T.Node(t, k, (7 * t + 13 * k) % features, low + h * (high - low), 2 * k + 1, 2 * k + 2, 0.0))
    return T.ensemble(nodes, "mean", (1, 4))


@query("rf_large")
def rf_large(spark, d):
    """A forest of 200 trees of depth eight over every series; tests hold the scorer against a descent node by node."""
    return T.predict(X.ndvi_series(spark, d).select("row", "col", "v"), grown(32, 200, 8, 0.1, 0.25), "v").select("row", "col", "cls")


_XGB = _trees(6, "sum")


@query("xgb_mask_predict", f"""with {X.CLASS_SQL}, {X.STATIC_SQL}, m as (select s.*, c.cls from static_px s left join class_px c on c."row" = s."row" * 2 + 1 and c.col = s.col * 2 + 1)
  select "row", col, case when cls = 1 and list_max([abs(x) for x in b]) > 0 and ({" + ".join(_tree_sql(_XGB, "b", "sum"))}) > 0 then 14 else 4 end as cls from m""")
def xgb_mask_predict(spark, d):
    s, c = X.static_pixels(spark, d), X.class_map(spark, d)
    p = F.when(T.expression(_XGB, F.col("b"), "sum") == 1, 14).otherwise(4)
    return R.masked_predict(s, R.crop_mask(s, c, [1], 2.0), p, 4)


_M32 = N.smoother(32)
_ROWS = "[" + ", ".join("[" + ", ".join(f"{x!r}::double" for x in r.tolist()) + "]" for r in _M32) + "]"


@query("whittaker_complete", f"""with {X.SERIES_SQL}, s as (select "row", col, list(red * 0.0001::double order by t) as y from (select "row", col, t, 1000 + 800 * cast(e as double) as red from
  (select vec_id // 25 as "row", vec_id % 25 as col, t, embedding[2 * t + 1] as e from embeddings, (select unnest(range(0, 32)) as t))) group by all)
  select "row", col, k as t, round(greatest(-1, least(1, list_sum([a * b for a, b in zip_list]))), 6) as z from (select "row", col, k, list_zip(m[k + 1], y) as zl, [x[1] * x[2] for x in list_zip(m[k + 1], y)] as zip_list from s, (select {_ROWS} as m), (select unnest(range(0, 32)) as k))""".replace("list_sum([a * b for a, b in zip_list])", "list_sum(zip_list)"))  # fmt: skip
def whittaker_complete(spark, d):
    e = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 25).cast("long").alias("row"), (F.col("vec_id") % 25).alias("col"), F.col("embedding").cast("array<double>").alias("e"))
    y = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda t: (1000 + 800 * F.get(F.col("e"), 2 * t)) * 0.0001)
    return e.select("row", "col", F.posexplode(N.smooth_complete(y, 32)).alias("t", "z")).select("row", "col", F.col("t").cast("long").alias("t"), q6("z", "z"))


@query("whittaker_gaps")
def whittaker_gaps(spark, d):
    return N.smooth(X.ndvi_series(spark, d).select("row", "col", F.col("v").cast("array<float>").alias("v")), "v").select("row", "col", F.posexplode("smooth").alias("t", "z"))


@query("entry", f"""with {X.SERIES_SQL}, {_RF_SQL}, {X.CLASS_SQL}, n as (select rf."row" // 5 as block, count(*) filter (where rf.cls = 1) as ndvi_px, count(*) filter (where rf.cls = 1 and c.cls = 1) as static_px
  from rf left join class_px c on c."row" = rf."row" and c.col = rf.col group by 1)
  select block, ndvi_px, static_px, round(case when ndvi_px > 0 then 100.0 * static_px / ndvi_px end, 6) as retention_pct from n""")  # fmt: skip
def flagship(spark, d):
    """Index, window, signal filter, ensemble, class counts and retention in one plan."""
    j = _rf(spark, d).join(X.class_map(spark, d).select("row", "col", F.col("cls").alias("s")), ["row", "col"], "left").withColumn("block", F.floor(F.col("row") / 5).cast("long"))
    j = j.withColumn("s", F.when(F.col("cls") == 1, F.col("s")))
    return Q.retention(j, "block", "cls", "s", [1]).withColumn("retention_pct", F.round("retention_pct", 6))


# ---- components and what follows


_COMP_SQL = f"""{X.CLASS_SQL}, px as (select "row" * 2147483648 + col as id, "row", col, cls from class_px where cls is not null),
  adj as (select a.id as a, b.id as b from px a join px b on b.id = a.id + 1 and a.cls = b.cls union all select b.id, a.id from px a join px b on b.id = a.id + 1 and a.cls = b.cls
   union all select a.id, b.id from px a join px b on b.id = a.id + 2147483648 and a.cls = b.cls union all select b.id, a.id from px a join px b on b.id = a.id + 2147483648 and a.cls = b.cls),
  lab(id, lab) using key (id) as (select id, id from px union select adj.b, min(l.lab) from lab l join adj on adj.a = l.id join recurring.lab o on o.id = adj.b where l.lab < o.lab group by adj.b)"""


@query("components", f"""with recursive {_COMP_SQL} select px."row", px.col, px.cls, lab.lab as comp from px join lab on px.id = lab.id""")
def components(spark, d):
    return C.components(X.class_map(spark, d), "cls", 4, 64).withColumn("cls", F.col("cls").cast("int"))


@query("component_sizes", f"""with recursive {_COMP_SQL} select n as size, count(*) as n_components from (select lab, count(*) as n from lab group by lab) group by n""")
def component_sizes(spark, d):
    c = C.components(X.class_map(spark, d), "cls", 4, 64)
    return c.groupBy("comp").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("n_components"))


_BESIDE = "(values (1), (-1), (2147483648), (-2147483648)) as t(d)"
_SIEVE_SQL = f"""{_COMP_SQL},
  sz as (select lab, count(*) as n, any_value(cls) as v from lab join px using (id) group by lab),
  nb as (select distinct x.lab as a, y.lab as b from lab x cross join {_BESIDE} join lab y on y.id = x.id + d where x.lab <> y.lab),
  pt as (select a as comp, arg_max(b, (z.n, -b)) as nxt from nb join sz z on z.lab = b join sz s on s.lab = a where s.n < 20 group by a),
  ch(comp, cur) as (select comp, nxt from pt union select c.comp, p.nxt from ch c join pt p on p.comp = c.cur),
  fin as (select comp, v from ch join sz on sz.lab = cur where n >= 20),
  sv as (select c."row", c.col, c.cls, coalesce(fin.v, c.cls) as sieved, c."row" * 2147483648 + c.col as id from class_px c left join lab on lab.id = c."row" * 2147483648 + c.col left join fin on fin.comp = lab.lab)"""


@query("sieve", f'with recursive {_SIEVE_SQL} select "row", col, cls, sieved from sv')
def sieve(spark, d):
    return C.sieve(X.class_map(spark, d), "cls", 20, 4, 64)


@query("sieve_revert", f"""with recursive {_SIEVE_SQL}, flip as (select id from sv where cls <> 1 and sieved = 1), near as (select f.id as a, g.id as b from flip f cross join {_BESIDE} join flip g on g.id = f.id + d),
  cl(id, lab) using key (id) as (select id, id from flip union select near.b, min(l.lab) from cl l join near on near.a = l.id join recurring.cl o on o.id = near.b where l.lab < o.lab group by near.b),
  bad as (select distinct cl.lab from cl cross join {_BESIDE} join sv o on o.id = cl.id + d where coalesce(o.cls <> 1, true) and o.id not in (select id from flip))
  select sv."row", sv.col, sv.cls, case when cl.lab in (select lab from bad) then sv.cls else sv.sieved end as sieved from sv left join cl on cl.id = sv.id""")
def sieve_revert(spark, d):
    chips = C.sieve_chips(C.to_chips(X.class_map(spark, d), ["cls"], 64), "cls", 20, 4, 64)
    out = C.from_chips(C.revert_chips(chips, "cls", "sieved", [1], 4, 64), ["cls", "sieved"], 64)
    return out.select("row", "col", F.col("cls").cast("int").alias("cls"), F.col("sieved").cast("int").alias("sieved"))


@query("dilation", f"""with {X.CLASS_SQL}, s as (select "row", col from class_px where cls = 4) select distinct "row" + dr as "row", col + dc as col from s, (values (0, 0), (0, 1), (1, 0), (0, -1), (-1, 0)) as t(dr, dc)""")
def dilation(spark, d):
    return C.dilated(X.class_map(spark, d).where("cls = 4"), 4)


def _comp(spark, d):
    return C.component_chips(C.to_chips(X.class_map(spark, d), ["cls"], 64), "cls", 4, 64)


_STATS_SQL = f"""with recursive {_COMP_SQL}, c as (select px."row" as r, px.col as c, px.cls, lab.lab as comp, px.id from px join lab on px.id = lab.id),
  s as (select c.comp, count(*) as n_sides from c cross join (values (1), (-1), (2147483648), (-2147483648)) as t(d) left join c o on o.id = c.id + d and o.comp = c.comp where o.id is null group by 1)
  select c.comp, c.cls, count(*) as n_px, min(r) as r_min, max(r) as r_max, min(c) as c_min, max(c) as c_max, any_value(n_sides) as n_sides from c join s on s.comp = c.comp group by 1, 2"""


@query("polygon_stats", _STATS_SQL)
def polygon_stats(spark, d):
    return C.polygon_stats_chips(_comp(spark, d), "cls", 73.0, 31.0, 1e-4, 43, 64).select("comp", F.col("cls").cast("int").alias("cls"), "n_px", "r_min", "r_max", "c_min", "c_max", "n_sides")


def _utm_sql(cells: str, zone: int) -> str:
    """Projected corners xy(r, c, x, y) of a table of corners, by the published series."""
    ep = S._E2 / (1 - S._E2)
    return f"""u as (select r, c, radians(31.0 - r * 0.0001::double) as phi, radians(73.0 + c * 0.0001::double - {zone * 6 - 183}) * cos(radians(31.0 - r * 0.0001::double)) as a from {cells}),
  w as (select *, tan(phi) * tan(phi) as t, {ep!r}::double * cos(phi) ** 2 as cc, {S._A} / sqrt(1 - {S._E2!r}::double * sin(phi) ** 2) as n from u),
  xy as (select r, c, 0.9996::double * n * (a + (1 - t + cc) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * {ep!r}::double) * a ** 5 / 120) - 880000 as x,
   0.9996::double * ({S._A} * ({S._M[0]!r}::double * phi - {S._M[1]!r}::double * sin(2 * phi) + {S._M[2]!r}::double * sin(4 * phi) - {S._M[3]!r}::double * sin(6 * phi)) + n * tan(phi) * (a * a / 2 + (5 - t + 9 * cc + 4 * cc * cc) * a ** 4 / 24
   + (61 - 58 * t + t * t + 600 * cc - 330 * {ep!r}::double) * a ** 6 / 720)) - 3430000 as y from w)"""


_AREA_SQL = f"""with recursive {_COMP_SQL}, c as (select px."row" as r, px.col as c, px.cls, lab.lab as comp, px.id from px join lab on px.id = lab.id),
  s as (select c.comp, c.r + a as r0, c.c + b as c0, c.r + e as r1, c.c + f as c1 from c cross join (values (-2147483648, 0, 0, 0, 1), (1, 0, 1, 1, 1), (2147483648, 1, 1, 1, 0), (-1, 1, 0, 0, 0)) as t(d, a, b, e, f) left join c o on o.id = c.id + d and o.comp = c.comp where o.id is null),
  k as (select distinct r0 as r, c0 as c from s), {_utm_sql('k', 42)}, ar as (select comp, abs(sum(p.x * q.y - q.x * p.y)) / 2 * 0.000247105::double as acres from s join xy p on p.r = r0 and p.c = c0 join xy q on q.r = r1 and q.c = c1 group by comp)
  select ar.comp, any_value(c.cls) as cls, count(*) as n_px, round(any_value(acres), 3) as acres from ar join c on c.comp = ar.comp where acres >= 0.5 group by ar.comp"""


@query("area_filter", _AREA_SQL)
def area_filter(spark, d):
    """Acres per outline in the fixed zone of reports, of at least half an acre."""
    return V.acres(C.polygon_stats_chips(_comp(spark, d), "cls", 73.0, 31.0, 1e-4, 42, 64)).select("comp", F.col("cls").cast("int").alias("cls"), "n_px", F.round("acres", 3).alias("acres"))


@query("polygonise")
def polygonise(spark, d):
    return C.polygonise_chips(_comp(spark, d), "cls", 73.0, 31.0, 1e-4, 64)


@query("dissolve", f"""with recursive {_COMP_SQL.replace("from class_px where cls is not null", "from (select row, col, 1 as cls from class_px where cls is not null)")} select lab.lab as comp, count(*) as n_px from lab group by 1""")
def dissolve(spark, d):
    one = X.class_map(spark, d).where("cls is not null").select("row", "col", F.lit(1).alias("cls"))
    return C.components(one, "cls", 4, 64).groupBy("comp").agg(F.count(F.lit(1)).alias("n_px"))


_MODEL = grown(17, 50, 6, 0.1, 0.25)


def _pipeline(spark, d):
    s = X.pixel_series(spark, d)
    px = G.classified(s, _MODEL, "2025-03-01", "2025-07-15").withColumn("tile", F.floor(F.col("row") / 20))
    return G.cleaned(G.mosaicked(px, "tile"), [1], 4, 4, 64)


@query("pipeline")
def pipeline(spark, d):
    """All stages: index, smoothing, window, forest, mosaic, sieve, revert, outlines, second map, retention."""
    chips = _pipeline(spark, d)
    layer = G.outlined(chips, [1], 1, 73.0, 31.0, 1e-3, 42, 0.5, 64)
    return G.assessed(layer, chips, X.class_map(spark, d), [1], 64).withColumn("acres", F.round("acres", 4))


@query("pipeline_layer")
def pipeline_layer(spark, d):
    """The result layer of the stages."""
    return G.outlined(_pipeline(spark, d), [1], 3015, 73.0, 31.0, 1e-3, 42, 0.5, 64)


# ---- vectors


@query("fishnet", """with b as (select c_nationkey as poly, min(c_acctbal) as x0, max(c_acctbal) as x1, min(c_custkey)::double as y0, max(c_custkey)::double as y1 from customer group by 1),
  n as (select *, cast(ceil((x1 - x0) / 700) as bigint) as nx, cast(ceil((y1 - y0) / 700) as bigint) as ny from b), c as (select *, unnest(range(0, nx)) as i from n where nx > 0 and ny > 0), g as (select *, unnest(range(0, ny)) as j from c)
  select poly, i * ny + j + 1 as grid_id, round(x0 + i * 700, 6) as x0, round(y0 + j * 700, 6) as y0, round(least(x0 + i * 700 + 700, x1), 6) as x1, round(least(y0 + j * 700 + 700, y1), 6) as y1 from g""")  # fmt: skip
def fishnet(spark, d):
    b = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("poly")).agg(F.min("c_acctbal").alias("x_min"), F.min("c_custkey").cast("double").alias("y_min"), F.max("c_acctbal").alias("x_max"), F.max("c_custkey").cast("double").alias("y_max"))
    return V.fishnet(b, 700.0).select("poly", "grid_id", *(q6(c, c) for c in ("x0", "y0", "x1", "y1")))


@query("fishnet_overlay")
def fishnet_overlay(spark, d):
    """Each area of interest cut by a fishnet of cells of 12 x 12 grid units."""
    return V.clipped_cells(aoi_rings(spark), 12.0).withColumn("area", F.round("area", 6))


@query("ring_area", f"with {_SIDES_SQL} select poly, round(abs(sum(x1 * y2 - x2 * y1)) / 2, 6) as area from sides group by poly")
def ring_area(spark, d):
    return V.ring_area(aoi_rings(spark)).withColumn("area", F.round("area", 6))


@query("extent", """select c_nationkey as district, min(c_acctbal) as x_min, min(c_custkey) as y_min, max(c_acctbal) as x_max, max(c_custkey) as y_max from customer group by 1""")
def extent(spark, d):
    return table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("district")).agg(F.min("c_acctbal").alias("x_min"), F.min("c_custkey").alias("y_min"), F.max("c_acctbal").alias("x_max"), F.max("c_custkey").alias("y_max"))


@query("utm_zone", """with p as (select c_custkey, c_acctbal * 0.017 as lon, (c_custkey % 160) - 80 as lat from customer)
  select c_custkey, cast(floor((lon + 180) / 6) as integer) + 1 as zone, case when lat >= 0 then 32600 else 32700 end + cast(floor((lon + 180) / 6) as integer) + 1 as epsg from p""")
def utm_zone(spark, d):
    lon, lat = F.col("c_acctbal") * 0.017, F.col("c_custkey") % 160 - 80
    return table(spark, d, "customer").select("c_custkey", S.utm_zone(lon).alias("zone"), S.utm_epsg(lon, lat).alias("epsg"))


_E2, _A = S._E2, S._A


@query("area_acres", f"""with p as (select vec_id, 66 + embedding[1]::double as lon, 30 + embedding[2]::double as lat from embeddings),
  c as (select vec_id, unnest([lon, lon + 0.001, lon + 0.001, lon]) as lon, unnest([lat, lat, lat + 0.001, lat + 0.001]) as lat, unnest([0, 1, 2, 3]) as k from p),
  u as (select *, radians(lat) as phi, radians(lon - 69) * cos(radians(lat)) as a, tan(radians(lat)) * tan(radians(lat)) as t, {_E2 / (1 - _E2)!r}::double * cos(radians(lat)) ** 2 as cc, {_A} / sqrt(1 - {_E2!r}::double * sin(radians(lat)) ** 2) as n from c),
  xy as (select vec_id, k, 500000 + 0.9996::double * n * (a + (1 - t + cc) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * cc - 58 * {_E2 / (1 - _E2)!r}::double) * a ** 5 / 120) as x,
   0.9996::double * ({_A} * ({S._M[0]!r}::double * phi - {S._M[1]!r}::double * sin(2 * phi) + {S._M[2]!r}::double * sin(4 * phi) - {S._M[3]!r}::double * sin(6 * phi)) + n * tan(phi) * (a * a / 2 + (5 - t + 9 * cc + 4 * cc * cc) * a ** 4 / 24
   + (61 - 58 * t + t * t + 600 * cc - 330 * {_E2 / (1 - _E2)!r}::double) * a ** 6 / 720)) as y from u)
  select p.vec_id, round(abs(sum((p.x - o.x) * (q.y - o.y) - (q.x - o.x) * (p.y - o.y))) / 2 * 0.000247105::double, 4) as acres from xy p join xy q on p.vec_id = q.vec_id and q.k = (p.k + 1) % 4 join xy o on o.vec_id = p.vec_id and o.k = 0 group by 1""")  # fmt: skip
def area_acres(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", (66 + F.get("embedding", F.lit(0)).cast("double")).alias("lon"), (30 + F.get("embedding", F.lit(1)).cast("double")).alias("lat"))
    corner = [S.utm_xy(F.col("lon") + dx, F.col("lat") + dy, 42) for dx, dy in ((0.0, 0.0), (0.001, 0.0), (0.001, 0.001), (0.0, 0.001), (0.0, 0.0))]
    e = e.select("vec_id", F.array(*(c[0] - corner[0][0] for c in corner)).alias("xs"), F.array(*(c[1] - corner[0][1] for c in corner)).alias("ys"))
    return e.select("vec_id", F.round(F.abs(S.shoelace(F.col("xs"), F.col("ys"))) * S.ACRES_PER_M2, 4).alias("acres"))


@query("tile_count", """select c_nationkey as district, cast(ceil((max(c_acctbal) - min(c_acctbal)) / 500.0) * ceil((max(c_custkey) - min(c_custkey)) / 500.0) as bigint) as n_tiles from customer group by 1""")
def tile_count(spark, d):
    b = extent(spark, d)
    return b.select("district", S.tile_count(F.col("x_min"), F.col("y_min"), F.col("x_max"), F.col("y_max"), 500.0).alias("n_tiles"))


@query("resample", f"""with {X.CLASS_SQL}, t as (select "row", col, cast(floor(("row" + 0.5) * 0.75) as bigint) as r, cast(floor((col + 0.5) * 0.75) as bigint) as c from class_px) select t."row", t.col, p.cls from t left join class_px p on p."row" = t.r and p.col = t.c""")
def resample(spark, d):
    p = X.class_map(spark, d)
    r, c = R.nearest_cell(F.col("row"), F.col("col"), 0.75)
    return p.select("row", "col", r.alias("_r"), c.alias("_c")).join(p.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "cls"), ["_r", "_c"], "left").select("row", "col", "cls")


# ---- comparing


@query("iou", f"""with {X.CLASS_SQL}, b as (select "row", (col + 1) % 100 as col, cls from class_px), j as (select a.cls as x, b.cls as y from (select * from class_px where cls = 1) a full join (select * from b where cls = 1) b on a."row" = b."row" and a.col = b.col)
  select count(*) filter (where x = 1 and y = 1) as both, count(*) as either, count(x) as n_a, count(y) as n_b, round(count(*) filter (where x = 1 and y = 1) / count(*), 6) as iou from j""")  # fmt: skip
def iou(spark, d):
    a = X.class_map(spark, d)
    return R.agreement(a, a.withColumn("col", (F.col("col") + 1) % 100), 1).withColumn("iou", F.round("iou", 6))


@query("band_delta", f"""with {X.STATIC_SQL}, j as (select a.b[1] as a, b.b[2] as b from static_px a join static_px b on a."row" = b."row" and a.col = b.col where a.b[1] <> 0)
  select count(*) as n, round(avg(a), 4) as mean_a, round(avg(b), 4) as mean_b, round(median(a), 4) as median_a, round(median(b), 4) as median_b, round(avg(b) - avg(a), 4) as mean_delta, round(median(b) - median(a), 4) as median_delta from j""")
def band_delta(spark, d):
    s = X.static_pixels(spark, d)
    band = lambda k: s.select("row", "col", F.nullif(F.get("b", F.lit(k)), F.lit(0.0)).alias("x"))
    out = R.band_delta(band(0), band(1), "x")
    return out.select("n", *(F.round(c, 4).alias(c) for c in out.columns if c != "n"))


@query("grid_parity", f"""with {X.CLASS_SQL}, {X.STATIC_SQL} select a.h = b.h and a.w = b.w as same_grid, a.h as h_a, b.h as h_b, a.w as w_a, b.w as w_b from (select max("row") + 1 as h, max(col) + 1 as w from class_px) a, (select max("row") + 1 as h, max(col) + 1 as w from static_px) b""")
def grid_parity(spark, d):
    both = X.class_map(spark, d).select(F.lit("a").alias("m"), "row", "col").unionByName(X.static_pixels(spark, d).select(F.lit("b").alias("m"), "row", "col"))
    of = lambda m, c: (F.max(F.when(F.col("m") == m, F.col(c))) + 1).alias(f"{'h' if c == 'row' else 'w'}_{m}")
    j = both.agg(of("a", "row"), of("b", "row"), of("a", "col"), of("b", "col"))
    return j.select(((F.col("h_a") == F.col("h_b")) & (F.col("w_a") == F.col("w_b"))).alias("same_grid"), "h_a", "h_b", "w_a", "w_b")


# ---- choosing windows


_CHOSEN_SQL = f"""{X.WINDOWS_SQL}, s as (select *, coalesce(coverage, -1) as c from score where status = 'scored'), b as (select district, max(c) filter (where c >= 80) as best, arg_max(rank, (c, -rank)) as fb from s group by 1),
  chosen as (select district, min(rank) as rank, arg_min_null(coverage, rank) as coverage, case when any_value(best) is null then 'below floor' else 'ok' end as label from s join b using (district)
   where case when best is not null then c >= 80 and c >= best - 5 else rank = fb end group by 1)"""


@query("window_choice", f"with {_CHOSEN_SQL} select * from chosen")
def window_choice(spark, d):
    return W.choose(X.window_scores(spark, d), "district")


@query("window_blocking", f"""with {_CHOSEN_SQL}, g as (select s.district, any_value(c.rank) as r, count(*) filter (where s.status = 'unscored' and s.rank < c.rank) as n_unscored_before, count(*) filter (where s.status = 'unscored') as u from score s left join chosen c using (district) group by 1)
  select district, n_unscored_before, case when r is null and u > 0 then 'error' when r is null then 'none' when n_unscored_before > 0 then 'warn' else 'ok' end as verdict from g""")  # fmt: skip
def window_blocking(spark, d):
    s = X.window_scores(spark, d)
    return W.blocking(s, W.choose(s, "district"), "district")


@query("window_expand", f"""with {X.WINDOWS_SQL}, g as (select district, arg_min(start, rank) as start from score where rank > 2 group by 1 having count(*) filter (where status = 'scored') = 0)
  select district, cast(k as integer) as k, cast(start - cast(10 * k as integer) as date) as w_start, cast(start + cast(10 * k as integer) as date) as w_end from g, (select unnest(range(1, 4)) as k)""", dates=("w_start", "w_end"))
def window_expand(spark, d):
    return W.expanded(W.from_rank(X.window_scores(spark, d), 3), "district", 10)


@query("window_start_at", f"with {X.WINDOWS_SQL} select district, rank, status from score where rank >= 2")
def window_start_at(spark, d):
    return W.from_rank(X.window_scores(spark, d), 2).select("district", "rank", "status")


@query("window_clamp", """with y as (select distinct year(o_orderdate) as y from orders), w as (select * from (values ('cane', '10-15', '10-31'), ('wheat', '02-21', '02-29'), ('maize', '04-20', '04-30')) as t(crop, from_md, to_md))
  select crop, cast(y as integer) as y, make_date(y, from_md[1:2]::int, 1) + (from_md[4:5]::int - 1) as w_start, least(make_date(y, to_md[1:2]::int, 1) + (to_md[4:5]::int - 1), last_day(make_date(y, to_md[1:2]::int, 1))) as w_end from y, w""", dates=("w_start", "w_end"))
def window_clamp(spark, d):
    years = table(spark, d, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    rows = F.array(*(F.struct(*(F.lit(x).alias(n) for x, n in zip(r, ("crop", "from_md", "to_md"), strict=True))) for r in (("cane", "10-15", "10-31"), ("wheat", "02-21", "02-29"), ("maize", "04-20", "04-30"))))
    return W.resolved_windows(years.select("y", F.inline(rows)), F.col("y")).select("crop", "y", "w_start", "w_end")


@query("coverage_spread", f"with {X.WINDOWS_SQL} select district, min(coverage) as low, max(coverage) as high from score where status = 'scored' group by 1")
def coverage_spread(spark, d):
    return X.window_scores(spark, d).where("status = 'scored'").groupBy("district").agg(F.min("coverage").alias("low"), F.max("coverage").alias("high"))


@query("date_contract", f"""with {X.SCENES_SQL}, s as (select tile, list(distinct day order by day) as selected from scene where cloud < 50 group by 1), t as (select tile, list(distinct day order by day) as trained from scene where scl < 6 group by 1)
  select tile, len(list_filter(trained, lambda x: not list_contains(selected, x))) as n_missing, len(list_filter(selected, lambda x: not list_contains(trained, x))) as n_extra, trained = selected as same_order from s join t using (tile)""")  # fmt: skip
def date_contract(spark, d):
    s = X.scenes(spark, d)
    days = lambda c, n: s.where(c).groupBy("tile").agg(F.array_sort(F.collect_set("day")).alias(n))
    return W.contract(days("cloud < 50", "selected"), days("scl < 6", "trained"), "tile").select("tile", F.size("missing").cast("long").alias("n_missing"), F.size("extra").cast("long").alias("n_extra"), "same_order")


_GREEDY = "select tile, day, added from (select *, row_number() over (partition by tile order by added desc, day) as n from (select tile, day, count(*) as added from {} group by all)) where n = 1"


@query("greedy_dates", f"""with {X.SCENES_SQL}, l1 as (select distinct tile, day, scl from scene where cloud < 80), b1 as ({_GREEDY.format("l1")}), l2 as (select l1.* from l1 where not exists (select 1 from l1 g join b1 on b1.tile = g.tile and b1.day = g.day where g.tile = l1.tile and g.scl = l1.scl)),
  b2 as ({_GREEDY.format("l2")}) select tile, cast(1 as integer) as place, day, added from b1 union all select tile, cast(2 as integer), day, added from b2""", dates=("day",))
def greedy_dates(spark, d):
    return W.greedy_dates(X.scenes(spark, d).where("cloud < 80"), "tile", "day", "scl")


# ---- quality


@query("qc_share", f"with {X.JOBS_SQL} select district, round(sum(case when status = 'ok' then crop_acres end), 4) as part, round(sum(crop_acres), 4) as whole, round(100.0 * sum(case when status = 'ok' then crop_acres end) / sum(crop_acres), 4) as share_pct from job group by 1")
def qc_share(spark, d):
    j = X.job_results(spark, d).withColumn("ok", F.when(F.col("status") == "ok", F.col("crop_acres")))
    return Q.share(j, "district", "crop_acres", "ok").select("district", *(F.round(c, 4).alias(c) for c in ("part", "whole", "share_pct")))


@query("qc_retention", f"""with {X.CLASS_SQL}, g as (select "row" // 10 as block, count(*) filter (where cls = 1) as ndvi_px, count(*) filter (where cls = 1 and col % 3 > 0) as static_px from class_px group by 1)
  select block, ndvi_px, static_px, round(case when ndvi_px > 0 then 100.0 * static_px / ndvi_px end, 6) as retention_pct from g""")
def qc_retention(spark, d):
    p = X.class_map(spark, d).select(F.floor(F.col("row") / 10).cast("long").alias("block"), "cls", F.when(F.col("col") % 3 > 0, F.col("cls")).alias("s"))
    return Q.retention(p, "block", "cls", "s", [1]).withColumn("retention_pct", F.round("retention_pct", 6))


@query("qc_warnings", f"""with {X.WINDOWS_SQL} select district, rank, case when coverage <= 1 then 'effectively none' when coverage >= 99 then 'effectively all' when coverage < 20 then 'below minimum' when coverage > 90 then 'above maximum' end as warning from score""")
def qc_warnings(spark, d):
    return Q.warnings(X.window_scores(spark, d), "coverage", 1.0, 20.0, 90.0).select("district", "rank", "warning")


@query("acres_total", f"with {X.JOBS_SQL} select district, round(sum(crop_acres), 4) as acres, count(*) as n from job where crop_acres >= 0.5 group by 1")
def acres_total(spark, d):
    return Q.acres_total(X.job_results(spark, d).where("crop_acres >= 0.5"), "district", "crop_acres").withColumn("acres", F.round("acres", 4))


@query("batch_tally", f"with {X.JOBS_SQL} select case when status like 'failed%' then 'failed' else 'ok' end as status, count(*) as n from job group by 1")
def batch_tally(spark, d):
    return Q.tally(X.job_results(spark, d), "status")


@query("tile_minutes", "select run_id, count(*) as n_tiles, round(coalesce(avg(tile_seconds) / 60, 720.0 / 60 / ceil(count(*) / 8.0)), 6) as minutes from tile_outcomes group by 1")
def tile_minutes(spark, d):
    return Q.tile_minutes(table(spark, d, "tile_outcomes"), "run_id", "tile_seconds", 720.0, 8).withColumn("minutes", F.round("minutes", 6))


@query("tile_completeness", "select run_id, count(*) as n_tiles, count(*) filter (where tile_status is null or lower(trim(tile_status)) like 'fail%') as n_failed, count(*) filter (where tile_status is null or lower(trim(tile_status)) like 'fail%') = 0 as complete from tile_outcomes group by 1")
def tile_completeness(spark, d):
    return Q.tile_completeness(table(spark, d, "tile_outcomes"), "run_id", "tile_status")


@query("missing_exports", "select o_orderkey::varchar as grid_id from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber <= 2 and l_quantity > 25)")
def missing_exports(spark, d):
    from ..sources.files import missing_exports as anti

    tail = F.when(F.col("l_linenumber") == 1, ".tif").otherwise("0000000000-0000002048.tif")
    listing = table(spark, d, "lineitem").where("l_linenumber <= 2 and l_quantity > 25").select(F.concat(F.col("l_orderkey").cast("string"), tail).alias("name"))
    return anti(table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("grid_id")), listing, "grid_id", "name")


@query("has_data_check", f"with {X.CLASS_SQL} select count(*) as n_px, count(cls) as n_data from class_px")
def has_data_check(spark, d):
    return Q.refuse_empty(X.class_map(spark, d), "cls")


@query("stale_layers", f"with {X.JOBS_SQL}, g as (select district, sum(crop_acres) as raster_acres, sum(case when status = 'ok' then crop_acres end) as vector_acres from job group by 1) select district, round(vector_acres / raster_acres, 6) as ratio, coalesce(not (vector_acres / raster_acres between 0.15 and 1.05), true) as stale from g")
def stale_layers(spark, d):
    j = X.job_results(spark, d)
    r, v = j.groupBy("district").agg(F.sum("crop_acres").alias("raster_acres")), j.where("status = 'ok'").groupBy("district").agg(F.sum("crop_acres").alias("vector_acres"))
    return Q.area_ratio(r, v, "district").select("district", q6("ratio", "ratio"), "stale")


@query("append_layers", f"with {X.JOBS_SQL} select job, district, crop_acres, null::double as seconds from job where status = 'ok' union all select job, district, null, seconds from job where status <> 'ok'")
def append_layers(spark, d):
    from ..sources.files import union_layers

    j = X.job_results(spark, d)
    return union_layers(j.where("status = 'ok'").select("job", "district", "crop_acres"), j.where("status <> 'ok'").select("job", "district", "seconds"))


