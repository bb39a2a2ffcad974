"""Areas of interest, fishnets and clipping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def row_crossings(rings: DataFrame) -> DataFrame:
    """(poly, row, xs): where the rings of a polygon cross the centre line of each grid row.

    ``rings`` has (poly, ring, seq, x, y) in grid coordinates, each ring closed. Sides are spread over the
    rows they cross, so that filling is an equi-join by row.
    """
    e = rings.select("poly", "ring", "seq", F.col("x").alias("x1"), F.col("y").alias("y1")).join(rings.select("poly", "ring", (F.col("seq") - 1).alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2")), ["poly", "ring", "seq"])
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.ceil(lo - 0.5).cast("long"), (F.ceil(hi - 0.5) - 1).cast("long")
    r = e.where("y1 <> y2").where(last >= first).select("*", F.explode(F.sequence(first, last)).alias("row"))
    x = F.col("x1") + (F.col("row") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    return r.select("poly", "row", x.alias("x")).groupBy("poly", "row").agg(F.collect_list("x").alias("xs"))


def inside(px: DataFrame, rings: DataFrame) -> DataFrame:
    """The cells of ``px`` whose centre lies in a polygon (even-odd rule, so holes are out), with ``poly``."""
    j = px.join(row_crossings(rings), "row")
    odd = F.size(F.filter("xs", lambda x: x > F.col("col") + 0.5)) % 2 == 1
    return j.where(odd).drop("xs")


def fishnet(boxes: DataFrame, side: float) -> DataFrame:
    """(key columns, grid_id, x0, y0, x1, y1) of square cells over boxes, cut off at the far edge, ids from 1 by columns."""
    n = lambda a, b: F.ceil((F.col(b) - F.col(a)) / side).cast("int")
    b = boxes.withColumn("_nx", n("x_min", "x_max")).withColumn("_ny", n("y_min", "y_max")).where("_nx > 0 and _ny > 0")
    c = b.select("*", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1)).alias("i")).select("*", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1)).alias("j"))
    x0, y0 = F.col("x_min") + F.col("i") * side, F.col("y_min") + F.col("j") * side
    keys = [x for x in boxes.columns if x not in ("x_min", "y_min", "x_max", "y_max")]
    return c.select(*keys, (F.col("i") * F.col("_ny") + F.col("j") + 1).cast("long").alias("grid_id"), x0.alias("x0"), y0.alias("y0"), F.least(x0 + side, F.col("x_max")).alias("x1"), F.least(y0 + side, F.col("y_max")).alias("y1"))


def clip_ring(ring: list[tuple[float, float]], x0: float, y0: float, x1: float, y1: float) -> list[tuple[float, float]]:
    """A ring cut to a box, side by side; empty where nothing is left."""
    for axis, bound, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out: list[tuple[float, float]] = []
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            a, b = (p[axis] - bound) * keep, (q[axis] - bound) * keep
            if a >= 0:
                out.append(p)
            if (a > 0 and b < 0) or (a < 0 and b > 0):
                t = a / (a - b)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        ring = out
        if not ring:
            break
    return ring


def clipped_cells(rings: DataFrame, side: float) -> DataFrame:
    """(poly, grid_id, area, n_corners): each polygon's pieces on a fishnet over its own box; empty pieces are left out.

    Holes subtract. Cells of a polygon come from its box, so pairs are made only where boxes meet.
    """
    boxes = rings.groupBy("poly").agg(F.min("x").alias("x_min"), F.min("y").alias("y_min"), F.max("x").alias("x_max"), F.max("y").alias("y_max"))
    cells = fishnet(boxes, side)
    whole = rings.groupBy("poly", "ring").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("pts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            area, corners = [], []
            for r in b.select(["pts", "x0", "y0", "x1", "y1"]).to_pylist():
                p = clip_ring([(q["x"], q["y"]) for q in r["pts"][:-1]], r["x0"], r["y0"], r["x1"], r["y1"])
                area.append(sum(u[0] * v[1] - v[0] * u[1] for u, v in zip(p, p[1:] + p[:1], strict=True)) / 2 if len(p) > 2 else 0.0)
                corners.append(len(p))
            yield pa.RecordBatch.from_arrays([b.column("poly"), b.column("grid_id"), pa.array(area, pa.float64()), pa.array(corners, pa.int64())], names=["poly", "grid_id", "area", "n_corners"])

    j = cells.join(whole, "poly").select("poly", F.col("grid_id"), "pts", "x0", "y0", "x1", "y1")
    out = j.mapInArrow(run, f"poly {rings.schema['poly'].dataType.simpleString()}, grid_id long, area double, n_corners long")
    return out.groupBy("poly", "grid_id").agg(F.abs(F.sum("area")).alias("area"), F.sum("n_corners").alias("n_corners")).where("area > 0")


def ring_area(rings: DataFrame) -> DataFrame:
    """(poly, area) by the shoelace sum over sides; rings run outer one way, holes the other."""
    e = rings.select("poly", "ring", "seq", F.col("x").alias("x1"), F.col("y").alias("y1")).join(rings.select("poly", "ring", (F.col("seq") - 1).alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2")), ["poly", "ring", "seq"])
    return e.groupBy("poly").agg((F.abs(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))) / 2).alias("area"))


def acres(stats: DataFrame, least: float = 0.5) -> DataFrame:
    """Polygons of at least ``least`` acres."""
    return stats.where(F.col("acres") >= least)


def repaired(rings: DataFrame) -> DataFrame:
    """Rings closed, without repeated neighbours, and cut at their self-intersections into simple ones.

    What a ring encloses by the even-odd rule stays: a bow-tie becomes two triangles. Pieces without an
    extent are left out. A ring is worked on as a whole; its sides are compared block by block.
    """
    pts = rings.groupBy("poly", "ring").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("p"))
    kind = rings.schema["poly"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            poly, ring, seq, x, y = [], [], [], [], []
            for r in b.to_pylist():
                for k, q in enumerate(simple_rings([(p["x"], p["y"]) for p in r["p"]])):
                    n = len(q)
                    poly += [r["poly"]] * n
                    ring += [r["ring"] * 1000 + k if k else r["ring"]] * n
                    seq += range(n)
                    x += [p[0] for p in q]
                    y += [p[1] for p in q]
            if poly:
                yield pa.RecordBatch.from_arrays([pa.array(poly, b.schema.field("poly").type), pa.array(ring, pa.int64()), pa.array(seq, pa.int64()), pa.array(x, pa.float64()), pa.array(y, pa.float64())], names=["poly", "ring", "seq", "x", "y"])

    return pts.select("poly", "ring", "p").mapInArrow(run, f"poly {kind}, ring long, seq long, x double, y double")


def simple_rings(p: list[tuple[float, float]]) -> list[list[tuple[float, float]]]:
    """A ring as closed rings that don't cross themselves; none if it encloses nothing."""
    p = [q for i, q in enumerate(p) if not i or q != p[i - 1]]
    if p and p[0] == p[-1]:
        p = p[:-1]
    if len(p) < 3:
        return []
    a, n = np.array(p, float), len(p)
    e = np.roll(a, -1, axis=0) - a
    cuts: list[list[tuple[float, tuple[float, float]]]] = [[] for _ in p]
    for i in range(n):
        j = np.arange(i + 2, n - (i == 0))  # neighbours meet in a corner anyway
        det = e[i, 0] * e[j, 1] - e[i, 1] * e[j, 0]
        w = a[j] - a[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = (w[:, 0] * e[j, 1] - w[:, 1] * e[j, 0]) / det, (w[:, 0] * e[i, 1] - w[:, 1] * e[i, 0]) / det
        for k in np.flatnonzero((det != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)):
            at = (float(a[i, 0] + t[k] * e[i, 0]), float(a[i, 1] + t[k] * e[i, 1]))
            cuts[i].append((float(t[k]), at))
            cuts[int(j[k])].append((float(u[k]), at))
    path: list[tuple[float, float]] = []
    for q, c in zip(p, cuts, strict=True):
        for x in [q, *(x for _, x in sorted(c))]:
            if not path or path[-1] != x:
                path.append(x)
    out, seen, held = [], {}, []
    for x in [*path, path[0]]:  # whenever a point comes back, what lies between is a ring of its own
        if x in seen:
            loop = held[seen[x] :]
            for y in loop[1:]:
                del seen[y]
            held = held[: seen[x] + 1]
            area = sum(u[0] * v[1] - v[0] * u[1] for u, v in zip(loop, loop[1:] + loop[:1], strict=True)) / 2
            if len(loop) > 2 and area:
                out.append([*loop, loop[0]])
        else:
            seen[x] = len(held)
            held.append(x)
    return out


def clipped_rings(rings: DataFrame, boxes: DataFrame) -> DataFrame:
    """(poly, box, ring, seq, x, y): rings cut to boxes (box, x0, y0, x1, y1), pairs made only where their extents meet.

    Extents are compared cell by cell of a coarse grid as wide as the widest box, so the join is by equality.
    """
    side = boxes.agg(F.max(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).first()[0]
    whole = rings.groupBy("poly", "ring").agg(
        *(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x", "y")), F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("pts")
    )
    if side is None:
        return rings.select("poly", F.lit(0).cast("long").alias("box"), F.col("ring").cast("long").alias("ring"), F.col("seq").cast("long").alias("seq"), "x", "y").limit(0)
    cell = lambda c: F.floor(c / side).cast("long")
    span = lambda a, b: F.explode(F.sequence(cell(a), cell(b)))
    cells = lambda df, x0, x1, y0, y1: df.select("*", span(F.col(x0), F.col(x1)).alias("_i")).select("*", span(F.col(y0), F.col(y1)).alias("_j"))
    j = cells(whole, "min_x", "max_x", "min_y", "max_y").join(cells(boxes.select(F.col("box").cast("long").alias("box"), "x0", "y0", "x1", "y1"), "x0", "x1", "y0", "y1"), ["_i", "_j"])
    j = j.where("min_x <= x1 and max_x >= x0 and min_y <= y1 and max_y >= y0").drop("_i", "_j").dropDuplicates(["poly", "ring", "box"]).select("poly", "ring", "box", "pts", "x0", "y0", "x1", "y1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                p = clip_ring([(q["x"], q["y"]) for q in r["pts"][:-1]], r["x0"], r["y0"], r["x1"], r["y1"])
                if len(p) > 2:
                    out += [(r["poly"], r["box"], r["ring"], k, x, y) for k, (x, y) in enumerate([*p, p[0]])]
            if out:
                types = [b.schema.field("poly").type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["poly", "box", "ring", "seq", "x", "y"])

    return j.mapInArrow(run, f"poly {rings.schema['poly'].dataType.simpleString()}, box long, ring long, seq long, x double, y double")


def chips_near(chips: DataFrame, rings: DataFrame, chip: int) -> DataFrame:
    """The chips that the extent of some ring meets: what lies elsewhere is never opened."""
    box = rings.groupBy("poly").agg(*(F.floor(f(c) / chip).cast("long").alias(f"_{n}") for f, c, n in ((F.min, "y", "r0"), (F.max, "y", "r1"), (F.min, "x", "c0"), (F.max, "x", "c1"))))
    want = box.select(F.explode(F.sequence("_r0", "_r1")).alias("chip_r"), "_c0", "_c1").select("chip_r", F.explode(F.sequence("_c0", "_c1")).alias("chip_c")).distinct()
    return chips.join(want, ["chip_r", "chip_c"], "left_semi")


def pixel_estimate(rings: DataFrame, lon0: float, lat0: float, step: float, zone: int) -> DataFrame:
    """(poly, n_px): how many pixels an area covers, its projected area over a pixel's, at least 1.

    ``rings`` are in pixel units from (lon0, lat0), rows down; the pixel is the mean one of the area's box.
    """
    deg = rings.select("poly", "ring", "seq", (F.lit(lon0) + F.col("x") * step).alias("lon"), (F.lit(lat0) - F.col("y") * step).alias("lat"))
    x, y = S.utm_xy(F.col("lon"), F.col("lat"), zone)
    xy = deg.select("poly", "ring", "seq", x.alias("x"), y.alias("y"), "lon", "lat")
    origin = xy.groupBy("poly").agg(*(f(c).alias(f"_{c}{k}") for c in ("x", "y", "lon", "lat") for f, k in ((F.min, 0), (F.max, 1))))
    near = xy.join(origin, "poly").select("poly", "ring", "seq", (F.col("x") - F.col("_x0")).alias("x"), (F.col("y") - F.col("_y0")).alias("y"))
    pixel = step * step * (F.col("_x1") - F.col("_x0")) / (F.col("_lon1") - F.col("_lon0")) * (F.col("_y1") - F.col("_y0")) / (F.col("_lat1") - F.col("_lat0"))
    return ring_area(near).join(origin, "poly").select("poly", F.greatest(F.lit(1), F.floor(F.col("area") / pixel)).cast("long").alias("n_px"))
