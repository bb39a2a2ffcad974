"""Connected components of class maps, and what is built on them: sieve, directional revert, polygons.

Cells live in chips: one row per square of ``CHIP`` x ``CHIP`` cells, an array per column. A chip is labelled
in a few array operations over its runs of equal cells; what crosses a chip's border is a much smaller
relation of labels: links between chips are contracted, and only components that reach a border, and small
ones beside those, are decided there. The answer returns to the chips as a short list of labels per chip, so
a cell is never a row of a join and no step is iterated per cell.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import stored
from .arrow import edges, whole_groups

CHIP = 512  #: rows and columns of a chip
FEW_ANSWERS = 1_000_000  #: labels (16 bytes each) whose answers go to the chips by broadcast; with more, chips are shuffled to them
FEW_CHIPS = 1_000  #: chips whose borders (about 40 KB each) the driver puts together itself; those of more are joined as tables
FEW_LINKS = 100_000  #: links, pointers or open outlines that the driver follows itself (16 bytes each); more are followed as tables
_COL = 1 << 31
#: cells that are not in the grid, and cells without data
ABSENT, NODATA = -(1 << 63), -(1 << 63) + 1
FOUR, EIGHT = ((0, 1), (1, 0)), ((0, 1), (1, 0), (1, 1), (1, -1))
_KEY = "chip_r long, chip_c long"


def _half(conn: int) -> tuple[tuple[int, int], ...]:
    if conn not in (4, 8):
        raise ValueError("connectivity is 4 or 8")
    return FOUR if conn == 4 else EIGHT


# ---- chips


def to_chips(px: DataFrame, columns: Sequence[str], chip: int = CHIP) -> DataFrame:
    """(chip_r, chip_c, columns as arrays of 64-bit integers in bytes): one shuffle of the cells.

    Rows without a position are left out; of repeated cells the smallest value counts, a null loses.
    """
    at = lambda c: F.floor(F.col(c) / chip).cast("long")
    in_ = lambda c: F.pmod(F.col(c), F.lit(chip)).cast("int")
    p = px.where("row is not null and col is not null").select(at("row").alias("chip_r"), at("col").alias("chip_c"), (in_("row") * chip + in_("col")).alias("_at"), *(F.col(c).cast("long").alias(c) for c in columns))

    def build(key: tuple, t: pa.Table) -> pa.Table:
        place = t.column("_at").to_numpy()
        out = {"chip_r": [key[0].as_py()], "chip_c": [key[1].as_py()]}
        for c in columns:
            v = t.column(c).fill_null(NODATA).to_numpy()
            order = np.argsort(np.where(v == NODATA, np.iinfo(np.int64).max, v), kind="stable")[::-1] if len(np.unique(place)) < len(place) else slice(None)
            g = np.full(chip * chip, ABSENT)
            g[place[order]] = v[order]
            out[c] = [g.tobytes()]
        return pa.table(out, schema=pa.schema([("chip_r", pa.int64()), ("chip_c", pa.int64()), *((c, pa.binary()) for c in columns)]))

    p = p.repartition(_parts(p), "chip_r", "chip_c")  # a fixed number: chips are small once compressed, and Python works on them
    return p.groupBy("chip_r", "chip_c").applyInArrow(build, ", ".join([_KEY, *(f"{c} binary" for c in columns)]))


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def from_chips(chips: DataFrame, columns: Sequence[str], chip: int = CHIP) -> DataFrame:
    """(row, col, columns) of the cells that are in the grid; cells without data are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                v = [_cells(b, c, k) for c in columns]
                at = np.flatnonzero(v[0] != ABSENT)
                r, c = b.column(0)[k].as_py() * chip, b.column(1)[k].as_py() * chip
                yield pa.RecordBatch.from_arrays([pa.array(r + at // chip), pa.array(c + at % chip), *(pa.array(x[at], pa.int64(), mask=x[at] == NODATA) for x in v)], names=["row", "col", *columns])

    return chips.select("chip_r", "chip_c", *columns).mapInArrow(run, ", ".join(["row long", "col long", *(f"{c} long" for c in columns)]))


def _cells(b: pa.RecordBatch, name: str, k: int, dtype: str = "<i8") -> np.ndarray:
    return np.frombuffer(b.column(b.schema.get_field_index(name))[k].as_buffer(), dtype)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# ---- labels inside a chip


def label(v: np.ndarray, part: np.ndarray, conn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the components of equal cells where ``part``, numbered by their first cell, else -1; first cells; sizes."""
    h, w = v.shape
    new = np.ones((h, w), bool)
    new[:, 1:] = (v[:, 1:] != v[:, :-1]) | (part[:, 1:] != part[:, :-1])
    starts = np.flatnonzero(new)
    run = (np.cumsum(new.ravel()) - 1).reshape(h, w)
    both = part[1:] & part[:-1]
    same = both & (v[1:] == v[:-1])
    once = same.copy()  # one link per overlap of two runs
    once[:, 1:] &= ~(same[:, :-1] & ~new[1:, 1:] & ~new[:-1, 1:])
    a, b = [run[:-1][once]], [run[1:][once]]
    if conn == 8:
        for up, down in ((np.s_[:-1, :-1], np.s_[1:, 1:]), (np.s_[:-1, 1:], np.s_[1:, :-1])):
            m = part[up] & part[down] & (v[up] == v[down])
            a.append(run[up][m])
            b.append(run[down][m])
    a, b = np.concatenate(a), np.concatenate(b)
    root = np.arange(len(starts))
    while len(a):
        ra, rb = root[a], root[b]
        far = ra != rb
        if not far.any():
            break
        a, b, ra, rb = a[far], b[far], ra[far], rb[far]
        root[np.maximum(ra, rb)] = np.minimum(ra, rb)  # roots only ever hang below smaller ones, so there is no circle
        while True:
            nxt = root[root]
            if (nxt == root).all():
                break
            root = nxt
    valid = part.ravel()[starts]
    heads = np.flatnonzero(valid & (root == np.arange(len(root))))
    number = np.full(len(root), -1, np.int32)
    number[heads] = np.arange(len(heads), dtype=np.int32)
    of_run = np.where(valid, number[root], -1).astype(np.int32)
    length = np.diff(np.append(starts, h * w))
    n = np.bincount(of_run[valid], weights=length[valid], minlength=len(heads)).astype(np.int64)
    return of_run[run], starts[heads], n


def _touching(lab: np.ndarray, conn: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (a, b) of different labels that touch, in both directions, where ``keep[a]``."""
    k = len(keep)
    pairs = []
    for dr, dc in _half(conn):
        h, w = lab.shape
        x = lab[: h - dr, max(0, -dc) : w - max(0, dc)].ravel()
        y = lab[dr:, max(0, dc) : w + min(0, dc)].ravel()
        m = (x != y) & (x >= 0) & (y >= 0)
        x, y = x[m].astype(np.int64), y[m].astype(np.int64)
        pairs += [(x * k + y)[keep[x]], (y * k + x)[keep[y]]]
    u = np.unique(np.concatenate(pairs)) if k else np.zeros(0, np.int64)
    return u // max(k, 1), u % max(k, 1)


def _rim(lab: np.ndarray) -> np.ndarray:
    x = np.concatenate([lab[0], lab[-1], lab[:, 0], lab[:, -1]])
    return np.unique(x[x >= 0])


def _edges_of(r: int, c: int, ids: np.ndarray, v: np.ndarray, conn: int) -> list[tuple]:
    """What a chip shows at its borders: (orientation, border, side, ids, values)."""
    out = [(o, rr, cc, side, np.ascontiguousarray(ids[at]).tobytes(), np.ascontiguousarray(v[at]).tobytes()) for o, rr, cc, side, at in ((0, r + 1, c, 0, np.s_[-1]), (0, r, c, 1, np.s_[0]), (1, r, c + 1, 0, np.s_[:, -1]), (1, r, c, 1, np.s_[:, 0]))]
    if conn == 8:
        out += [(2, rr, cc, side, ids[at].tobytes(), v[at].tobytes()) for rr, cc, side, at in ((r + 1, c + 1, 0, np.s_[-1:, -1]), (r + 1, c, 1, np.s_[-1:, 0]), (r, c + 1, 2, np.s_[:1, -1]), (r, c, 3, np.s_[:1, 0]))]
    return out


_EDGE = "array<struct<o: int, r: long, c: long, side: int, ids: binary, v: binary>>"
_EDGE_PA = pa.list_(pa.struct([("o", pa.int32()), ("r", pa.int64()), ("c", pa.int64()), ("side", pa.int32()), ("ids", pa.binary()), ("v", pa.binary())]))
_RIM = "array<struct<id: long, n: long, v: long>>"
_RIM_PA = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64()), ("v", pa.int64())]))
_TOUCH = "array<struct<a: long, b: long, rim: boolean, n: long, v: long, kind: int, t: long>>"
_TOUCH_PA = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("rim", pa.bool_()), ("n", pa.int64()), ("v", pa.int64()), ("kind", pa.int32()), ("t", pa.int64())]))


def _dicts(t: pa.ListType, rows: list[tuple]) -> list[dict]:
    names = [f.name for f in t.value_type]
    return [dict(zip(names, r, strict=True)) for r in rows]


def _names(first: np.ndarray, r: int, c: int, chip: int) -> np.ndarray:
    """Components by their first cell: row * 2^31 + col."""
    return (r * chip + first // chip) * _COL + c * chip + first % chip


def labelled(chips: DataFrame, value: str, conn: int, chip: int) -> DataFrame:
    """Chips with the labels of their cells (``lab``), the labels' names (``ids``) and what they show at their borders; stored."""
    schema = pa.schema([("chip_r", pa.int64()), ("chip_c", pa.int64()), ("cells", pa.binary()), ("lab", pa.binary()), ("ids", pa.binary()), ("edge", _EDGE_PA)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r, c, v = b.column(0)[k].as_py(), b.column(1)[k].as_py(), _cells(b, value, k).reshape(chip, chip)
                lab, first, _ = label(v, v > NODATA, conn)
                ids = _names(first, r, c, chip)
                named = np.append(ids, -1)[lab]
                yield _rows([(r, c, v.tobytes(), lab.tobytes(), ids.tobytes(), _dicts(_EDGE_PA, _edges_of(r, c, named, v, conn)))], schema)

    return stored(chips.select("chip_r", "chip_c", value).mapInArrow(run, f"{_KEY}, cells binary, lab binary, ids binary, edge {_EDGE}"), "labels")


# ---- labels between chips


def _meet(borders: list[tuple[int, list[dict | None]]], conn: int, outside: int | None = None) -> list[np.ndarray]:
    """Distinct pairs (a, b) of labels at borders (orientation, sides): equal neighbours, different ones, and (a, a) of
    labels beside an unlabelled cell of value ``outside``."""
    found: list[list[np.ndarray]] = [[], [], []]
    for o, side in borders:
        for i, j in ((0, 1),) if o < 2 else ((0, 3), (1, 2)):
            x, y = side[i], side[j]
            if not x or not y:
                continue
            ia, va, ib, vb = (np.frombuffer(s[n], "<i8") for s in (x, y) for n in ("ids", "v"))
            n = len(ia)
            for s in (-1, 0, 1) if conn == 8 and o < 2 else (0,):
                p, q = np.s_[max(0, -s) : n - max(0, s)], np.s_[max(0, s) : n + min(0, s)]
                l1, l2, v1, v2 = ia[p], ib[q], va[p], vb[q]
                both = (l1 >= 0) & (l2 >= 0)
                for kind, m in ((0, both & (v1 == v2)), (1, both & (v1 != v2))):
                    found[kind].append(np.stack([l1[m], l2[m]], 1))
                if outside is not None:
                    for own, m in ((l1, (l1 >= 0) & (l2 < 0) & (v2 == outside)), (l2, (l2 >= 0) & (l1 < 0) & (v1 == outside))):
                        found[2].append(np.stack([own[m], own[m]], 1))
    return [np.unique(np.concatenate(parts), axis=0) if parts else np.zeros((0, 2), np.int64) for parts in found]


def _gathered(labels: DataFrame, columns: Sequence[str]) -> pa.Table | None:
    """What the chips say of their borders, for the driver, if there are few chips; else None."""
    return labels.select("edge", *columns).toArrow() if labels.count() <= FEW_CHIPS else None


def _at_borders(t: pa.Table) -> list[tuple[int, list[dict | None]]]:
    by: dict[tuple, list] = {}
    for edge in t.column("edge").to_pylist():
        for e in edge:
            by.setdefault((e["o"], e["r"], e["c"]), [None] * 4)[e["side"]] = e
    return [(o, side) for (o, _, _), side in by.items()]


def _met(labels: DataFrame, conn: int, outside: int | None = None) -> DataFrame:
    """(kind, a, b) at chip borders: 0 equal neighbours, 1 different ones, 2 a label a beside an unlabelled cell of value ``outside``."""
    _half(conn)
    e = labels.select(F.inline("edge")).groupBy("o", "r", "c").agg(*(F.first(F.when(F.col("side") == k, F.struct("ids", "v")), True).alias(f"s{k}") for k in range(4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.select(["o", "s0", "s1", "s2", "s3"]).to_pylist()
            for kind, u in enumerate(_meet([(x["o"], [x[f"s{k}"] for k in range(4)]) for x in rows], conn, outside)):
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int32)), pa.array(u[:, 0]), pa.array(u[:, 1])], names=["kind", "a", "b"])

    return stored(e.select("o", "s0", "s1", "s2", "s3").mapInArrow(run, "kind int, a long, b long"), "met")


def _per_chip(answers: DataFrame, chip: int) -> DataFrame:
    """(chip_r, chip_c, answer): the (id, to) of the labels of each chip, at most as many as touch its border or those."""
    at = lambda c: F.floor(c / chip).cast("long")
    r, c = F.floor(F.col("id") / _COL).cast("long"), F.pmod(F.col("id"), F.lit(_COL))
    return answers.groupBy(at(r).alias("chip_r"), at(c).alias("chip_c")).agg(F.collect_list(F.struct("id", "to")).alias("answer"))


def _answered(labels: DataFrame, answers: DataFrame | dict[int, int], columns: Sequence[str], names: Sequence[str], run: Callable, chip: int) -> DataFrame:
    """Chips with the answers for their labels, each brought through ``run``(batch, row, ids asked, answers) -> arrays."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                if known is not None:
                    ids, to = known.value.get((b.column(0)[k].as_py(), b.column(1)[k].as_py()), none)
                else:
                    got = b.column(b.schema.get_field_index("answer"))[k].values
                    ids, to = none if got is None else (got.field("id").to_numpy(), got.field("to").to_numpy())
                order = np.argsort(ids)
                out = run(b, k, ids[order], to[order])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), b.column(1).slice(k, 1), *(pa.array([x.tobytes()], pa.binary()) for x in out)], names=["chip_r", "chip_c", *names])

    none = (np.zeros(0, np.int64),) * 2
    known = None
    j = labels.select("chip_r", "chip_c", *columns)
    if isinstance(answers, dict):
        ids, to = (np.fromiter(x, np.int64, len(answers)) for x in (answers.keys(), answers.values()))
        place = np.stack([ids // _COL // chip, ids % _COL // chip], 1)
        order = np.lexsort((place[:, 1], place[:, 0]))
        cut = np.flatnonzero(np.append(True, (place[order][1:] != place[order][:-1]).any(1))) if len(ids) else []
        known = labels.sparkSession.sparkContext.broadcast({tuple(place[g[0]].tolist()): (ids[g], to[g]) for g in np.split(order, cut[1:])} if len(ids) else {})
    else:
        answers = stored(answers, "answers")
        few = answers.count() <= FEW_ANSWERS
        per = _per_chip(answers, chip)
        j = (j if few else j.repartition(_parts(j), "chip_r", "chip_c")).join(F.broadcast(per) if few else per, ["chip_r", "chip_c"], "left")
    return j.mapInArrow(go, ", ".join([_KEY, *(f"{n} binary" for n in names)]))


def _lookup(ids: np.ndarray, asked: np.ndarray, to: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``to`` of each id that was asked for, else ``other``."""
    if not len(asked):
        return other
    k = np.minimum(np.searchsorted(asked, ids), len(asked) - 1)
    return np.where(asked[k] == ids, to[k], other)


def _roots(pairs: list[tuple[int, int]]) -> dict[int, int]:
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def contract(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(lab, root) of every label in ``links`` (a, b): the smallest label that it is linked to.

    Few links are contracted on the driver; otherwise large-star and small-star steps run on tables
    until nothing changes, each step stored, with partial aggregation before every shuffle.
    """
    spark = links.sparkSession
    links = links.select("a", "b").where("a <> b").distinct()
    head = links.limit(few + 1).collect()
    if len(head) <= few:
        return spark.createDataFrame([(int(x), int(r)) for x, r in _roots([(r[0], r[1]) for r in head]).items()], "lab long, root long")
    edges = stored(links, "links")
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(low.select("a", F.col("m").alias("b"))).distinct()
        new = stored(small, "links")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            break
        edges = new
    up = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("lab"), "root")
    return up.union(up.select(F.col("root").alias("lab"), "root").distinct())


def component_chips(chips: DataFrame, value: str, conn: int = 4, chip: int = CHIP, few: int = FEW_LINKS) -> DataFrame:
    """Chips with ``value`` and ``comp``, the component of every cell: its smallest row * 2^31 + col, or no data."""
    lab = labelled(chips, value, conn, chip)
    if few and (said := _gathered(lab, [])) is not None:
        answers: DataFrame | dict[int, int] = _roots(_meet(_at_borders(said), conn)[0].tolist())
    else:
        answers = contract(_met(lab, conn).where("kind = 0").select("a", "b"), few).where("lab <> root").select(F.col("lab").alias("id"), F.col("root").alias("to"))

    def run(b: pa.RecordBatch, k: int, asked: np.ndarray, to: np.ndarray) -> list[np.ndarray]:
        ids, own, v = _cells(b, "ids", k), _cells(b, "lab", k, "<i4"), _cells(b, "cells", k)
        comp = np.append(_lookup(ids, asked, to, ids), NODATA)[own]
        return [v, np.where(v == ABSENT, ABSENT, comp)]

    return stored(_answered(lab, answers, ["cells", "lab", "ids"], [value, "comp"], run, chip), "comp")


def components(px: DataFrame, value: str, conn: int = 4, chip: int = CHIP, few: int = FEW_LINKS) -> DataFrame:
    """(row, col, value, comp): ``comp`` is the smallest row * 2^31 + col of the component.

    Cells with a null value or position take no part; repeated cells count once, with their smallest value;
    an empty table gives none.
    """
    c = component_chips(to_chips(px, [value], chip), value, conn, chip, few)
    return from_chips(c, [value, "comp"], chip).where(F.col(value).isNotNull())


# ---- sieve


def _decide(lab: np.ndarray, n: np.ndarray, val: np.ndarray, least: int, conn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
    """What a chip can decide of its small components on its own.

    Gives the new value per label, the label whose answer from outside it waits for (-1: none), whether it
    was given a value here, the labels on the rim, and the touching pairs (a, b) of the labels that wait.
    """
    k = len(n)
    small = n < least
    rim = _rim(lab)
    on_rim = np.zeros(k, bool)
    on_rim[rim] = True
    a, b = _touching(lab, conn, small)
    waits = small & on_rim
    waits[a[on_rim[b]]] = True
    new, wait = val.copy(), np.full(k, -1, np.int64)
    wait[waits] = np.flatnonzero(waits)
    here = ~waits[a]
    x, y = a[here], b[here]
    order = np.lexsort((-y, n[y], x))  # the largest neighbour, of equal ones the first
    x, y = x[order], y[order]
    last = np.append(x[1:] != x[:-1], True) if len(x) else np.zeros(0, bool)
    to = np.arange(k)
    to[x[last]] = y[last]
    for _ in range(max(1, int(k).bit_length())):
        to = to[to]  # labels that wait or are large point at themselves
    mine = np.flatnonzero(small & ~waits)
    end = to[mine]
    done = ~small[end]
    new[mine[done]] = val[end[done]]
    wait[mine[waits[end]]] = end[waits[end]]
    ended = np.zeros(k, bool)
    ended[mine[done]] = True
    out = waits[a]
    return new, wait, ended, rim, (a[out], b[out])


def sieve_chips(chips: DataFrame, value: str, least: int, conn: int = 4, chip: int = CHIP) -> DataFrame:
    """Chips with ``value`` and ``sieved``; see ``sieve``."""
    schema = pa.schema([("chip_r", pa.int64()), ("chip_c", pa.int64()), *((x, pa.binary()) for x in ("cells", "lab", "ids", "new", "wait")), ("edge", _EDGE_PA), ("rims", _RIM_PA), ("touch", _TOUCH_PA)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r, c, v = b.column(0)[k].as_py(), b.column(1)[k].as_py(), _cells(b, value, k).reshape(chip, chip)
                lab, first, n = label(v, v > NODATA, conn)
                ids, val = _names(first, r, c, chip), v.ravel()[first]
                new, wait, ended, rim, (x, y) = _decide(lab, n, val, least, conn)
                on_rim = np.isin(np.arange(len(n)), rim)
                # how a small neighbour inside ends: 1 with a value, 2 with the answer of another label, 0 nowhere
                kind = np.where(wait[y] >= 0, 2, np.where(ended[y], 1, 0))
                t = np.where(wait[y] >= 0, ids[wait[y]], new[y])
                touch = zip(*(z.tolist() for z in (ids[x], ids[y], on_rim[y], n[y], val[y], kind, t)), strict=True)
                yield _rows(
                    [(r, c, v.tobytes(), lab.tobytes(), ids.tobytes(), new.tobytes(), wait.tobytes(), _dicts(_EDGE_PA, _edges_of(r, c, np.append(ids, -1)[lab], v, conn)),
                      _dicts(_RIM_PA, list(zip(ids[rim].tolist(), n[rim].tolist(), val[rim].tolist(), strict=True))), _dicts(_TOUCH_PA, list(touch)))],
                    schema,
                )

    lab = stored(chips.select("chip_r", "chip_c", value).mapInArrow(run, f"{_KEY}, cells binary, lab binary, ids binary, new binary, wait binary, edge {_EDGE}, rims {_RIM}, touch {_TOUCH}"), "labels")
    said = _gathered(lab, ["rims", "touch"])
    answers = _small_by_tables(lab, least, conn) if said is None else _small_on_driver(said, least, conn)

    def fill(b: pa.RecordBatch, k: int, asked: np.ndarray, to: np.ndarray) -> list[np.ndarray]:
        v, own, ids, new, wait = _cells(b, "cells", k), _cells(b, "lab", k, "<i4"), _cells(b, "ids", k), _cells(b, "new", k).copy(), _cells(b, "wait", k)
        w = np.flatnonzero(wait >= 0)
        new[w] = _lookup(ids[wait[w]], asked, to, new[w])
        return [v, np.where(own >= 0, np.append(new, 0)[own], v)]

    return _answered(lab, answers, ["cells", "lab", "ids", "new", "wait"], [value, "sieved"], fill, chip)


def _small_by_tables(lab: DataFrame, least: int, conn: int) -> DataFrame:
    """(id, to): the new values of small components that chips could not decide on their own."""
    met = _met(lab, conn)
    up = contract(met.where("kind = 0").select("a", "b"))
    root = lambda df, c: df.join(up.select(F.col("lab").alias(c), F.col("root").alias("_root")), c, "left").withColumn(c, F.coalesce("_root", c)).drop("_root")
    rims = lab.select(F.inline("rims"))
    named = rims.join(up.withColumnRenamed("lab", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("comp"), "n", "v")
    sizes = named.groupBy("comp").agg(F.sum("n").alias("n"), F.first("v").alias("v"))
    across = met.where("kind = 1").select("a", "b")
    none = lambda t, n: F.lit(None).cast(t).alias(n)
    across = across.union(across.select("b", "a")).select("a", "b", F.lit(True).alias("rim"), none("long", "n"), none("long", "v"), none("int", "kind"), none("long", "t"))
    touch = root(lab.select(F.inline("touch")).unionByName(across), "a")
    touch = touch.where(~F.col("rim")).unionByName(root(touch.where("rim").drop("n", "v"), "b").join(sizes.withColumnRenamed("comp", "b"), "b"))
    touch = touch.join(sizes.select(F.col("comp").alias("a"), F.col("n").alias("_own")), "a", "left").where(F.coalesce("_own", F.lit(0)) < least).where("a <> b")
    best = touch.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("b"), "v", "rim", "kind", "t")).alias("m"))
    big, inside = F.col("m.n") >= least, ~F.col("m.rim")
    nodes = best.select(
        F.col("a").alias("comp"),
        F.when(big, None).when(inside, F.when(F.col("m.kind") == 2, F.col("m.t"))).otherwise(-F.col("m.b")).alias("next"),
        F.when(big, F.col("m.v")).when(inside & (F.col("m.kind") == 1), F.col("m.t")).alias("to"),
    )
    ends = stored(_chase(nodes), "ends")
    return named.join(ends, "comp").select("id", "to").union(ends.select(F.col("comp").alias("id"), "to")).distinct()


def _small_on_driver(said: pa.Table, least: int, conn: int) -> dict[int, int]:
    """The same for few chips, without a job."""
    links, across, _ = _meet(_at_borders(said), conn)
    up = _roots(links.tolist())
    size: dict[int, int] = {}
    value: dict[int, int] = {}
    rims = [x for c in said.column("rims").to_pylist() for x in c]
    for x in rims:
        comp = up.get(x["id"], x["id"])
        size[comp] = size.get(comp, 0) + x["n"]
        value[comp] = x["v"]
    best: dict[int, tuple] = {}
    whole = [(x["a"], x["b"], x["rim"], x["n"], x["v"], x["kind"], x["t"]) for c in said.column("touch").to_pylist() for x in c]
    whole += [(a, b, True, 0, 0, 0, 0) for pair in (across, across[:, ::-1]) for a, b in pair.tolist()]
    for a, b, rim, n, v, kind, t in whole:
        a = up.get(a, a)
        if rim:
            b = up.get(b, b)
            n, v = size[b], value[b]
        if a != b and size.get(a, 0) < least and ((n, -b) > best[a][:2] if a in best else True):
            best[a] = (n, -b, v, rim, kind, t)
    nxt, to = {}, {}
    for a, (n, b, v, rim, kind, t) in best.items():
        nxt[a] = None if n >= least else -b if rim else t if kind == 2 else None
        to[a] = v if n >= least else t if not rim and kind == 1 else None
    ends = _follow(nxt, to)
    return ends | {x["id"]: ends[c] for x in rims if (c := up.get(x["id"], x["id"])) in ends}


def _follow(nxt: dict, to: dict) -> dict[int, int]:
    """The value at which the chain of each node ends, if it ends in one."""
    ends = {}
    for c in nxt:
        seen, k = {c}, c
        while k is not None and to.get(k) is None and nxt.get(k) not in seen:
            k = nxt.get(k)
            seen.add(k)
        if k is not None and to.get(k) is not None:
            ends[c] = to[k]
    return ends


def _chase(nodes: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(comp, to) of the nodes (comp, next, to) whose chain of ``next`` ends in a value ``to``.

    Few are followed on the driver; more are doubled as tables, each round stored, until none moves.
    """
    spark = nodes.sparkSession
    head = nodes.limit(few + 1).collect()
    if len(head) <= few:
        ends = _follow({r["comp"]: r["next"] for r in head}, {r["comp"]: r["to"] for r in head})
        return spark.createDataFrame(list(ends.items()), "comp long, to long")
    nodes = stored(nodes, "chase")
    waiting = -1
    while True:  # a chain of 2^k nodes is followed in k rounds; what stays runs in a circle or ends nowhere
        left = nodes.where("to is null and next is not null").count()
        if not left or left == waiting:
            return nodes.where("to is not null").select("comp", "to")
        far = nodes.select(F.col("comp").alias("next"), F.col("next").alias("_next"), F.col("to").alias("_to"))
        moved = nodes.where("to is null and next is not null").join(far, "next", "left").select("comp", F.col("_next").alias("next"), F.col("_to").alias("to"))
        nodes = stored(nodes.where("to is not null or next is null").unionByName(moved), "chase")
        waiting = left


def sieve(px: DataFrame, value: str, least: int, conn: int = 4, chip: int = CHIP) -> DataFrame:
    """(row, col, value, sieved): components under ``least`` pixels take the value of their largest neighbour.

    A neighbour that is itself too small hands on to its own largest neighbour; ties go to the smaller
    label; a component whose chain ends in no large component keeps its value. Cells without a value take
    no part and come back null; repeated cells count once, with their smallest value.
    """
    out = from_chips(sieve_chips(to_chips(px, [value], chip), value, least, conn, chip), [value, "sieved"], chip)
    return out.select("row", "col", F.col(value).cast(px.schema[value].dataType).alias(value), F.col("sieved").cast("int").alias("sieved"))


# ---- revert


def revert_chips(chips: DataFrame, before: str, after: str, target: Sequence[int], conn: int = 4, chip: int = CHIP) -> DataFrame:
    """Chips with ``before`` and ``after``; see ``revert``."""
    wanted = np.array(sorted(target), np.int64)
    schema = pa.schema([("chip_r", pa.int64()), ("chip_c", pa.int64()), ("before", pa.binary()), ("after", pa.binary()), ("lab", pa.binary()), ("ids", pa.binary()), ("bad", pa.binary()), ("edge", _EDGE_PA), ("bad_rim", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r, c, x, y = b.column(0)[k].as_py(), b.column(1)[k].as_py(), _cells(b, before, k).reshape(chip, chip), _cells(b, after, k).reshape(chip, chip)
                was = np.isin(x, wanted)
                flip = ~was & np.isin(y, wanted) & (x > NODATA)
                code = np.where(flip, 1, np.where((x != ABSENT) & ~was, 2, 0)).astype(np.int64)  # 2: stayed outside
                lab, first, _ = label(code, flip, conn)
                bad = np.zeros(len(first), bool)
                half = _half(conn)
                for dr, dc in (*half, *((-i, -j) for i, j in half)):
                    a = np.s_[max(0, -dr) : chip - max(0, dr), max(0, -dc) : chip - max(0, dc)]
                    o = np.s_[max(0, dr) : chip + min(0, dr), max(0, dc) : chip + min(0, dc)]
                    bad[lab[a][flip[a] & (code[o] == 2)]] = True
                ids = _names(first, r, c, chip)
                rim = _rim(lab)
                yield _rows([(r, c, x.tobytes(), y.tobytes(), lab.tobytes(), ids.tobytes(), bad.tobytes(), _dicts(_EDGE_PA, _edges_of(r, c, np.append(ids, -1)[lab], code, conn)), ids[rim[bad[rim]]].tolist())], schema)

    lab = stored(chips.select("chip_r", "chip_c", before, after).mapInArrow(run, f"{_KEY}, before binary, after binary, lab binary, ids binary, bad binary, edge {_EDGE}, bad_rim array<long>"), "clumps")
    said = _gathered(lab, ["bad_rim"])
    if said is not None:
        links, _, beside = _meet(_at_borders(said), conn, outside=2)
        up = _roots(links.tolist())
        marked = [x for c in said.column("bad_rim").to_pylist() for x in c] + beside[:, 0].tolist()
        lost = {up.get(x, x) for x in marked}
        answers: DataFrame | dict[int, int] = dict.fromkeys(lost, 1) | {x: 1 for x, top in up.items() if top in lost}
    else:
        met = _met(lab, conn, outside=2)
        up = contract(met.where("kind = 0").select("a", "b"))
        bad = lab.select(F.explode("bad_rim").alias("lab")).union(met.where("kind = 2").select("a")).distinct()
        roots = bad.join(up, "lab", "left").select(F.coalesce("root", "lab").alias("root")).distinct()
        answers = up.join(roots, "root", "left_semi").select(F.col("lab").alias("id")).union(roots).distinct().select("id", F.lit(1).cast("long").alias("to"))

    def undo(b: pa.RecordBatch, k: int, asked: np.ndarray, to: np.ndarray) -> list[np.ndarray]:
        x, y, own, ids, bad = _cells(b, "before", k), _cells(b, "after", k), _cells(b, "lab", k, "<i4"), _cells(b, "ids", k), _cells(b, "bad", k, "?")
        back = np.append(bad | np.isin(ids, asked), False)
        return [x, np.where(back[own], x, y)]

    return _answered(lab, answers, ["before", "after", "lab", "ids", "bad"], [before, after], undo, chip)


def revert(px: DataFrame, before: str, after: str, target: Sequence[int], conn: int = 4, chip: int = CHIP) -> DataFrame:
    """(row, col, before, after): clumps that the sieve turned into a target class are undone if they touch what stayed outside.

    A flipped clump is undone as a whole if one of its cells touches a cell of the grid that was not a
    target before and did not flip; a cell without data counts as such, the border of the raster doesn't.
    """
    out = from_chips(revert_chips(to_chips(px, [before, after], chip), before, after, target, conn, chip), [before, after], chip)
    return out.select("row", "col", *(F.col(c).cast(px.schema[c].dataType).alias(c) for c in (before, after)))


def dilated(px: DataFrame, conn: int = 4) -> DataFrame:
    """The cells of a set and all cells that touch them."""
    half = _half(conn)
    steps = F.array(*(F.struct(F.lit(dr).cast("long").alias("dr"), F.lit(dc).cast("long").alias("dc")) for dr, dc in ((0, 0), *half, *((-r, -c) for r, c in half))))
    return px.select("row", "col", F.inline(steps)).select((F.col("row") + F.col("dr")).alias("row"), (F.col("col") + F.col("dc")).alias("col")).distinct()


# ---- outlines


def _haloed(chips: DataFrame, chip: int) -> DataFrame:
    """Chips with ``comp`` and ``halo``: the components of the cells around them, as (place, cells) pieces."""
    schema = pa.schema([("chip_r", pa.int64()), ("chip_c", pa.int64()), ("place", pa.int32()), ("piece", pa.binary())])
    # what goes to the chip at (dr, dc) is the side that faces it
    facing = {(-1, 0): np.s_[0], (1, 0): np.s_[-1], (0, -1): np.s_[:, 0], (0, 1): np.s_[:, -1], (-1, -1): np.s_[:1, 0], (-1, 1): np.s_[:1, -1], (1, -1): np.s_[-1:, 0], (1, 1): np.s_[-1:, -1]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r, c, v = b.column(0)[k].as_py(), b.column(1)[k].as_py(), _cells(b, "comp", k).reshape(chip, chip)
                yield _rows([(r + dr, c + dc, -dr * 3 - dc, np.ascontiguousarray(v[at]).tobytes()) for (dr, dc), at in facing.items()], schema)

    pieces = stored(chips.select("chip_r", "chip_c", "comp").mapInArrow(run, f"{_KEY}, place int, piece binary"), "halo")
    few = pieces.count() <= 8 * FEW_CHIPS
    halo = pieces.groupBy("chip_r", "chip_c").agg(F.collect_list(F.struct("place", "piece")).alias("halo"))
    return (chips if few else chips.repartition(_parts(chips), "chip_r", "chip_c")).join(F.broadcast(halo) if few else halo, ["chip_r", "chip_c"], "left")


def _padded(b: pa.RecordBatch, k: int, chip: int) -> np.ndarray:
    """Components of a chip with one row and column of its neighbours around; below 0 where there is none."""
    p = np.full((chip + 2, chip + 2), NODATA)
    p[1:-1, 1:-1] = _cells(b, "comp", k).reshape(chip, chip)
    for h in b.column(b.schema.get_field_index("halo"))[k].as_py() or []:
        dr, dc = (h["place"] + 4) // 3 - 1, (h["place"] + 4) % 3 - 1  # where the piece lies
        p[{-1: 0, 0: np.s_[1:-1], 1: -1}[dr], {-1: 0, 0: np.s_[1:-1], 1: -1}[dc]] = np.frombuffer(h["piece"], "<i8")
    return p


# sides of a cell in walking order, the cell on the right: the way out of it, the way along, corner where the side starts and ends
_OUT, _ALONG = ((-1, 0), (0, 1), (1, 0), (0, -1)), ((0, 1), (1, 0), (0, -1), (-1, 0))
_FROM, _TO = ((0, 0), (0, 1), (1, 1), (1, 0)), ((0, 1), (1, 1), (1, 0), (0, 0))


def _sides(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(direction, row, column) of the sides of a padded chip's cells where its component ends."""
    own = p[1:-1, 1:-1]
    n = len(own)
    out = [np.nonzero((own >= 0) & (p[1 + dr : n + 1 + dr, 1 + dc : n + 1 + dc] != own)) for dr, dc in _OUT]
    d = np.repeat(np.arange(4), [len(x[0]) for x in out])
    return d, np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def polygon_stats_chips(chips: DataFrame, value: str, lon0: float, lat0: float, step: float, zone: int, chip: int = CHIP) -> DataFrame:
    """Per component of chips with ``value`` and ``comp``: value, pixels, bounding box, sides, acres of its outline in one UTM zone.

    The area is the shoelace sum over the directed sides, holes subtract themselves, so no outline has to
    be stitched: a chip gives one row per component in it, and a component of any size is only aggregated.
    """
    ox, oy = (float(z) for z in S.utm_xy_float(lon0, lat0, zone))  # a nearby origin, so that no digits are lost
    names = ["comp", value, "n_px", "r_min", "r_max", "c_min", "c_max", "n_sides", "cross"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r0, c0 = b.column(0)[k].as_py() * chip, b.column(1)[k].as_py() * chip
                p = _padded(b, k, chip)
                at = np.flatnonzero(p[1:-1, 1:-1].ravel() >= 0)
                if not len(at):
                    continue
                ids, first, which = np.unique(p[1:-1, 1:-1].ravel()[at], return_index=True, return_inverse=True)
                m = len(ids)
                order = np.argsort(which, kind="stable")  # cells by component, rows rising inside
                starts = np.searchsorted(which[order], np.arange(m))
                row, col = at[order] // chip, at[order] % chip
                n = np.diff(np.append(starts, len(at)))
                d, sr, sc = _sides(p)
                x, y = S.utm_xy_float(lon0 + np.arange(c0, c0 + chip + 1)[None, :] * step, (lat0 - np.arange(r0, r0 + chip + 1) * step)[:, None], zone)
                x, y = x - ox, y - oy
                f, t = np.array(_FROM)[d], np.array(_TO)[d]
                a, e = (sr + f[:, 0], sc + f[:, 1]), (sr + t[:, 0], sc + t[:, 1])
                of = np.searchsorted(ids, p[1:-1, 1:-1][sr, sc])
                cross = np.bincount(of, weights=x[a] * y[e] - x[e] * y[a], minlength=m)
                cols = [ids, _cells(b, value, k)[at[first]], n, r0 + np.minimum.reduceat(row, starts), r0 + np.maximum.reduceat(row, starts), c0 + np.minimum.reduceat(col, starts), c0 + np.maximum.reduceat(col, starts), np.bincount(of, minlength=m)]
                yield pa.RecordBatch.from_arrays([*(pa.array(z, pa.int64()) for z in cols), pa.array(cross, pa.float64())], names=names)

    parts = _haloed(chips.select("chip_r", "chip_c", value, "comp"), chip).mapInArrow(run, ", ".join([*(f"{n} long" for n in names[:-1]), "cross double"]))
    return parts.groupBy("comp").agg(
        F.first(value).alias(value), F.sum("n_px").alias("n_px"), *(f(c).alias(c) for f, c in ((F.min, "r_min"), (F.max, "r_max"), (F.min, "c_min"), (F.max, "c_max"))),
        F.sum("n_sides").alias("n_sides"), (F.abs(F.sum("cross")) / 2 * S.ACRES_PER_M2).alias("acres"),
    )


def polygon_stats(comp: DataFrame, value: str, lon0: float, lat0: float, step: float, zone: int, chip: int = CHIP) -> DataFrame:
    """The same for cells (row, col, value, comp)."""
    return polygon_stats_chips(to_chips(comp, [value, "comp"], chip), value, lon0, lat0, step, zone, chip)


def _followed(pred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, place) of each element in its chain; an element without a predecessor points at itself. Circles give no fixed point."""
    head, place = pred.copy(), (pred != np.arange(len(pred))).astype(np.int64)
    for _ in range(max(1, int(len(pred)).bit_length())):
        place = place + place[head]
        nxt = head[head]
        if (nxt == head).all():
            break
        head = nxt
    return head, place


def trace(p: np.ndarray, r0: int, c0: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The outlines in a padded chip whose first cell is (r0, c0), as paths of corners.

    Gives per path its component, the number of its first side, that of the side which follows it in another
    chip (-1: the path is closed), its number of corners; and all corners (col, row). A side has the number
    (row * 2^31 + col) * 4 + direction. Where two outlines meet in a corner, a path keeps to its own cell.
    """
    n = len(p) - 2
    d, r, c = _sides(p)
    m = len(d)
    own = p[1:-1, 1:-1]
    if not m:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros((0, 2), np.int64)
    index = np.full(4 * n * n, -1, np.int64)
    index[d * n * n + r * n + c] = np.arange(m)
    along, out = np.array(_ALONG)[d], np.array(_OUT)[d]
    fr, fc = r + along[:, 0], c + along[:, 1]
    same, ahead = p[fr + 1, fc + 1] == own[r, c], p[fr + 1 + out[:, 0], fc + 1 + out[:, 1]] == own[r, c]
    left = same & ahead
    nd = np.where(~same, (d + 1) % 4, np.where(left, (d + 3) % 4, d))
    nr, nc = np.where(~same, r, np.where(left, fr + out[:, 0], fr)), np.where(~same, c, np.where(left, fc + out[:, 1], fc))
    inside = (nr >= 0) & (nr < n) & (nc >= 0) & (nc < n)
    nxt = np.full(m, -1, np.int64)
    nxt[inside] = index[nd[inside] * n * n + nr[inside] * n + nc[inside]]
    number = lambda rr, cc, dd: ((rr + r0) * _COL + cc + c0) * 4 + dd
    pred = np.arange(m)
    pred[nxt[inside]] = np.flatnonzero(inside)
    true_pred = pred.copy()
    head, place = _followed(pred)
    ring = pred[head] != head
    if ring.any():  # circles: broken open at their smallest element
        low, q = np.arange(m), pred.copy()
        for _ in range(int(m).bit_length()):
            low = np.minimum(low, low[q])
            q = q[q]
        cut = np.flatnonzero(ring & (low == np.arange(m)))
        pred[cut] = cut
        head, place = _followed(pred)
    order = np.lexsort((place, head))
    turn = (d != d[true_pred]) | ((true_pred == np.arange(m)))  # corners where nothing turns are left out
    kept = order[turn[order]]
    f = np.array(_FROM)[d[kept]]
    corners = np.stack([c[kept] + f[:, 1] + c0, r[kept] + f[:, 0] + r0], 1)
    heads = head[order[np.append(True, head[order][1:] != head[order][:-1])]]
    ends = order[np.append(head[order][1:] != head[order][:-1], True)]
    count = np.bincount(np.searchsorted(heads, head[kept]), minlength=len(heads))
    follows = np.where(inside[ends], -1, number(nr[ends], nc[ends], nd[ends]))
    return own[r[heads], c[heads]], number(r[heads], c[heads], d[heads]), follows, count, corners


def _ordered(open_: DataFrame, few: int) -> DataFrame:
    """(start, ring, pos) of open paths (start, next), which together form circles: a circle's name is its smallest start.

    Few are walked on the driver; more are doubled as tables, each round stored: first the smallest start
    of each circle, then the number of paths from each to it.
    """
    spark = open_.sparkSession
    head = open_.limit(few + 1).collect()
    if len(head) <= few:
        nxt = {r["start"]: r["next"] for r in head}
        rows, seen = [], set()
        for s in sorted(nxt):
            k, pos = s, 0
            while k not in seen:
                seen.add(k)
                rows.append((k, s, pos))
                k, pos = nxt[k], pos + 1
        return spark.createDataFrame(rows, "start long, ring long, pos long")
    low = stored(open_.select("start", F.col("next").alias("to"), F.least("start", "next").alias("ring")), "rings")
    while True:
        far = low.select(F.col("start").alias("to"), F.col("to").alias("_to"), F.col("ring").alias("_ring"))
        new = stored(low.join(far, "to").select("start", F.col("_to").alias("to"), F.least("ring", "_ring").alias("ring"), (F.col("_ring") < F.col("ring")).alias("moved")), "rings")
        low = new.drop("moved")
        if new.where("moved").isEmpty():
            break
    way = stored(open_.join(low.select("start", "ring"), "start").select("start", "ring", F.col("next").alias("to"), F.lit(1).cast("long").alias("steps")), "rings")
    while not way.where("to <> ring").isEmpty():
        far = way.select(F.col("start").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        moved = way.where("to <> ring").join(far, "to").select("start", "ring", F.col("_to").alias("to"), (F.col("steps") + F.col("_steps")).alias("steps"))
        way = stored(way.where("to = ring").unionByName(moved), "rings")
    return way.select("start", "ring", F.when(F.col("start") == F.col("ring"), F.lit(-(1 << 62))).otherwise(-F.col("steps")).alias("pos"))


def _straight(q: np.ndarray) -> np.ndarray:
    """A closed path without the corners at which nothing turns, its first corner repeated at the end."""
    same = ((q == np.roll(q, 1, axis=0)) & (q == np.roll(q, -1, axis=0))).any(1)  # on one line with both neighbours
    q = q[~same]
    return np.concatenate([q, q[:1]])


def polygonise_chips(chips: DataFrame, value: str, lon0: float, lat0: float, step: float, chip: int = CHIP, few: int = FEW_LINKS) -> DataFrame:
    """(comp, value, wkb) of chips with ``value`` and ``comp``: one polygon per component of any size, in degrees.

    Outlines are traced inside chips; paths that leave a chip are put in order like a linked list and joined
    when the polygon is written, which is the only place where one task holds one polygon.
    """
    names = ["comp", "start", "next", value, "pts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r0, c0 = b.column(0)[k].as_py() * chip, b.column(1)[k].as_py() * chip
                comp, start, follows, count, corners = trace(_padded(b, k, chip), r0, c0)
                if not len(comp):
                    continue
                cell = start >> 2
                v = _cells(b, value, k)[(cell // _COL - r0) * chip + cell % _COL - c0]
                offsets = np.append(0, np.cumsum(count * 16)).astype(np.int32)
                pts = pa.Array.from_buffers(pa.binary(), len(comp), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(corners).tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(comp), pa.array(start), pa.array(follows, mask=follows < 0), pa.array(v), pts], names=names)

    paths = stored(_haloed(chips.select("chip_r", "chip_c", value, "comp"), chip).mapInArrow(run, f"comp long, start long, next long, {value} long, pts binary"), "paths")
    order = _ordered(paths.where("next is not null").select("start", "next"), few)
    closed = paths.where("next is null").select("comp", value, F.col("start").alias("ring"), F.lit(0).cast("long").alias("pos"), "pts")
    whole = closed.unionByName(paths.where("next is not null").join(order, "start").select("comp", value, "ring", "pos", "pts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("comp",)):
            first, end = edges(t, ("comp",))
            ring, pts = t.column("ring").to_numpy(), t.column("pts").to_pylist()
            shapes = []
            for a, b in zip(first.tolist(), end.tolist(), strict=True):
                cut = [a, *(np.flatnonzero(np.diff(ring[a:b])) + a + 1).tolist(), b]
                parts = []
                for x, y in zip(cut, cut[1:], strict=False):
                    q = np.frombuffer(pts[x] if y == x + 1 else b"".join(pts[x:y]), "<i8").reshape(-1, 2)
                    q = _straight(q) if y > x + 1 else np.concatenate([q, q[:1]])
                    parts.append(np.stack([lon0 + q[:, 0] * step, lat0 - q[:, 1] * step], 1))
                shapes.append(wkb_polygon(parts))
            at = pa.array(first)
            yield pa.RecordBatch.from_arrays([t.column("comp").combine_chunks().take(at), t.column(value).combine_chunks().take(at), pa.array(shapes, pa.binary())], names=["comp", value, "wkb"])

    return whole.repartition("comp").sortWithinPartitions("comp", "ring", "pos").select("comp", value, "ring", "pts").mapInArrow(join, f"comp long, {value} long, wkb binary")


def polygonise(comp: DataFrame, value: str, lon0: float, lat0: float, step: float, chip: int = CHIP, few: int = FEW_LINKS) -> DataFrame:
    """The same for cells (row, col, value, comp)."""
    return polygonise_chips(to_chips(comp, [value, "comp"], chip), value, lon0, lat0, step, chip, few)


def wkb_polygon(parts: list[np.ndarray]) -> bytes:
    """WKB of one polygon, the ring of the largest extent first."""
    area = [abs(float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum())) for p in parts]
    order = sorted(range(len(parts)), key=lambda i: -area[i])
    body = b"".join(struct.pack("<I", len(parts[i])) + np.ascontiguousarray(parts[i], "<f8").tobytes() for i in order)
    return struct.pack("<BII", 1, 3, len(parts)) + body


def wkb_rings(wkb: bytes) -> Iterator[np.ndarray]:
    """The rings of a WKB polygon or multipolygon (little endian)."""
    order, kind, n = struct.unpack_from("<BII", wkb, 0)
    if order != 1 or kind not in (3, 6):
        raise ValueError("not a little-endian polygon")
    at = 9
    for _ in range(n if kind == 6 else 1):
        if kind == 6:
            (k,) = struct.unpack_from("<I", wkb, at + 5)
            at += 9
        else:
            k = n
        for _ in range(k):
            (m,) = struct.unpack_from("<I", wkb, at)
            yield np.frombuffer(wkb, "<f8", 2 * m, at + 4).reshape(m, 2)
            at += 4 + 16 * m
