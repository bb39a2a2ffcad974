"""Implausible readings of numeric series: departures, constant stretches, impossible values.

Per source (run) and metric: a robust seasonal-trend decomposition (running median, phase medians of the
source's season) leaves a remainder; remainders beyond the limits of the generalised extreme studentised
deviate test, with the source's own robust scatter around the reading, are departures if the series returns
to its course within ``LONGEST`` samples. Gauges are decomposed on a log scale, since their scatter grows
with their level; a cumulative counter's course is rising, and its remainder is what breaks that course.
Constant runs and ranges are checked separately.

A source is cut into blocks of ``BLOCK`` consecutive samples with ``HALO`` samples of its neighbours on
either side, so a source with a third of all rows is worked on by many tasks; the numbering that the
blocks need comes from a prefix scan over per-minute counts. What reaches beyond a block is carried by
block summaries: the season (autocorrelation sums of all blocks, phase medians of the whole source) and
the length of a constant stretch (counts of readings and places of the last and next change).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .arrow import edges, whole_groups
from .scan import carry, number_rows

METRICS = ("rss_tree_mb", "cpu_tree_pct", "net_recv_mb")
#: metric -> is it a cumulative counter
COUNTERS = {"rss_tree_mb": False, "cpu_tree_pct": False, "net_recv_mb": True}

BLOCK, HALO = 1024, 64
LONGEST = 3  #: samples of a departure
STILL = 8  #: readings of a constant stretch
#: chance that a series without departures has one beyond the limit; small, since a corpus has millions of series
ALPHA = 1e-9
SIDE = 24  #: readings before and after a departure that its scatter is taken from
RETURN, MOVED = 1 / 3, 4  #: a course that moved by more than this share of a departure meanwhile asks for so many times the deviate
GRAIN = 0.001  #: relative precision of a gauge: scatter below it is not told apart from none
FEW_BLOCKS = 200_000  #: block summaries that the driver walks through itself (about 60 bytes each)
LAGS = 512  #: longest season of a source in samples
#: MB/s and MB of the received volume that no run can exceed (a 10 Gbit/s link; 5 TB)
MAX_RATE, MAX_VOLUME = 1250.0, 5e6

SCHEMA = "sample_id long, metric string, why string"


def windows(x: np.ndarray, w: int) -> np.ndarray:
    """All centred windows of odd width w, mirrored at the ends."""
    h = w // 2
    return np.lib.stride_tricks.sliding_window_view(np.pad(x, h, mode="reflect" if len(x) > h else "symmetric"), w)


def trend(x: np.ndarray) -> np.ndarray:
    """Running median, wide enough that a departure is a minority of its window."""
    return np.median(windows(x, 2 * LONGEST + 1), axis=1)


def gauge_scale(x: np.ndarray) -> np.ndarray:
    """The scale on which a gauge's scatter doesn't depend on its level."""
    positive = x[x > 0]
    return np.log(np.maximum(x, 0) + (0.01 * np.median(positive) if len(positive) else 1.0))


def correlation(rest: np.ndarray, at: np.ndarray, lags: int) -> np.ndarray:
    """Lagged product sums of a clipped, centred remainder at places ``at`` for lags 0 to ``lags``, as if every lag had as many pairs."""
    n = int(at[-1] - at[0]) + 1
    mid = np.median(rest)
    far = 10 * 1.4826 * np.median(np.abs(rest - mid))
    c = np.clip(rest, mid - far, mid + far)
    grid = np.zeros(n)
    grid[at - at[0]] = c - c.mean()
    f = np.fft.rfft(grid, 2 * n)
    ac = np.zeros(lags + 1)
    got = np.fft.irfft(f * np.conj(f))[: min(lags + 1, n)]
    ac[: len(got)] = got * (n / (n - np.arange(len(got))))
    return ac


def period(ac: np.ndarray, n: int, least: int = 4) -> int:
    """The lag with the strongest correlation, or 0 if none exceeds 0.6, is a peak and has six cycles in n readings."""
    ac = ac[: n // 6 + 1]
    if len(ac) <= least or not ac[0] > 0:
        return 0
    ac = ac / ac[0]
    p = least + int(np.argmax(ac[least:]))
    return 0 if ac[p] < 0.6 or ac[p] <= max(ac[p - 1], ac[min(p + 1, len(ac) - 1)]) - 1e-12 else p


def season(y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The season of a whole series with readings at places ``at``, zeros where it has none."""
    n = int(at[-1] - at[0]) + 1 if len(at) else 0
    rest = y - trend(y) if n >= 24 else y
    p = period(correlation(rest, at, n // 6 + 1), n) if n >= 24 else 0
    if not p:
        return np.zeros(len(y))
    phase = at % p
    mids = np.array([np.median(rest[phase == k]) if (phase == k).any() else 0.0 for k in range(p)])
    return (mids - np.median(mids))[phase]


def deviate_limit(n: np.ndarray | float, alpha: float = ALPHA) -> np.ndarray:
    """Critical values of the generalised ESD test with n values left (t quantile by expansion)."""
    n = np.maximum(np.asarray(n, float), 5.0)
    z = np.array([NormalDist().inv_cdf(1 - alpha / (2 * k)) for k in np.atleast_1d(n)]).reshape(n.shape)
    v = n - 2
    t = z + (z**3 + z) / (4 * v) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * v**2)
    return (n - 1) * t / np.sqrt((v + t * t) * n)


def beyond_limits(size: np.ndarray, n: int, alpha: float = ALPHA) -> np.ndarray:
    """Which deviates, given in the order of their removal from n values, exceed their limit.

    Location and scale of ``size`` leave the tested value out; the limits are for deviates that include it.
    """
    left = np.maximum(n - np.arange(len(size), dtype=float), 5.0)
    big = np.minimum(size, 1e9)
    return (left - 1) * big / np.sqrt((left - 2 + big * big) * left) > deviate_limit(left, alpha)


def departures(x: np.ndarray, counter: bool, at: np.ndarray | None = None, s: np.ndarray | None = None) -> np.ndarray:
    """Marks departures in a series without nulls. Fewer than 5 values have no course: nothing is marked.

    ``at``: the places of the readings, ``s``: the season of a gauge on its log scale; found in the series
    itself if not given.
    """
    if len(x) < 5:
        return np.zeros(len(x), bool)
    if counter:
        return _off_rising_course(x)
    y = gauge_scale(x)
    return _off_course(y - (season(y, np.arange(len(y)) if at is None else at) if s is None else s))


def _off_course(y: np.ndarray) -> np.ndarray:
    n = len(y)
    out = np.zeros(n, bool)
    rest = y - trend(y)
    steps = np.abs(np.diff(y)) * (1.4826 / 2**0.5)  # of independent scatter, a step has twice the variance
    w = min(SIDE, len(steps))
    sides = np.median(np.lib.stride_tricks.sliding_window_view(steps, w), axis=1)
    at = np.arange(n)
    usual = max(float(np.median(steps)), GRAIN)
    scale = np.maximum(np.maximum(sides[np.clip(at - w, 0, len(sides) - 1)], sides[np.clip(at, 0, len(sides) - 1)]), usual)
    far = np.abs(rest) > 4 * scale
    ids = np.flatnonzero(far)
    if not len(ids):
        return out
    groups = np.split(ids, np.flatnonzero((np.diff(ids) > 1) | (np.sign(rest[ids[1:]]) != np.sign(rest[ids[:-1]]))) + 1)
    normal = np.flatnonzero(~far)
    found = []
    for g in groups:
        k = np.searchsorted(normal, g[0])
        before, after = normal[max(0, k - 3) : k], normal[k : k + 3]
        if len(g) > LONGEST or len(before) < 3 or len(after) < 3:  # no course to return to
            continue
        a, b = np.median(y[before]), np.median(y[after])
        d = y[g].min() - max(a, b) if rest[g[0]] > 0 else min(a, b) - y[g].max()
        if d > 0:
            back = max(abs(a - b), abs(y[before[-1]] - y[after[0]])) <= RETURN * d
            found.append((d / scale[g].min(), d, g, back))
    found.sort(key=lambda f: -f[0])
    alive = np.ones(n, bool)
    size = []
    for _, d, g, back in found:  # the scatter of the series without what is more extreme
        alive[g] = False
        lo, hi = max(0, g[0] - 2 * SIDE), g[-1] + 1
        left, right = y[lo : g[0]][alive[lo : g[0]]][-SIDE - 1 :], y[hi : hi + 2 * SIDE][alive[hi : hi + 2 * SIDE]][: SIDE + 1]
        size.append(d / max(usual, _upper(left), _upper(right)) / (1 if back else MOVED))
    hits = np.flatnonzero(beyond_limits(np.array(size), n))
    for k, (_, _, g, _) in enumerate(found):  # what is more extreme than an outlier beside it is one too
        out[g] = any(h >= k and abs(found[h][2][0] - g[0]) <= 2 * SIDE and found[h][1] <= found[k][1] for h in hits)
    return out


def _upper(y: np.ndarray) -> float:
    """Scatter of a stretch from the 85 % quantile of its steps: of regimes side by side, that of the wilder one."""
    if len(y) < 3:
        return 0.0
    steps = np.sort(np.abs(np.diff(y)))
    return float(steps[int(0.85 * (len(steps) - 1) + 0.5)]) / (1.44 * 2**0.5)


def _off_rising_course(x: np.ndarray) -> np.ndarray:
    """Readings off a rising course that is resumed: above what follows or below what came before.

    On a rising course the running median is the reading itself, so the remainder of a normal reading is 0
    and its scatter is the counter's jitter, at least the smallest step seen. Short departures are looked
    for first; what is found is taken out and the rest is decomposed again, since a departure may hide
    another one beside it.
    """
    out = np.zeros(len(x), bool)
    left = np.arange(len(x))
    again = True
    while again:
        again = False
        for k in range(1, LONGEST + 1):
            y = x[left]
            n = len(y)
            if n < 5:
                return out
            i = np.arange(1, n - k)
            pre, post = y[i - 1], y[i + k]
            inside = np.lib.stride_tricks.sliding_window_view(y, k)[i]
            d = np.maximum(inside.min(1) - post, pre - inside.max(1))
            ok = (pre <= post) & (d > 0)
            if not ok.any():
                continue
            i, d = i[ok], d[ok]
            rest = y - trend(y)
            free = np.ones(n, bool)
            for j in range(-LONGEST, k + LONGEST):  # what lies in a window with a candidate has no clean remainder
                free[np.clip(i + j, 0, n - 1)] = False
            steps = np.abs(np.diff(y))
            steps = steps[steps > 0]
            grain = float(steps.min()) if len(steps) else 1e-9
            jitter = 1.4826 * float(np.median(np.abs(rest[free]))) if free.any() else 0.0
            i, d = i[np.argsort(-d, kind="stable")], np.sort(d)[::-1]
            hit = i[beyond_limits(d / max(jitter, grain), n)]
            if len(hit):
                found = np.zeros(n, bool)
                for a in hit:
                    found[a : a + k] = True
                out[left[found]] = True
                left = left[~found]
                again = True
    return out


def still(x: np.ndarray, before: int = 0, after: int = 0) -> np.ndarray:
    """Marks stretches of ``STILL`` or more equal values in a series without nulls.

    ``before`` and ``after``: readings by which its first and last stretch go on outside.
    """
    if not len(x):
        return np.zeros(0, bool)
    starts = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    lengths = np.diff(np.append(starts, len(x)))
    total = lengths.copy()
    total[0] += before
    total[-1] += after
    return np.repeat(total >= STILL, lengths)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], int, int]]:
    """Columns and first and last row of each block, from batches sorted by (run_id, block, rn)."""
    keys = ("run_id", "block")
    for t in whole_groups(batches, keys):
        c = {n: t.column(n).to_numpy(zero_copy_only=False) for n in t.column_names if n != "head"}
        c["head"] = t.column("head").combine_chunks() if "head" in t.column_names else None
        own = c["rn"] // BLOCK == c["block"]
        for a, b in zip(*edges(t, keys), strict=True):
            if own[a:b].any():  # else the last block's readings were copied to one that isn't there
                yield c, int(a), int(b)


def _readings(c: dict[str, np.ndarray], a: int, b: int, m: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a block, which of them are there, and which of those can't be."""
    x = c[m][a:b].astype(float)
    there = ~np.isnan(x)
    if m == "cpu_tree_pct" and c["rn"][a] == 0:  # the first one says nothing by design
        there[0] = False
    return x, there, there & ((x < 0) | (x > c[f"limit_{m}"][a:b].astype(float)))


_SUMMARY = "run_id long, block long, metric int, n long, first double, last double, change_first long, change_last long, ac array<double>"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and metric of sources that have several blocks: readings, changes of value, autocorrelation sums."""
    rows: list[tuple] = []
    names = [x.split()[0] for x in _SUMMARY.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.float64())]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for c, a, b in _blocks(batches):
        block = int(c["block"][a])
        core = c["rn"][a:b] // BLOCK == block
        if not block and core.sum() < BLOCK:
            continue
        for k, m in enumerate(METRICS):
            x, there, wrong = _readings(c, a, b, m)
            v = x[there & core]
            change = np.flatnonzero(v[1:] != v[:-1]) + 1
            at = np.flatnonzero(there & ~wrong)
            ac = None
            if not COUNTERS[m] and len(at) >= 24:
                y = gauge_scale(x[at])
                ac = correlation(y - trend(y), c["rn"][a:b][at], LAGS).tolist()
            ends = (float(v[0]), float(v[-1])) if len(v) else (None, None)
            rows.append((int(c["run_id"][a]), block, k, len(v), *ends, *((int(change[0]), int(change[-1])) if len(change) else (None, None)), ac))
        if len(rows) > 3000:
            yield out()
            rows.clear()
    if rows:
        yield out()


def _phases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remainders by phase, of sources that have a season; their periods stand in the first row of a block."""
    for c, a, b in _blocks(batches):
        at_core = np.flatnonzero(c["rn"][a:b] // BLOCK == c["block"][a])
        head = c["head"][a + int(at_core[0])].as_py()
        for k, m in enumerate(METRICS):
            p = (head or {}).get(f"p{k}")
            if p:
                x, there, wrong = _readings(c, a, b, m)
                at = np.flatnonzero(there & ~wrong)
                y = gauge_scale(x[at])
                rest = y - trend(y)
                mine = np.isin(at, at_core)
                phase = (c["rn"][a:b][at] % p)[mine]
                n = len(phase)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c["run_id"][a]), pa.int64()), pa.array(np.full(n, k), pa.int32()), pa.array(phase, pa.int64()), pa.array(rest[mine])], names=["run_id", "metric", "phase", "rest"])


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c, a, b in _blocks(batches):
        rn = c["rn"][a:b]
        core = rn // BLOCK == c["block"][a]
        head = c["head"][a + int(np.flatnonzero(core)[0])].values
        head = None if head is None else head.to_numpy()
        place = 0
        ids, metric, reason = [], [], []
        for k, m in enumerate(METRICS):
            x, there, wrong = _readings(c, a, b, m)
            own = np.flatnonzero(there & core)
            v = x[own]
            before = after = 0
            s = None
            if head is not None:
                prev, before, after, n = head[place : place + 4]
                before, after, n = int(before) if len(v) and v[0] == prev else 0, int(after), int(n)
                at = np.flatnonzero(there & ~wrong)
                s = head[place + 4 : place + 4 + n][rn[at] % n] if n else np.zeros(len(at))
                place += 4 + n
            if len(v) and not (v != v[0]).any():  # one stretch
                before, after = before + after, 0
            stuck = np.zeros(len(x), bool)
            stuck[own] = still(v, before, after)
            at = np.flatnonzero(there & ~wrong)
            off = np.zeros(len(x), bool)
            off[at] = departures(x[at], COUNTERS[m], rn[at], s)
            for why, hit in (("range", wrong), ("still", stuck), ("departure", off)):
                found = c["sample_id"][a:b][hit & core]
                if len(found):
                    ids.append(found)
                    metric += [m] * len(found)
                    reason += [why] * len(found)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()), pa.array(metric), pa.array(reason)], names=["sample_id", "metric", "why"])


def _outside(sums: DataFrame, few: int = FEW_BLOCKS) -> DataFrame:
    """(run_id, block, metric, prev, before, after): the last value before each block, and by how many readings
    the stretch that ends before it and the one that it ends with go on outside.

    Few summaries are walked through on the driver; more are carried by prefix scans over tables.
    """
    source = ["run_id", "metric"]
    what = sums.select(*source, "block", "n", "first", "last", "change_first", "change_last")
    head = what.limit(few + 1).collect()
    if len(head) <= few:
        return sums.sparkSession.createDataFrame(_walk(head), "run_id long, metric int, block long, prev double, before long, after long")
    c = carry(sums, source, "block", {"_base": ("sum", "n"), "_prev": ("last", "last")})
    opens = F.col("first").isNotNull() & F.coalesce(F.col("first") != F.col("_prev"), F.lit(True))
    c = c.withColumns({"_cf": F.when(opens, F.col("_base")).otherwise(F.col("_base") + F.col("change_first")), "_cl": F.coalesce(F.col("_base") + F.col("change_last"), F.when(opens, F.col("_base")))})
    c = carry(c, source, "block", {"_start": ("last", "_cl"), "_end": ("next", "_cf")})
    c = c.join(sums.groupBy(*source).agg(F.sum("n").alias("_total")), source)
    return c.select(*source, "block", F.col("_prev").alias("prev"), (F.col("_base") - F.col("_start")).alias("before"), (F.coalesce("_end", "_total") - F.col("_base") - F.col("n")).alias("after"))


def _walk(rows: list) -> list[tuple]:
    out = []
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    for _, own in groupby(rows, key=lambda r: (r[0], r[1])):
        own = list(own)
        base, prev, start, seen = 0, None, None, []
        for r in own:
            opens = r["n"] and r["first"] != prev
            seen.append([prev, None if start is None else base - start, base + r["n"], base if opens else None if r["change_first"] is None else base + r["change_first"]])
            if r["change_last"] is not None:
                start = base + r["change_last"]
            elif opens:
                start = base
            prev = r["last"] if r["n"] else prev
            base += r["n"]
        end = base
        for r, (p, before, upto, change) in zip(reversed(own), reversed(seen), strict=True):
            out.append((r[0], r[1], r[2], p, before, end - upto))
            end = end if change is None else change
    return out


def _per_metric(what: Column, name: str) -> list[Column]:
    return [F.first(F.when(F.col("metric") == k, what), True).alias(f"{name}{k}") for k in range(len(METRICS))]


def find(samples: DataFrame, hosts: DataFrame) -> DataFrame:
    """Rows (sample_id, metric, why) of all implausible readings, ``why`` in range, still, departure.

    ``samples`` has sample_id, run_id, host, t_cs, ingest_ts and the metrics; other columns are ignored.
    Rows delivered twice (same sample_id) count once, the earliest delivery. Rows with a null
    sample_id, run_id or t_cs take no part, null readings are skipped, ties in time follow sample_id.
    A host that is null or not in ``hosts`` sets no range limit from it. The first cpu reading of a run
    takes no part. A departure needs three normal readings on either side. Empty tables give no rows.
    The numbered readings and the block summaries are written to the shared folder once.
    """
    caps = hosts.groupBy(F.col("host").alias("_host")).agg(F.max("mem_total_mb").alias("_mem"), F.max("n_cores").alias("_cores"))
    d = samples.select("sample_id", "run_id", "host", "t_cs", "ingest_ts", *METRICS).where("sample_id is not null and run_id is not null and t_cs is not null")
    d = d.withColumn("_min", F.floor(F.col("t_cs") / 24_000).cast("long"))
    kept = ["host", "t_cs", *METRICS]
    # the two deliveries have one time, so one shuffle by (run, minutes) serves this, the counting and the numbering
    d = d.repartition("run_id", "_min").groupBy("run_id", "_min", "sample_id").agg(F.min_by(F.struct(*kept), F.coalesce("ingest_ts", F.lit("9999-12-31").cast("timestamp"))).alias("_r")).select("run_id", "_min", "sample_id", "_r.*")
    d = number_rows(d, ["run_id"], "_min", ["t_cs", "sample_id"]).drop("_min")
    d = d.join(caps, d.host == caps._host, "left").drop("_host", "host")
    inf = F.lit(float("inf"))
    limits = {"rss_tree_mb": F.coalesce("_mem", inf), "cpu_tree_pct": F.coalesce(F.col("_cores") * 100.0, inf), "net_recv_mb": F.least(F.greatest(F.col("t_cs") / 100, F.lit(1.0)) * MAX_RATE, F.lit(MAX_VOLUME))}
    d = stored(d.select("sample_id", "run_id", "rn", *METRICS, *(limits[m].alias(f"limit_{m}") for m in METRICS)), "numbered")
    own, at = F.floor(F.col("rn") / BLOCK).cast("long"), F.col("rn") % BLOCK
    blocks = F.array_compact(F.array(own, F.when((at < HALO) & (own > 0), own - 1), F.when(at >= BLOCK - HALO, own + 1)))
    keys = ("run_id", "block", "rn")
    # Python works on what is a small shuffle, so its partitions are not to be coalesced by size
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = d.select("*", F.explode(blocks).alias("block")).repartition(parts, "run_id", "block")
    sums = stored(cut.sortWithinPartitions(*keys).mapInArrow(_summaries, _SUMMARY), "blocks")
    source = ["run_id", "metric"]
    c = _outside(sums.drop("ac"))
    longest = sums.groupBy(*source).agg(F.max("block").alias("_blocks"))
    lag = sums.where("ac is not null").select(*source, F.posexplode("ac").alias("lag", "a")).groupBy(*source, "lag").agg(F.sum("a").alias("a"))
    acs = lag.groupBy(*source).agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "a"))), lambda x: x["a"]).alias("ac")).join(longest, source)  # LAGS + 1 elements
    strength = F.transform(F.slice("ac", 5, LAGS), lambda x: x / F.get("ac", F.lit(0)))
    best = F.array_max(F.transform(strength, lambda x, i: F.struct(x.alias("r"), (-i).alias("i"))))
    p = acs.where("get(ac, 0) > 0").select(*source, "ac", "_blocks", best.alias("b")).select(*source, "ac", "_blocks", "b.r", (4 - F.col("b.i")).cast("int").alias("p"))
    peak = (F.col("p") < LAGS) & (F.element_at("ac", F.col("p") + 1) > F.greatest(F.element_at("ac", F.col("p")), F.element_at("ac", F.least(F.col("p") + 2, F.lit(LAGS + 1)))))
    p = p.where((F.col("r") >= 0.6) & peak & (F.col("p") * 6 <= F.col("_blocks") * BLOCK)).select(*source, "p")
    periods = stored(p, "periods")
    head = F.when(F.col("rn") == F.col("block") * BLOCK, F.col("head")).alias("head")
    every = cut.columns
    phased = periods.groupBy("run_id").agg(*_per_metric(F.col("p"), "p")).select("run_id", F.struct(*(f"p{k}" for k in range(len(METRICS)))).alias("head"))
    if periods.isEmpty():
        c = c.withColumn("season", F.lit(None).cast("array<double>"))
    else:
        ph = cut.join(phased, "run_id").select(*every, head).repartition(parts, "run_id", "block").sortWithinPartitions(*keys).mapInArrow(_phases, "run_id long, metric int, phase long, rest double")
        mid = ph.groupBy(*source, "phase").agg(F.percentile_approx("rest", F.lit(0.5), F.lit(1000)).alias("m"))
        mids = mid.groupBy(*source).agg(F.map_from_entries(F.collect_list(F.struct("phase", "m"))).alias("by"), F.median("m").alias("mm")).join(periods, source)
        seasons = mids.select(*source, F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda i: F.coalesce(F.element_at("by", i.cast("long")), F.col("mm")) - F.col("mm")).alias("season"))
        c = c.join(seasons, source, "left")
    # one flat list per block, since a nested column costs the conversion of every row: previous value, readings before and after, length of the season, season
    none = F.array().cast("array<double>")
    own_season = F.coalesce("season", none)
    info = F.concat(F.array(F.coalesce("prev", F.lit(float("nan"))), F.coalesce("before", F.lit(0)).cast("double"), F.coalesce("after", F.lit(0)).cast("double"), F.size(own_season).cast("double")), own_season)
    heads = c.groupBy("run_id", "block").agg(*_per_metric(info, "h")).select("run_id", "block", F.concat(*(f"h{k}" for k in range(len(METRICS)))).alias("head"))
    return cut.join(heads, ["run_id", "block"], "left").select(*every, head).sortWithinPartitions(*keys).mapInArrow(_flags, SCHEMA)
