"""Core operators on small inputs: brute force, nulls, ties, repeats, empty tables, clashing columns, hot keys."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.operators import intervals, nested, regular_grid, scan, spikes
from terrasift.sources.tables import epoch_seconds, sample_time
from terrasift.streaming import nearest


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- prefix scans


def test_carry_is_an_exclusive_scan_over_any_width(spark):
    rnd = random.Random(1)
    data = [(k, s, rnd.choice([None, rnd.randint(-5, 5)])) for k in "ab" for s in rnd.sample(range(-20, 60), 40)]
    df = spark.createDataFrame(data, "k string, s int, v int")
    out = scan.carry(df, ["k"], "s", {"a": ("sum", "v"), "b": ("max", "v"), "c": ("last", "v"), "d": ("next", "v")}, width=7)
    got = {(r.k, r.s): (r.a, r.b, r.c, r.d) for r in out.collect()}
    for k, s, _ in data:
        before = [v for kk, ss, v in sorted(data, key=lambda x: x[1]) if kk == k and ss < s and v is not None]
        after = [v for kk, ss, v in sorted(data, key=lambda x: x[1]) if kk == k and ss > s and v is not None]
        assert got[k, s] == (sum(before), max(before, default=None), before[-1] if before else None, after[0] if after else None)


def test_number_rows_counts_through_buckets(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.floor(F.col("id") / 37).alias("b"))
    got = rows(scan.number_rows(df, ["k"], "b", ["t"]).select("k", "t", "rn"))
    assert got == sorted((t % 2, t, t // 2) for t in range(1000))


# ---- intervals


def brute_periods(events):
    out = set()
    for k in {e[0] for e in events if e[0] is not None}:
        iv = sorted((s, e) for kk, s, e in events if kk == k and s is not None and e is not None and e > s)
        merged = []
        for s, e in iv:
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out |= {(k, "period", a, b) for a, b in merged}
        out |= {(k, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:], strict=False)}
    return sorted(out)


@pytest.mark.parametrize("width", [5, 50, 60_000])
def test_periods_and_gaps_against_brute_force(spark, width):
    rnd = random.Random(width)
    ev = [(rnd.choice([1, 1, 1, 2, 3]), s := rnd.randint(0, 400), s + rnd.randint(-3, 25)) for _ in range(120)]
    ev += ev[:10] + [(None, 1, 2), (1, None, 5), (2, 3, None), (4, 7, 7), (5, 0, 10), (5, 10, 20), (5, 21, 22), (6, 0, 1000), (6, 5, 6)]
    df = spark.createDataFrame(ev, "run_id long, s long, e long").withColumns({"_k": F.lit("x"), "_shard": F.lit(1), "span_kind": F.lit("no")})
    assert rows(intervals.periods_and_gaps(df, "run_id", "s", "e", width)) == brute_periods(ev)


def test_periods_of_an_empty_table(spark):
    assert rows(intervals.periods_and_gaps(spark.createDataFrame([], "k long, s long, e long"), "k", "s", "e")) == []


# ---- regular grid


@pytest.mark.parametrize("shard", [2, 3, 64])
def test_grid_fills_all_shards(spark, shard):
    data = [(1, 0, 5.0), (1, 1, 7.0), (1, 3, None), (1, 39, 27.0), (1, 41, None), (2, 9, None), (3, 25, 1.0), (None, 3, 1.0), (4, None, 1.0), (5, -4, 1.0), (1, 39, 27.0)]
    df = spark.createDataFrame(data, "k long, t long, v double").withColumn("_slot", F.lit("clash")).withColumn("how", F.lit(1))
    got = {(r.k, r.slot_no): (r.reading, r.filled, r.how) for r in regular_grid.to_grid(df, "k", "t", "v", 2, shard).collect()}
    assert {k for k, _ in got} == {1, 2, 3}
    assert [s for k, s in sorted(got) if k == 1] == list(range(21))
    assert got[1, 0] == (7.0, 7.0, "reading") and got[1, 19] == (27.0, 27.0, "reading")
    assert got[1, 1][2] == "between" and abs(got[1, 1][1] - (7 + 20 / 19)) < 1e-9
    assert got[1, 20] == (None, 27.0, "after")
    assert got[2, 4] == (None, None, "none") and got[3, 0] == (None, 1.0, "before") and got[3, 12][2] == "reading"


def test_grid_of_an_empty_table(spark):
    assert rows(regular_grid.to_grid(spark.createDataFrame([], "k long, t long, v double"), "k", "t", "v", 2)) == []


# ---- times of samples


def test_sample_time_takes_elapsed_then_the_epoch_in_any_unit(spark):
    s = spark.createDataFrame([(1, 1, 1.25, None), (2, 1, None, 1001.5), (3, 1, None, 1.0015e12), (4, 2, None, 5.0), (5, None, None, 5.0), (6, 1, None, None)], "sample_id long, run_id long, elapsed_s double, t_epoch double")
    r = spark.createDataFrame([(1, 1000.0), (1, 1000.0), (2, None), (None, 3.0)], "run_id long, t0_epoch double")
    assert [x.t_cs for x in sample_time(s, r).orderBy("sample_id").collect()] == [125, 150, 100150000000 - 100000, None, None, None]
    big = spark.range(1).select(epoch_seconds(F.lit(1.79e12)).alias("a"), epoch_seconds(F.lit(1.79e15)).alias("b"), epoch_seconds(F.lit(1.79e9)).alias("c")).first()
    assert tuple(big) == (1.79e9, 1.79e9, 1.79e9)


# ---- spikes


def test_departures_of_a_gauge():
    rnd = np.random.default_rng(0)
    x = 1000 * (1 + 0.01 * rnd.standard_normal(200))
    x[100:] *= 3  # a lasting change of level
    want = np.zeros(200, bool)
    for a, k, f in ((20, 1, 5), (40, 2, 0.1), (60, 3, 2.5), (130, 1, 0.2), (99, 1, 6)):
        x[a : a + k] *= f
        want[a : a + k] = True
    x[150:154] *= 4  # a longer burst
    assert (spikes.departures(x, False) == want).all()


def test_departures_of_a_counter():
    rnd = np.random.default_rng(1)
    x = np.cumsum(rnd.uniform(0, 5, 150))
    want = np.zeros(150, bool)
    for a, k, v in ((30, 1, 900.0), (60, 2, 2.0), (90, 3, 5000.0), (63, 1, 8000.0)):
        x[a : a + k] = v + np.arange(k)
        want[a : a + k] = True
    x[120:] += 700
    assert (spikes.departures(x, True) == want).all()


def test_a_season_is_no_departure():
    t = np.arange(240)
    x = 100 + 80.0 * (t % 12 == 0) + 0.2 * np.random.default_rng(2).standard_normal(240)
    assert not spikes.departures(x, False)[12:-12].any()
    x[101] = 400
    assert list(np.flatnonzero(spikes.departures(x, False)[12:-12]) + 12) == [101]


def test_still_and_short_series():
    x = np.array([1.0] * 8 + [2.0] * 7 + [3.0])
    assert spikes.still(x).tolist() == [True] * 8 + [False] * 8
    assert not spikes.departures(np.array([1.0, 900.0, 1.0]), False).any() and len(spikes.still(np.zeros(0))) == 0


def test_deviate_limits_agree_with_published_values():
    # Rosner's limits for n = 54, alpha 0.05: 3.158, 3.151 for the first two outliers
    assert abs(spikes.deviate_limit(54.0, 0.05) - 3.158) < 0.01 and abs(spikes.deviate_limit(53.0, 0.05) - 3.151) < 0.01


def _samples(spark, n=2600, run=1):
    rnd = np.random.default_rng(3)
    rss, cpu, net = 1000 * (1 + 0.01 * rnd.standard_normal(n)), 90 + rnd.standard_normal(n), np.cumsum(rnd.uniform(0, 3, n))
    data = [[run * 100000 + i, run, "h", 50 * i, None, float(rss[i]), float(cpu[i]), float(net[i])] for i in range(n)]
    return data


def test_find_over_blocks_and_dirt(spark):
    data = _samples(spark)
    want = set()
    for i, v in ((1022, 9000.0), (1023, 9100.0), (1024, 9050.0), (2047, 10.0)):  # across a block border
        data[i][5] = v
        want.add((100000 + i, "rss_tree_mb"))
    for i in range(1018, 1030):
        data[i][7] = data[1018][7]
        want.add((100000 + i, "net_recv_mb"))
    data[0][6] = 0.0
    data[5][6], data[6][5], data[7][7] = 401.0, -1.0, 1e12
    want |= {(100005, "cpu_tree_pct"), (100006, "rss_tree_mb"), (100007, "net_recv_mb")}
    data[50][5] = None
    data += [data[1022], [None, 1, "h", 3, None, 1.0, 1.0, 1.0], [7, None, "h", 3, None, 1e9, 1.0, 1.0], [8, 2, None, 0, None, -5.0, 3.0, None], [9, 3, "unknown", None, None, -5.0, 3.0, None]]
    s = spark.createDataFrame([tuple(r) for r in data], "sample_id long, run_id long, host string, t_cs long, ingest_ts timestamp, rss_tree_mb double, cpu_tree_pct double, net_recv_mb double").withColumns({"block": F.lit("x"), "rn": F.lit(None).cast("int"), "_min": F.lit(1)})
    h = spark.createDataFrame([("h", 4, 32000.0), (None, 1, 1.0)], "host string, n_cores int, mem_total_mb double")
    got = rows(spikes.find(s, h).select("sample_id", "metric").distinct())
    assert got == sorted(want | {(8, "rss_tree_mb")})
    assert rows(spikes.find(s.limit(0), h)) == []


def test_departures_are_judged_by_the_series_own_scatter():
    rnd = np.random.default_rng(5)
    x = 1000 * (1 + 0.005 * rnd.standard_normal(300))
    x[150:152] *= 1.28
    assert list(np.flatnonzero(spikes.departures(x, False))) == [150, 151]
    wild = 1000 * (1 + 0.1 * rnd.standard_normal(300))
    wild[150:152] *= 1.28
    assert not spikes.departures(wild, False).any()
    c = 5.5e6 + np.cumsum(np.round(rnd.uniform(0.5, 1.5, 300), 1))
    c[100] += 90
    assert list(np.flatnonzero(spikes.departures(c, True))) == [100]


def test_a_long_season_is_found_from_all_blocks(spark):
    n = 8 * 1024
    rnd = np.random.default_rng(6)
    t = np.arange(n)
    busy = [x + k for x in (0, 9, 31, 47, 60, 88, 99, 130, 142, 181, 190, 222, 240, 263, 290, 301, 317, 350, 366, 389) for k in (0, 1)]
    rss = 1000 * (1 + 0.01 * rnd.standard_normal(n)) * np.where(np.isin(t % 400, busy), 1.6, 1.0)
    rss[5000] = 3000
    data = [(int(i), 1, "h", int(50 * i), None, float(rss[i]), 50.0 + float(rnd.standard_normal()), float(i)) for i in t]
    s = spark.createDataFrame(data, "sample_id long, run_id long, host string, t_cs long, ingest_ts timestamp, rss_tree_mb double, cpu_tree_pct double, net_recv_mb double")
    h = spark.createDataFrame([("h", 4, 32000.0)], "host string, n_cores int, mem_total_mb double")
    assert rows(spikes.find(s, h)) == [(5000, "rss_tree_mb", "departure")]


def test_constant_stretches_go_through_blocks_and_nulls(spark):
    n = 4 * 1024 + 100
    rss = [1000.0 + (i * 7919 % 13) for i in range(n)]
    for i in range(1020, 3080):  # eight readings in three blocks, nulls between them
        rss[i] = 7.5 if i in (1020, 1022, 1500, 2047, 2048, 2900, 3075, 3079) else None
    rss[4090:4096] = [8.5] * 6  # six and one: no stretch
    rss[4097] = 8.5
    data = [(i, 1, "h", 50 * i, None, rss[i], 50.0 + i % 3, float(i)) for i in range(n)]
    s = spark.createDataFrame(data, "sample_id long, run_id long, host string, t_cs long, ingest_ts timestamp, rss_tree_mb double, cpu_tree_pct double, net_recv_mb double")
    h = spark.createDataFrame([("h", 4, 32000.0)], "host string, n_cores int, mem_total_mb double")
    assert {r[0] for r in rows(spikes.find(s, h)) if r[2] == "still"} == {1020, 1022, 1500, 2047, 2048, 2900, 3075, 3079}


def test_block_summaries_give_the_same_on_the_driver_and_as_tables(spark):
    rnd = random.Random(4)
    data = []
    for run in (1, 2):
        for b in range(40):
            v = [float(rnd.choice([1, 1, 1, 2])) for _ in range(rnd.choice([0, 1, 3]))]
            ch = [i for i in range(1, len(v)) if v[i] != v[i - 1]]
            data.append((run, b, 0, len(v), v[0] if v else None, v[-1] if v else None, ch[0] if ch else None, ch[-1] if ch else None))
    s = spark.createDataFrame(data, "run_id long, block long, metric int, n long, first double, last double, change_first long, change_last long")
    assert sorted(map(str, spikes._outside(s).collect())) == sorted(map(str, spikes._outside(s, few=3).collect()))


# ---- nearest in time


def test_nearest_against_brute_force(spark):
    rnd = random.Random(5)
    smp = [(i, rnd.choice([1, 1, 2]), rnd.randint(-50, 30_000)) for i in range(900)]
    ev = [(i, rnd.choice([1, 2, 3]), rnd.randint(0, 30_000) / 100, rnd.choice([None, rnd.randint(0, 30_000) / 100])) for i in range(80)]
    events = spark.createDataFrame([*ev, ev[0], (None, 1, 1.0, 1.0), (99, None, 1.0, 1.0)], "event_id long, run_id long, start_s double, end_s double")
    samples = spark.createDataFrame([*smp, smp[3], (None, 1, 5), (5000, None, 5), (5001, 1, None)], "sample_id long, run_id long, t_cs long").withColumn("bucket", F.lit("x"))
    want = set()
    for i, r, a, b in ev:
        for edge, t in (("start", a), ("end", b)):
            near = [(abs(s[2] - round(t * 100)), s[2], s[0]) for s in smp if s[1] == r and abs(s[2] - round(t * 100)) <= 100] if t is not None else []
            if near:
                want.add((i, edge, min(near)[2]))
    assert rows(nearest.nearest_samples(spark, nearest.bounds(events), samples, 100)) == sorted(want)


def test_nearest_of_empty_tables(spark):
    e = spark.createDataFrame([], "event_id long, run_id long, start_s double, end_s double")
    s = spark.createDataFrame([], "sample_id long, run_id long, t_cs long")
    assert rows(nearest.nearest_samples(spark, nearest.bounds(e), s, 100)) == []


# ---- nested reports


CASE = {"name": "a", "kwargs": {"static_source": " Stac\n", "windows": [{"label": "w0", "score": {"coverage_pct": 3.5}}, {"label": "w1", "score": None}]}, "details": {"sensor_mode": "X"}, "error": None}
PAYLOADS = {
    "array": json.dumps([CASE, {"kwargs": [{"key": "static_source", "val": "gee"}], "error": {"message": "m", "type": "t"}}]),
    "lines": "\n".join(json.dumps(x) for x in (CASE, {"details.sensor_mode": "Y", "error": ""})),
    "groups": json.dumps({"groups": [{"cases": [{"error": "e0"}]}, {"cases": []}, {"note": None}, {"results": [{"error": "e1"}, {"config": {"kwargs": {"static_source": "s"}}}]}]}, indent=1),
    "encoded": json.dumps(json.dumps({"report": {"results": [{"outcome": {"details": {"sensor_mode": "Z"}}, "attempts": [{"error": "x \\ \"q\" é"}, None, {"kwargs": json.dumps({"static_source": "enc"})}]}]}})),
    "single": "﻿" + json.dumps({"name": "n", "error": "only", "attempts": []}),
    "items": json.dumps([{"details": [{"sensor_mode": "L"}], "kwargs": []}]),
    "cut": json.dumps([CASE])[:-5], "tail": json.dumps([CASE]) + " x", "empty": "", "blank": " \n", "null": "null", "word": "n/a", "none": None, "list": "[]", "half": json.dumps(CASE) + "\n{",
}
FOUND = {
    ("array", 0, 0, "kwargs.static_source", " Stac\n"), ("array", 0, 0, "details.sensor_mode", "X"), ("array", 1, 0, "kwargs.static_source", "gee"), ("array", 1, 0, "error", "m"),
    ("lines", 0, 0, "kwargs.static_source", " Stac\n"), ("lines", 0, 0, "details.sensor_mode", "X"), ("lines", 1, 0, "details.sensor_mode", "Y"),
    ("groups", 0, 0, "error", "e0"), ("groups", 1, 0, "error", "e1"), ("groups", 2, 0, "kwargs.static_source", "s"),
    ("encoded", 0, 0, "details.sensor_mode", "Z"), ("encoded", 0, 1, "error", "x \\ \"q\" é"), ("encoded", 0, 3, "kwargs.static_source", "enc"),
    ("single", 0, 0, "error", "only"), ("items", 0, 0, "details.sensor_mode", "L"),
}


def test_leaves_of_every_shape(spark):
    df = spark.createDataFrame(list(PAYLOADS.items()), "id string, payload string").withColumn("case_no", F.lit("clash")).withColumn("_cases", F.lit(1))
    got = rows(nested.leaves(df.select("id", "payload"), "payload", ["id"]))
    assert got == sorted(FOUND)
    assert rows(nested.leaves(df, "payload", ["id"])) == got


def test_tables_of_reports(spark):
    df = spark.createDataFrame([("array", PAYLOADS["array"])], "id string, payload string")
    w = nested.windows_table(df, "payload", ["id"]).collect()
    assert [(r.case_no, r.window_no, r.label, r.coverage_pct) for r in w] == [(0, 0, "w0", 3.5), (0, 1, "w1", None)]
    a = nested.attempts_table(df, "payload", ["id"]).collect()
    assert [(r.case_no, r.attempt_no, r.name, r.static_source, r.error) for r in a] == [(0, 0, "a", " Stac\n", None), (1, 0, None, "gee", "m")]
    assert nested.leaves(df.limit(0), "payload", ["id"]).count() == 0
