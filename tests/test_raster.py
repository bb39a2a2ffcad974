"""Raster kernels on hand-made arrays: smoothing, ensembles, components, sieve, polygons, outlines, windows."""

import json
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.functions import scalars as S
from terrasift.operators import components as C
from terrasift.operators import quality as Q
from terrasift.operators import raster as R
from terrasift.operators import selection as W
from terrasift.operators import smoothing as N
from terrasift.operators import trees as T
from terrasift.operators import vector as V
from terrasift.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def exact_smooth(y, lam=Fraction(1, 2)):
    """The smoothing system solved in fractions by elimination."""
    n = len(y)
    d = [[(1 if j == i else -2 if j == i + 1 else 1 if j == i + 2 else 0) for j in range(n)] for i in range(n - 2)]
    a = [[lam * sum(r[i] * r[j] for r in d) + (1 if i == j and y[i] is not None else 0) for j in range(n)] for i in range(n)]
    b = [Fraction(0) if v is None else Fraction(v) for v in y]
    for i in range(n):
        k = next(r for r in range(i, n) if a[r][i] != 0)
        a[i], a[k], b[i], b[k] = a[k], a[i], b[k], b[i]
        for r in range(n):
            if r != i and a[r][i] != 0:
                f = a[r][i] / a[i][i]
                a[r] = [x - f * z for x, z in zip(a[r], a[i], strict=True)]
                b[r] -= f * b[i]
    return [float(b[i] / a[i][i]) for i in range(n)]


@pytest.mark.parametrize("y", [[0, 0, 1, 0, 0], [0, None, 1, 0, 0], [None, 1, 0, None, 1, 0, None]])
def test_smoothing_against_exact_solution(y):
    got = N.solve_block(np.array([[np.nan if v is None else v for v in y]], float))[0]
    assert np.allclose(got, np.clip(exact_smooth(y), -1, 1), atol=1e-9)


def test_smoothing_invariants(spark):
    assert np.allclose(N.smoother(12).sum(1), 1)
    line = np.linspace(-0.9, 0.9, 12)
    assert np.allclose(N.solve_block(np.stack([line, np.full(12, 0.3)])), np.stack([line, np.full(12, 0.3)]))
    one = np.full((1, 6), np.nan)
    assert np.isnan(N.solve_block(one)).all()
    one[0, 2] = 0.5
    assert np.isfinite(N.solve_block(one)).all()
    df = spark.createDataFrame([([0.1, None, 0.3, 0.4],), ([None, None, None],), (None,), ([],), ([9.0, 9.0, 9.0, 9.0],)], "s array<float>")
    got = [r.smooth for r in N.smooth(df, "s").collect()]
    assert got[1] == [None] * 3 and got[2] is None and got[3] == [] and got[4] == [1.0] * 4
    assert np.allclose(got[0], [0.1, 0.2, 0.3, 0.4], atol=1e-6)
    full = spark.createDataFrame([([0.0, 0.0, 1.0, 0.0, 0.0],)], "s array<double>").select(N.smooth_complete(F.col("s"), 5).alias("z")).first().z
    assert np.allclose(full, exact_smooth([0, 0, 1, 0, 0]))


def test_ensembles_as_expression_and_as_blocks(spark):
    rnd = random.Random(4)
    for rule, leaf in (("vote", [1.0, 4.0]), ("sum", [0.5, -0.4])):
        nodes = []
        for t in range(5):
            nodes += [T.Node(t, 0, rnd.randrange(3), rnd.random(), 1, 2, 0), T.Node(t, 1, rnd.randrange(3), rnd.random(), 3, 4, 0), *(T.Node(t, k, -1, 0, 0, 0, rnd.choice(leaf)) for k in (2, 3, 4))]
        x = [[rnd.random() for _ in range(3)] for _ in range(200)] + [[n.threshold if n.feature == i else 0.5 for i in range(3)] for n in nodes if n.feature >= 0]
        df = spark.createDataFrame([(v,) for v in x], "f array<double>")
        a = [r.c for r in df.select(T.expression(nodes, F.col("f"), rule).alias("c")).collect()]
        b = [r.cls for r in T.predict(df, nodes, "f", rule).collect()]
        assert a == b and len(set(a)) == 2
    assert T.predict(spark.createDataFrame([(None,)], "f array<double>"), nodes, "f", "sum").first().cls is None


def test_forest_averages_class_probabilities(spark):
    rnd = random.Random(8)
    nodes = []
    for t in range(7):
        nodes += [T.Node(t, 0, rnd.randrange(3), rnd.random(), 1, 2, 0.0), T.Node(t, 1, rnd.randrange(3), rnd.random(), 3, 4, 0.0)]
        nodes += [T.Node(t, k, -1, 0.0, 0, 0, (p := rnd.random(), 1 - p)) for k in (2, 3, 4)]
    by = {(n.tree, n.node): n for n in nodes}

    def one(x):
        total = [0.0, 0.0]
        for t in range(7):
            n = by[t, 0]
            while n.feature >= 0:
                n = by[t, n.left if x[n.feature] <= n.threshold else n.right]
            total = [a + b for a, b in zip(total, n.leaf, strict=True)]
        return 1 if total[0] >= total[1] else 4

    x = [[rnd.random() for _ in range(3)] for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in x], "f array<double>")
    want = [one(v) for v in x]
    assert [r.cls for r in T.predict(df, nodes, "f", "mean", classes=(1, 4)).collect()] == want
    assert [r.c for r in df.select(T.expression(nodes, F.col("f"), "mean", (1, 4)).alias("c")).collect()] == want
    # one sure tree outweighs two that hardly lean the other way; votes would not see it
    lean = [T.Node(t, 0, -1, 0.0, 0, 0, p) for t, p in enumerate([(0.95, 0.05), (0.45, 0.55), (0.45, 0.55)])]
    assert T.ensemble(lean, "mean", (1, 4)).predict(np.zeros((1, 1)))[0] == 1
    trees = [{"left": [1, -1, -1], "right": [2, -1, -1], "feature": [0, -2, -2], "threshold": [0.5, -2, -2], "value": [[5, 5], [4, 1], [1, 4]]}]
    forest = T.forest_model(json.dumps({"classes": [7, 9], "trees": trees}))
    assert forest.predict(np.array([[0.5], [0.6]])).tolist() == [7, 9]


def test_large_forest_against_descent():
    from terrasift.plans.raster_queries import grown

    m = grown(32, 20, 6, 0.1, 0.25)
    x = np.random.default_rng(3).uniform(0.05, 0.3, (50, 32))
    for row, got in zip(x, m.predict(x), strict=True):
        total = np.zeros(2)
        for n in m.roots:
            while m.feature[n] >= 0:
                n = m.left[n] if row[m.feature[n]] <= m.threshold[n] else m.right[n]
            total += m.value[n]
        assert got == m.classes[np.argmax(total)]


def test_boosted_model_file(tmp_path, spark):
    tree = {"left_children": [1, -1, -1], "right_children": [2, -1, -1], "split_indices": [1, 0, 0], "split_conditions": [0.1, -0.4, 0.6], "default_left": [1, 0, 0]}
    other = {"left_children": [-1], "right_children": [-1], "split_indices": [0], "split_conditions": [0.3], "default_left": [0]}

    def model(score):
        return json.dumps({"learner": {"learner_model_param": {"base_score": score, "num_class": "0"}, "objective": {"name": "binary:logistic"}, "gradient_booster": {"model": {"trees": [tree, other], "tree_info": [0, 0]}}}})

    (tmp_path / "x.json").write_text(model("5E-1"))
    m = files.tree_model(str(tmp_path / "x.json"), "boosted", [4, 14])
    at = np.float64(np.float32(0.1))  # equal in single precision: not left
    assert m.predict(np.array([[0, 0.05], [0, at], [0, 0.2], [0, np.nan]])).tolist() == [4, 14, 14, 4]
    assert T.boosted_model(model("[0.9]")).predict(np.array([[0, 0.05]])).tolist() == [1]  # -0.1 + logit 0.9
    many = json.loads(model("0"))
    many["learner"]["learner_model_param"]["num_class"] = "2"
    many["learner"]["objective"]["name"] = "multi:softmax"
    many["learner"]["gradient_booster"]["model"]["tree_info"] = [0, 1]
    assert T.boosted_model(json.dumps(many)).predict(np.array([[0, 0.05], [0, 0.2]])).tolist() == [1, 0]
    df = spark.createDataFrame([([0.0, 0.2],), ([0.0, None],), (None,)], "f array<double>")
    assert [r.cls for r in T.predict(df, m, "f", missing=float("nan")).collect()] == [14, 4, None]


def brute_components(cells, conn):
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if conn == 8 else [])
    out = {}
    for p in sorted(cells):
        if p in out:
            continue
        todo = [p]
        out[p] = p
        while todo:
            r, c = todo.pop()
            for dr, dc in steps:
                q = (r + dr, c + dc)
                if q in cells and q not in out and cells[q] == cells[p]:
                    out[q] = p
                    todo.append(q)
    return out


@pytest.mark.parametrize(("conn", "chip", "few"), [(4, 4, 10_000), (8, 5, 10_000), (4, 3, 0), (8, 64, 10_000)])
def test_components_against_flood_fill(spark, conn, chip, few):
    rnd = random.Random(conn * chip)
    cells = {(r, c): rnd.choice([1, 1, 4, None]) for r in range(17) for c in range(19)}
    for r in range(17):
        cells[r, 7] = 9  # one long component over many chips
    df = spark.createDataFrame([(r, c, v) for (r, c), v in cells.items()] + [(0, 7, 9), (None, 3, 1)], "row int, col int, cls int").withColumn("lab", F.lit("clash"))
    want = brute_components({k: v for k, v in cells.items() if v is not None}, conn)
    got = {(r.row, r.col): (r.comp >> 31, r.comp % 2**31) for r in C.components(df, "cls", conn, chip, few).collect()}
    assert got == want


def test_components_of_an_empty_table(spark):
    assert C.components(spark.createDataFrame([], "row int, col int, cls int"), "cls").count() == 0


def grid(spark, text):
    return spark.createDataFrame([(r, c, None if ch == "." else int(ch)) for r, line in enumerate(text.split()) for c, ch in enumerate(line)], "row int, col int, cls int")


def picture(df, col):
    m = {(r.row, r.col): r[col] for r in df.collect()}
    return " ".join("".join("." if m[r, c] is None else str(m[r, c]) for c in range(max(k[1] for k in m) + 1)) for r in range(max(k[0] for k in m) + 1))


@pytest.mark.parametrize("few", [C.FEW_LINKS, 0])
def test_sieve_and_revert(spark, monkeypatch, few):
    monkeypatch.setattr(C._chase, "__defaults__", (few,))
    monkeypatch.setattr(C, "FEW_CHIPS", few and C.FEW_CHIPS)
    hole = C.sieve(grid(spark, "11111 11411 11111"), "cls", 3, 4, 2)
    assert picture(hole, "sieved") == "11111 11111 11111"
    assert picture(C.revert(hole, "cls", "sieved", [1], 4, 2), "sieved") == "11111 11111 11111"
    beside = C.sieve(grid(spark, "11111 114.1 11111"), "cls", 3, 4, 2)  # the hole touches a cell without data
    assert picture(beside, "sieved") == "11111 111.1 11111"
    assert picture(C.revert(beside, "cls", "sieved", [1], 4, 2), "sieved") == "11111 114.1 11111"
    chain = C.sieve(grid(spark, "1111244444 1111244444"), "cls", 3, 4, 4)  # 2 goes to the larger neighbour
    assert picture(chain, "sieved") == "1111444444 1111444444"
    step = C.sieve(grid(spark, "235555"), "cls", 3, 4, 4)  # 2 hands on through 3 to 5
    assert picture(step, "sieved") == "555555"
    alone = C.sieve(grid(spark, "23"), "cls", 3, 4, 4)  # nothing large anywhere
    assert picture(alone, "sieved") == "23"
    diagonal = grid(spark, "1444 4144 4444")
    assert picture(C.sieve(diagonal, "cls", 2, 4), "sieved") == "4444 4444 4444"
    assert picture(C.sieve(diagonal, "cls", 2, 8), "sieved") == "1444 4144 4444"
    lost = C.sieve(grid(spark, "44144"), "cls", 2, 4)  # target to other is never undone
    assert picture(C.revert(lost, "cls", "sieved", [1], 4), "sieved") == "44444"


def brute_sieve(cells, least, conn):
    comp = brute_components({k: v for k, v in cells.items() if v is not None}, conn)
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if conn == 8 else [])
    size, near = {}, {}
    for p, c in comp.items():
        size[c] = size.get(c, 0) + 1
        for d in steps:
            q = comp.get((p[0] + d[0], p[1] + d[1]))
            if q is not None and q != c:
                near.setdefault(c, set()).add(q)
    out = {}
    for p, c in comp.items():
        seen, k = set(), c
        while size[k] < least and k not in seen and near.get(k):
            seen.add(k)
            top = max(size[q] for q in near[k])
            k = min(q for q in near[k] if size[q] == top)
        out[p] = cells[k] if size[k] >= least else cells[p]
    return out


@pytest.mark.parametrize(("conn", "chip", "few"), [(4, 5, 1000), (8, 4, 1000), (4, 4, 0), (8, 6, 0), (4, 64, 1000)])
def test_sieve_against_brute_force(spark, monkeypatch, conn, chip, few):
    rnd = random.Random(chip)
    cells = {(r, c): rnd.choice([1, 1, 2, 3, None] if r > 9 else [1, 1, 1, 1, 1, 2, 3]) for r in range(21) for c in range(23)}
    monkeypatch.setattr(C._chase, "__defaults__", (few,))
    monkeypatch.setattr(C, "FEW_CHIPS", few)
    df = spark.createDataFrame([(r, c, v) for (r, c), v in cells.items()], "row int, col int, cls int")
    got = {(r.row, r.col): r.sieved for r in C.sieve(df, "cls", 5, conn, chip).collect()}
    want = brute_sieve(cells, 5, conn)
    assert got == {p: want.get(p) for p in cells}


def test_dilation(spark):
    assert rows(C.dilated(spark.createDataFrame([(1, 1)], "row long, col long"), 4)) == sorted([(0, 1), (1, 0), (1, 1), (1, 2), (2, 1)], key=str)
    assert C.dilated(spark.createDataFrame([(1, 1)], "row long, col long"), 8).count() == 9


@pytest.mark.parametrize("few", [C.FEW_LINKS, 0])
def test_polygons_cover_their_pixels(spark, few):
    comp = C.components(grid(spark, "1111144 1444144 1414144 1444144 1111111 44.4444"), "cls", 4, 3)
    polys = C.polygonise(comp, "cls", 0.0, 0.0, 1.0, 3, few).collect()
    assert len({p.comp for p in polys}) == len(polys)
    stats = {r.comp: r for r in C.polygon_stats(comp, "cls", 73.0, 31.0, 1e-4, 43).collect()}
    area = {}
    for p in polys:
        a = [float((q[:-1, 0] * q[1:, 1] - q[1:, 0] * q[:-1, 1]).sum()) / 2 for q in C.wkb_rings(p.wkb)]
        assert all((q[0] == q[-1]).all() for q in C.wkb_rings(p.wkb))
        area[p.comp] = area.get(p.comp, 0) + abs(sum(a))
    assert {k: v for k, v in area.items()} == {k: float(r.n_px) for k, r in stats.items()}
    # all pixels of one size: acres are proportional to pixels
    per = [r.acres / r.n_px for r in stats.values()]
    assert max(per) / min(per) - 1 < 1e-3 and abs(per[0] - 1e-8 * 111_200 * 95_500 * S.ACRES_PER_M2) < 2e-4


def test_corner_contact_makes_two_rings(spark):
    comp = C.components(grid(spark, "111 141 114"), "cls", 8, 8)
    (ring,) = [list(C.wkb_rings(p.wkb)) for p in C.polygonise(comp.where("cls = 4"), "cls", 0.0, 0.0, 1.0).collect()]
    assert sorted(len(r) for r in ring) == [5, 5]


def test_inside_follows_pixel_centres_and_holes(spark):
    rings = spark.createDataFrame([(1, 0, k, float(x), float(y)) for k, (x, y) in enumerate([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])] + [(1, 1, k, x, y) for k, (x, y) in enumerate([(1.4, 1.4), (2.6, 1.4), (2.6, 2.6), (1.4, 2.6), (1.4, 1.4)])], "poly int, ring int, seq int, x double, y double")
    px = spark.range(36).select(F.floor(F.col("id") / 6).alias("row"), (F.col("id") % 6).alias("col"))
    got = {(r.row, r.col) for r in V.inside(px, rings).collect()}
    assert got == {(r, c) for r in range(4) for c in range(4)} - {(1, 1), (1, 2), (2, 1), (2, 2)} | {p for p in [(1, 1), (1, 2), (2, 1), (2, 2)] if not (1.4 < p[1] + 0.5 < 2.6 and 1.4 < p[0] + 0.5 < 2.6)}
    assert V.ring_area(rings).first().area == pytest.approx(16 + 1.44) or V.ring_area(rings).first().area == pytest.approx(16 - 1.44)
    cells = V.clipped_cells(rings.where("ring = 0"), 3.0)
    assert sorted(r.area for r in cells.collect()) == [1.0, 3.0, 3.0, 9.0]


def test_repair_closes_and_thins_rings(spark):
    pts = [(0, 0), (0, 0), (2, 0), (2, 2)]
    df = spark.createDataFrame([(1, 0, k, float(x), float(y)) for k, (x, y) in enumerate(pts)] + [(2, 0, k, float(k), 0.0) for k in range(3)], "poly int, ring int, seq int, x double, y double")
    assert [(r.x, r.y) for r in V.repaired(df).orderBy("seq").collect()] == [(0, 0), (2, 0), (2, 2), (0, 0)]


@pytest.mark.parametrize(("lon", "lat", "epsg"), [(73.41, 31.62, 32643), (69.0, 31.0, 32642), (30.0, -20.0, 32736)])
def test_utm_zones(spark, lon, lat, epsg):
    assert spark.range(1).select(S.utm_epsg(F.lit(lon), F.lit(lat)).alias("e")).first().e == epsg


def test_projection(spark):
    x, y = S.utm_xy_float(69.0, 0.0, 42)
    assert abs(x - 500000) < 1e-6 and abs(y) < 1e-6
    _, y = S.utm_xy_float(69.0, 45.0, 42)
    assert abs(y - 0.9996 * 4984944.378) < 0.01  # meridian arc of WGS 84
    x, y = S.utm_xy_float(71.5, 31.0, 42)
    r = spark.range(1).select(*S.utm_xy(F.lit(71.5), F.lit(31.0), 42)).first()
    assert abs(r[0] - x) < 1e-6 and abs(r[1] - y) < 1e-6


def test_window_choice_rules(spark):
    data = [
        ("margin", 1, "scored", 88.0), ("margin", 2, "scored", 92.0), ("tie", 1, "scored", 50.0), ("tie", 2, "scored", 50.0), ("floor", 1, "scored", 79.0), ("floor", 2, "scored", 80.0),
        ("none", 1, "empty", None), ("null", 1, "scored", None), ("null", 2, "scored", 0.0), ("first", 1, "unscored", None), ("first", 2, "scored", 99.0), ("bad", 1, "unscored", None),
    ]
    s = spark.createDataFrame([(*r, None) for r in data], "district string, rank int, status string, coverage double, start date")
    got = {r.district: (r.rank, r.label) for r in W.choose(s, "district").collect()}
    assert got == {"margin": (1, "ok"), "tie": (1, "below floor"), "floor": (2, "ok"), "null": (2, "below floor"), "first": (2, "ok")}
    verdict = {r.district: r.verdict for r in W.blocking(s, W.choose(s, "district"), "district").collect()}
    assert (verdict["first"], verdict["bad"], verdict["none"], verdict["margin"]) == ("warn", "error", "none", "ok")


def test_windows_are_half_open_and_cut_off(spark):
    got = [(str(r.w_start), str(r.w_end)) for r in R.date_windows(spark, "2025-01-01", "2025-01-20", 8).collect()]
    assert got == [("2025-01-01", "2025-01-09"), ("2025-01-09", "2025-01-17"), ("2025-01-17", "2025-01-20")]
    leap = spark.createDataFrame([("02-01", "02-29")], "from_md string, to_md string")
    assert [str(W.resolved_windows(leap, F.lit(y)).first().w_end) for y in (2024, 2025)] == ["2024-02-29", "2025-02-28"]


def test_greedy_dates(spark):
    df = spark.createDataFrame([("t", d, c) for d, cs in (("a", "12"), ("b", "123"), ("c", "45")) for c in cs], "tile string, day string, cell string")
    assert rows(W.greedy_dates(df, "tile", "day", "cell")) == [("t", 1, "b", 3), ("t", 2, "c", 2)]


def test_retention_and_completeness(spark):
    px = spark.createDataFrame([("a", 1, 1), ("a", 1, None), ("b", 4, 4), ("a", None, 1)], "g string, x int, y int")
    assert rows(Q.retention(px, "g", "x", "y", [1])) == [("a", 2, 2, 100.0), ("b", 0, 0, None)]
    t = spark.createDataFrame([(1, "ok", 121.2), (1, "ok", 136.2), (1, "Failed: x", 181.1), (2, None, None), (2, "ok", None)], "run int, s string, sec double")
    assert rows(Q.tile_completeness(t, "run", "s")) == [(1, 3, 1, False), (2, 2, 1, False)]
    assert {r.run: round(r.minutes, 3) for r in Q.tile_minutes(t, "run", "sec", 720.0, 8).collect()} == {1: round(438.5 / 180, 3), 2: 12.0}
    with pytest.raises(Exception, match="no pixel has data"):
        Q.refuse_empty(px.where("x > 9"), "x").collect()


def test_scalars(spark):
    def value(c):
        return spark.range(1).select(c.alias("x")).first().x

    assert value(S.ndvi(F.lit(0.0), F.lit(0.0))) is None and value(S.ndvi(F.lit(1.0), F.lit(3.0))) == 0.5
    assert value(S.band_date(F.lit("red_2025_02_30"))) is None and str(value(S.band_date(F.lit("B8_2025_02_03")))) == "2025-02-03"
    assert [value(S.clear_qa(F.lit(q))) for q in (0, 8, 16, 7)] == [True, False, False, True]
    assert value(S.path_spellings(F.lit("C:\\a\\b"))) == ["C:\\a\\b", "/mnt/c/a/b", "/c/a/b"] and value(S.path_spellings(F.lit("rel/x"))) == ["rel/x"]
    assert value(S.path_spellings(F.lit("/mnt/c/a/b"))) == ["/mnt/c/a/b", "C:\\a\\b"] and value(S.path_spellings(F.lit("/c/a"))) == ["/c/a", "C:\\a"]
    assert value(S.clean_path(F.lit("  r'C:\\x' "))) == "C:\\x"
    assert value(S.gap_mask(F.array(F.lit(1.0), F.lit(None).cast("double"), F.lit(2.0)))) == 5
    assert value(S.landsat_scaled(F.lit(0))) == 0
    assert value(S.unescaped_path(F.lit("C:\tiles\new\x07oi"))) == "C:\\tiles\\new\\aoi" and value(S.unescaped_path(F.lit("/a/b"))) == "/a/b"


def test_pixel_estimate_is_near_the_count(spark):
    from terrasift.plans.raster_queries import aoi_rings

    area = {r.poly: r.area for r in V.ring_area(aoi_rings(spark)).collect()}
    for r in V.pixel_estimate(aoi_rings(spark), 73.0, 31.0, 1e-4, 43).collect():
        # the projected box is up to 4 % larger than the area's own, since the grid is turned against the zone
        assert 0.95 < r.n_px / area[r.poly] <= 1


def test_a_bow_tie_is_two_triangles(spark):
    from terrasift.operators.vector import simple_rings

    got = simple_rings([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)])
    area = [abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:], strict=False))) / 2 for r in got]
    assert sorted(area) == [1.0, 1.0] and all(r[0] == r[-1] for r in got)
    assert simple_rings([(0, 0), (1, 1), (0, 0)]) == [] and len(simple_rings([(0, 0), (1, 0), (1, 1), (0, 1)])) == 1
    rings = spark.createDataFrame([(1, 0, k, float(x), float(y)) for k, (x, y) in enumerate([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)])], "poly int, ring int, seq int, x double, y double")
    assert V.repaired(rings).select("ring").distinct().count() == 2


def test_clip_to_boxes_keeps_the_area(spark):
    from terrasift.plans.raster_queries import aoi_rings

    boxes = spark.createDataFrame([(i * 10 + j, 20.0 * i, 20.0 * j, 20.0 * i + 20, 20.0 * j + 20) for i in range(5) for j in range(5)], "box long, x0 double, y0 double, x1 double, y1 double")
    got = V.clipped_rings(aoi_rings(spark), boxes)
    parts = got.groupBy("poly", "box", "ring").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("p")).collect()
    area = {}
    for r in parts:
        q = [(p.x, p.y) for p in r.p]
        assert q[0] == q[-1] and all(20 * (r.box // 10) - 1e-9 <= x <= 20 * (r.box // 10) + 20 + 1e-9 for x, _ in q)
        area[r.poly] = area.get(r.poly, 0) + sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(q, q[1:], strict=False)) / 2
    want = {r.poly: r.area for r in V.ring_area(aoi_rings(spark)).collect()}
    assert {k: round(abs(v), 6) for k, v in area.items()} == {k: round(v, 6) for k, v in want.items()}
    assert V.clipped_rings(aoi_rings(spark), boxes.limit(0)).count() == 0


def test_chip_files_and_areas_round_trip(spark, tmp_path):
    px = spark.createDataFrame([(r, c, r % 3) for r in range(20) for c in range(9)], "row int, col int, cls int")
    files.write_chips(C.to_chips(px, ["cls"], 4), str(tmp_path / "chips"), band=2)
    back = files.read_chips(spark, str(tmp_path / "chips"), band=2)
    assert rows(C.from_chips(back, ["cls"], 4)) == rows(px)
    some = files.read_chips(spark, str(tmp_path / "chips"), (1, 2), 2)
    assert {r.row // 4 for r in C.from_chips(some, ["cls"], 4).collect()} == {1, 2}
    rings = spark.createDataFrame([(1, 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (3.0, 0.0), (3.0, 6.0), (0.0, 0.0)])], "poly int, ring int, seq int, x double, y double")
    assert {(r.chip_r, r.chip_c) for r in V.chips_near(back, rings, 4).collect()} == {(0, 0), (1, 0)}
    comp = C.component_chips(back, "cls", 4, 4)
    layer = C.polygonise_chips(comp, "cls", 0.0, 0.0, 1.0, 4).select(F.col("cls").alias("predicted"), F.lit(1.0).alias("area_acres"), F.col("wkb").alias("geometry"))
    files.write_layer(layer, str(tmp_path / "aoi.parquet"))
    area = V.ring_area(files.areas(spark, str(tmp_path / "aoi.parquet")))
    assert sum(r.area for r in area.collect()) == 180
    with pytest.raises(NotImplementedError):
        files.areas(spark, "x.kml")
    m = str(tmp_path / "manifest")
    (tmp_path / "s.txt").write_text("a")
    assert not files.same_sources(spark, m, str(tmp_path / "s.txt"))
    files.write_manifest(spark, m, str(tmp_path / "s.txt"))
    assert files.same_sources(spark, m, str(tmp_path / "s.txt"))
    (tmp_path / "s.txt").write_text("b")
    assert not files.same_sources(spark, m, str(tmp_path / "s.txt"))


def test_presets(spark):
    from terrasift.sources import presets

    jobs = spark.createDataFrame([("wheat", "2024"), (None, "2024")], "crop string, year string")
    assert [str(r.series_start) for r in presets.with_series(jobs, spark, "crop", "year").orderBy("crop").collect()] == ["None", "2023-08-24"]
    with pytest.raises(Exception, match="unknown crop tulips, known ones: cane"):
        presets.with_series(jobs.union(spark.createDataFrame([("tulips", "2024")], jobs.schema)), spark, "crop", "year").collect()
    assert presets.windows(spark, "sindh").where("crop = 'wheat'").count() == 3 and presets.windows(spark).where("crop = 'wheat'").count() == 4
    with pytest.raises(ValueError, match="punjab"):
        presets.windows(spark, "nowhere")
    days = [str(r.day) for r in presets.pinned_dates(spark, 2025).collect()]
    assert len(days) == 35 and days[0] == "2025-04-01" and days[-1] == "2025-12-29"


def test_stages_one_after_another(spark):
    from terrasift.plans import stages

    cells = "1111111111 1111411111 1111111111 44444.4444 4444444444"
    px = grid(spark, cells)
    chips = stages.cleaned(px, [1], 3, 4, 4)
    assert picture(C.from_chips(chips, ["sieved"], 4), "sieved") == cells.replace("11114111", "11111111")
    layer = stages.outlined(chips, [1], 3015, 73.0, 31.0, 1e-3, 42, 0.5, 4)
    (one,) = layer.collect()
    assert one.predicted == 3015 and abs(one.area_acres - 30 * 1e-6 * 111_000 * 95_500 * S.ACRES_PER_M2) < 5
    report = stages.assessed(layer, chips, px, [1], 4).first()
    assert (report.ndvi_px, report.static_px, report.n_polygons) == (30, 29, 1) and report.warning is None
    with pytest.raises(Exception, match="no pixel has data"):
        stages.cleaned(px.withColumn("cls", F.lit(None).cast("int")), [1], 3)


def test_long_gap_masks(spark):
    long = spark.createDataFrame([([1.0] + [None] * 69,)], "s array<double>")
    assert long.select(S.gap_pattern(F.col("s")).alias("m")).first().m == "1" + "0" * 69
    with pytest.raises(Exception, match="63 values"):
        long.select(S.gap_mask(F.col("s"))).collect()


def test_red_edge_comes_from_raw_bands(spark):
    dn = lambda v: F.lit((v / 10000 + 0.2) / 0.0000275)
    r = spark.range(1).select(S.harmonised(dn(100), dn(200), dn(-500), dn(1000.5)).alias("b")).first().b
    assert (r.red, r.nir, r.red_edge, r.ndvi) == (0, 1000, 250, 29980)


def test_files(spark, tmp_path):
    sq = [[[0, 0], [2, 0], [2, 2], [0, 0]]]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"geometry": {"type": "MultiPolygon", "coordinates": [sq, sq]}}, {"geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    (tmp_path / "b.geojson").write_text(json.dumps({"type": "Polygon", "coordinates": sq}))
    r = files.geojson_rings(spark, str(tmp_path / "*.geojson"))
    assert r.count() == 12 and r.select("poly").distinct().count() == 3
    out = str(tmp_path / "layer")
    files.write_layer(files.empty_layer(spark), out)
    assert files.wkb_table(spark, out).columns == ["predicted", "area_acres", "geometry"] and files.wkb_table(spark, out).count() == 0
    (tmp_path / "jobs.json").write_text(json.dumps([{"crop": "cane", "year": 2025, "district_name": "x", "step": 8}]))
    assert files.job_list(spark, str(tmp_path / "jobs.json")).first().step == 8
    paths = spark.createDataFrame([("/o/ndvi_run_3_new/",), ("/o/ndvi_run_12",), ("/o/static_run_1",)], "p string")
    assert rows(files.run_ids(paths, "p", "ndvi")) == [(12, None), (3, "_new")]
    names = spark.createDataFrame([("x1.tif",), ("x20000000000-0000000000.tif",), ("x3.txt",)], "name string")
    want = spark.createDataFrame([("x1",), ("x2",), ("x3",)], "id string")
    assert rows(files.missing_exports(want, names, "id", "name")) == [("x3",)]
    (tmp_path / "card.json").write_text('{"training_dates": ["2025-01-01"]}')
    assert files.model_card(spark, str(tmp_path / "card.json")).first().dates == ["2025-01-01"]
    assert len(files.fingerprints(spark, str(tmp_path / "card.json")).first().sha256) == 64
    (tmp_path / "m.json").write_text(json.dumps({"rule": "sum", "nodes": [[0, 0, -1, 0, 0, 0, 0.5]]}))
    assert files.tree_model(str(tmp_path / "m.json")) == ("sum", [T.Node(0, 0, -1, 0, 0, 0, 0.5)])
    files.write_report(spark.range(2), str(tmp_path / "r"))
    files.write_report(spark.range(1), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 3
    files.write_results(spark.range(2), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["id"]
