"""Text operators: brute force, round trips, held-out labels, dirt."""

import importlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

leak = pytest.importorskip("terrasift.llm.leak")
packing = importlib.import_module("terrasift.llm.packing")
subjects = importlib.import_module("terrasift.llm.subjects")
text = importlib.import_module("terrasift.llm.text")
queries = importlib.import_module("terrasift.llm.queries")

DATA = "/root/testdata"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- normal forms


@pytest.mark.parametrize(
    "written",
    ["The quick brown-fox_runs 12 times", "the  QUICK\n+ brown\n- fox runs\t12 times", "T​he quіck brоwn fox ru­ns 12 times", r"The quick\nbrown fox runs 12 times", "<p>The quick&nbsp;brown <b>fox</b> runs 12 times</p>", "ｔｈｅ quick brown fox runs 12 times", "the qu-\n+ick brown fox runs 12 times"],
)
def test_spellings_agree(written):
    assert text.words(written) == "the quick brown fox runs 12 times".split()


def test_hashed_words_are_the_words():
    rnd = random.Random(0)
    ts = ["".join(rnd.choice("ab_ -\nZé0<&\\") for _ in range(rnd.randrange(60))) for _ in range(300)] + ["", " ", "x"]
    h, of = text.hashed_words(ts)
    want = [(i, w) for i, t in enumerate(ts) for w in text.words(t)]
    assert of.tolist() == [i for i, _ in want]
    by = {}
    for x, (_, w) in zip(h.tolist(), want, strict=True):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    parts, _ = text.hashed_words(["fooBar_bazQUX9 Zed"], parts=True)
    again, _ = text.hashed_words(["foo bar baz qux zed"], parts=True)
    assert parts.tolist() == again.tolist()


# ---- leaks


PASSAGE = " ".join(f"word{i}" for i in range(40))
OTHER = " ".join(f"other{i % 17}x{i}" for i in range(30))


def edited(words, every, rnd):
    out = []
    for i, w in enumerate(words):
        if i % every == every - 1:
            k = rnd.randrange(3)
            if k == 0:
                continue
            out += [w + "z"] if k == 1 else [w, "new"]
        else:
            out.append(w)
    return out


def test_leaks_against_brute_force(spark):
    rnd = random.Random(1)
    w = PASSAGE.split()
    docs = {
        1: "intro " + PASSAGE + " end", 2: "x " + " ".join(w[5:25]) + " y", 3: " ".join(w[:9]), 4: " ".join(edited(w, 7, rnd)).upper(), 5: "\n".join("+    " + " ".join(w[i : i + 5]) for i in range(0, 40, 5)),
        6: " ".join(reversed(w)), 7: "", 8: None, 9: " ".join("noise" for _ in range(20_000)) + " " + OTHER, 10: " ".join(w[i] + " pad pad pad pad pad" for i in range(40)), 11: "a_b " + OTHER.replace(" ", "_"), 12: " ".join(w[:3] + OTHER.split()[:3] + w[3:6]),
    }
    d = spark.createDataFrame(list(docs.items()) + [(None, PASSAGE)], "doc_id long, text string").withColumn("passage_id", F.lit("clash"))
    it = spark.createDataFrame([(100, PASSAGE), (101, PASSAGE), (102, OTHER), (103, None), (104, ""), (105, "one two"), (None, OTHER)], "item_id long, passage string").withColumn("doc_id", F.lit(7))
    want = {(i, k) for i in (1, 2, 4, 5) for k in (100, 101)} | {(9, 102), (11, 102)}
    got = leak.spans(d, it)
    assert set(rows(got.select("doc_id", "item_id").distinct())) == want
    assert set(rows(leak.spans(d, it, index_words=20).select("doc_id", "item_id").distinct())) == want  # several passes
    assert leak.spans(d, it.limit(0)).count() == 0 and leak.spans(d.limit(0), it).count() == 0
    kept = {r.doc_id for r in leak.without_leaks(d, got).collect()}
    assert kept == {3, 6, 7, 8, 10, 12, None}
    clean = {r.doc_id: r.words for r in leak.without_spans(d.where("doc_id is not null"), got).collect()}
    assert clean[1] == "intro end" and clean[2] == "x y" and clean[3] == docs[3] and clean[8] is None and clean[7] == ""


@pytest.mark.parametrize(
    ("n", "change", "leaks"),
    [(10, [], True), (11, [], True), (12, [6], True), (24, [3, 7, 11, 15, 19, 23], True), (10, [4], True), (9, [], False), (30, [], True)],
)
def test_short_and_changed_passages(n, change, leaks):
    w = [f"p{i}" for i in range(n)]
    ix = leak.Index([(5, " ".join(w))])
    t = "say " + " ".join("zz" if i in change else x for i, x in enumerate(w)) + " more words after it"
    assert bool(leak.leaks_in(ix, [1], [t])) == leaks


def test_fragments_are_no_leaks():
    w = [f"p{i}" for i in range(40)]
    ix = leak.Index([(5, " ".join(w)), (6, " ".join(w[:14]))])
    found = lambda t: {(p, c) for _, p, _, _, c in leak.leaks_in(ix, [1], [t])}
    assert found(" ".join(w[20:34])) == set()  # 14 of 40 words
    assert found("a " + " ".join(w[20:40])) == {(5, 20)}
    assert found(" ".join(w[2:12])) == set()  # not the whole of the short one


def test_texts_of_one_word_cost_no_more_than_their_length():
    ix = leak.Index([(5, " ".join(["same"] * 200)), (6, " ".join(f"p{i}" for i in range(40)))])
    t0 = time.time()
    rows_ = leak.leaks_in(ix, [1], [" ".join(["same"] * 8000) + " " + " ".join(f"p{i}" for i in range(40))])
    assert {r[1] for r in rows_} == {5, 6} and len(rows_) == 2 and time.time() - t0 < 5
    ids, of = text.hashed_words(["a b c d e f g " * 30, "x a b c d e f g"])
    one = leak.Index([(1, "a b c d e f g a b c d e f g")])
    assert (one.stretches(ids, of, pairs=7) == one.stretches(ids, of)).all()


def test_scan_finds_every_ngram(spark):
    rnd = random.Random(2)
    voc = [f"v{i}" for i in range(12)]
    p = {k: [rnd.choice(voc) for _ in range(25)] for k in range(5)}
    t = [[rnd.choice(voc) for _ in range(rnd.randrange(0, 200))] for _ in range(6)]
    ix = leak.Index([(k, " ".join(v)) for k, v in p.items()])
    ids, of = text.hashed_words([" ".join(x) for x in t])
    a, o, q = ix.hits(ids, of)
    got = {(int(of[x]), int(x - np.searchsorted(of, of[x])), int(ix.pids[k]), int(y - 25 * k)) for x, k, y in zip(a, o, q, strict=True)}
    want = {(i, j, k, m) for i, x in enumerate(t) for j in range(len(x) - leak.N + 1) for k, v in p.items() for m in range(len(v) - leak.N + 1) if x[j : j + leak.N] == v[m : m + leak.N]}
    assert got == want


# ---- packing


def test_counts_agree_with_the_tokenizer(spark):
    c = packing.Counter(packing.TOKENIZER)
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("text").where("text is not null").toPandas().text
    odd = ["", " ", "\n\n  x", "it's  we'LL 'tis", "a b  c", "naïve Füße 12 ½ ", "\x1c\x1d x\x85y", "日本語 テキスト", "😀 :-)", "tab\tend \n"]
    for t in [*docs, *odd]:
        assert c.count(t) == len(c.encoding.encode_ordinary(t))
    assert c.count(None) == 0
    c.LIMIT = 3
    assert c.count("one two three four five six") == len(c.encoding.encode_ordinary("one two three four five six"))


@pytest.mark.parametrize("seed", range(6))
def test_patterns_pack_everything_and_tightly(seed):
    rnd = random.Random(seed)
    cap = rnd.choice([50, 200, 1000])
    sizes = {}
    for _ in range(rnd.choice([1, 30, 2000])):
        s = min(cap, max(1, int(rnd.expovariate(4 / cap))))
        sizes[s] = sizes.get(s, 0) + 1
    plan = packing.patterns(sizes, cap)
    used = {}
    for times, b in plan:
        assert times > 0 and sum(s * k for s, k in b.items()) <= cap
        for s, k in b.items():
            used[s] = used.get(s, 0) + times * k
    assert used == sizes
    bins, total = sum(t for t, _ in plan), sum(s * n for s, n in sizes.items())
    # best fit decreasing, one item at a time, is what it must not fall behind
    gaps = []
    for s in sorted((s for s, n in sizes.items() for _ in range(n)), reverse=True):
        fit = [i for i, g in enumerate(gaps) if g >= s]
        if fit:
            i = min(fit, key=lambda i: gaps[i])
            gaps[i] -= s
        else:
            gaps.append(cap - s)
    assert -(-total // cap) <= bins <= len(gaps) + 1


def test_two_replace_the_smallest():
    assert packing.patterns({6: 1, 3: 1, 2: 2}, 10) == [(1, {6: 1, 2: 2}), (1, {3: 1})]
    assert packing.patterns({}, 10) == [] and packing._best_pair([4], {4: 1}, {}, 9) is None and packing._best_pair([4], {4: 2}, {}, 9) == (4, 4)


def test_pack_round_trip(spark):
    d = spark.createDataFrame([(i, " ".join(["tok"] * (i % 23))) for i in range(300)] + [(1000, "word " * 500), (1001, None), (1002, ""), (5, "tok"), (None, "a b c")], "doc_id long, text string").withColumns({"size": F.lit("clash"), "target": F.lit(1), "rank": F.lit(0)})
    t = spark.createDataFrame([("s", 20), ("s", 20), ("m", 100), (None, 5), ("bad", 0), ("none", None)], "target_name string, capacity_tokens int")
    got = packing.pack(d, t).collect()
    n = {(r.doc_id, r.n_tokens) for r in packing.token_counts(d).collect()}
    for name, cap in (("s", 20), ("m", 100)):
        mine = [r for r in got if r.target_name == name]
        fill, pieces = {}, {}
        for r in mine:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
            pieces.setdefault(r.doc_id, []).append((r.piece_no, r.n_tokens))
        assert max(fill.values()) <= cap and sorted(fill) == list(range(len(fill)))
        assert sum(fill.values()) / (cap * len(fill)) > 0.97
        assert sum(k for _, k in pieces[1000]) == dict(n)[1000] and len(pieces[1000]) == -(-dict(n)[1000] // cap)
        assert all(len(p) == 1 for i, p in pieces.items() if i not in (1000, 5) and dict(n)[i] <= cap)
        assert len(mine) == sum(max(1, -(-k // cap)) for k in (r.n_tokens for r in packing.token_counts(d).collect()))
    assert {r.target_name for r in got} == {"s", "m"}
    assert packing.pack(d.limit(0), t).count() == 0 and packing.pack(d, t.limit(0)).count() == 0
    share = {r.target_name: r.share_used for r in packing.fill_report(d, t.where("target_name = 'm'")).collect()}
    assert share["m"] > 0.97
    huge = packing.pack(d, spark.createDataFrame([("all", 50_000_000)], "target_name string, capacity_tokens int"))
    assert huge.select("container_id").distinct().count() == 1 and huge.count() == d.count()


# ---- subjects


def test_beam_search_finds_the_best_set():
    rnd = np.random.default_rng(3)
    S, k = 6, 4
    m = subjects.Model([str(i) for i in range(S)], subjects.Lexicon(np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0)), np.ones(S), {}, np.zeros(k), np.ones(k), rnd.normal(size=k), rnd.normal(size=S), np.tril(rnd.normal(size=(S, S)), -1), 0.8, 0.1)
    x = rnd.normal(size=(20, S, k))
    got = subjects.decode(m, x, beam=64)
    z0 = subjects.margins(m, x)
    for d in range(20):
        best, arg = -np.inf, None
        for code in range(2**S):
            y = np.array([(code >> j) & 1 for j in range(S)], float)
            z = m.scale * (z0[d] + m.chain @ y) + m.shift
            lp = np.where(y == 1, -np.logaddexp(0, -z), -np.logaddexp(0, z)).sum()
            if lp > best:
                best, arg = lp, y
        assert (got[d] == arg).all()


def test_subjects_on_held_out_labels(spark):
    docs, labels, areas = (spark.read.parquet(f"{DATA}/sf0.1/{n}.parquet") for n in ("documents", "subject_labels", "subject_areas"))
    held = F.pmod(F.xxhash64(F.col("doc_id") + 17), F.lit(3)) == 0
    model = subjects.fit(docs, labels.where(~held), areas)
    truth = {}
    for r in labels.where(held).collect():
        truth.setdefault(r.doc_id, []).append(r.subject)
    got = {}
    for r in subjects.assign(docs.join(labels.where(held).select("doc_id").distinct(), "doc_id", "left_semi"), model).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    one = {d: s for d, s in truth.items() if len(set(s)) == 1}  # raters agree
    named = [d for d, s in one.items() if s[0] is not None]
    none = [d for d, s in one.items() if s[0] is None]
    # about one label in ten names a subject of which the text has not a word: no model can agree with those
    assert np.mean([one[d][0] in got.get(d, ()) for d in named]) > 0.87
    assert np.mean([not got.get(d) for d in none]) > 0.9
    assert all(len(s) <= 3 for s in got.values())


def test_subjects_with_dirt(spark):
    docs = spark.createDataFrame([(1, None, None, None), (2, "", "s", 1), (3, "wheat " * 9, None, None), (None, "wheat", "s", 1)], "doc_id long, text string, source string, n_files int").withColumn("given", F.lit("clash"))
    areas = spark.createDataFrame([("agronomy",), (None,)], "subject string")
    labels = spark.createDataFrame([(3, "agronomy"), (3, "unknown"), (None, "agronomy"), (2, None)], "doc_id long, subject string")
    m = subjects.fit(docs, labels, areas)
    assert subjects.assign(docs, m).count() == 0  # too few labels to learn from
    assert subjects.assign(docs, subjects.fit(docs, labels.limit(0), areas)).count() == 0
    rnd = random.Random(0)
    voc = {"agronomy": ["wheat", "soil", "paddy", "mulch", "barley", "harvest"], "law": ["jury", "plea", "bail", "tort", "clause", "verdict"]}
    made = []
    for i in range(200):
        s = rnd.choice(["agronomy", "law", None])
        made.append((i, " ".join(rnd.choice(["table", "note", "list"]) + (" " + rnd.choice(voc[s]) if s else "") for _ in range(12)), s))
    d = spark.createDataFrame([(i, t, "r", 1) for i, t, _ in made], docs.schema.fieldNames()[:4]).selectExpr("cast(doc_id as long) doc_id", "text", "source", "cast(n_files as int) n_files")
    lab = spark.createDataFrame([(i, s) for i, _, s in made if i < 120], "doc_id long, subject string")
    m = subjects.fit(d, lab, spark.createDataFrame([("agronomy",), ("law",)], "subject string"))
    assert set(rows(subjects.assign(d, m))) == {(i, s) for i, _, s in made if s}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    df = queries.QUERIES[name](spark, f"{DATA}/sf0.001")
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").count()
    n = df.count()
    assert {"p6_pack": n >= 3 * docs, "p6_fill": n == 3, "p7_clean": docs // 2 < n <= docs, "p8_mix": n >= 1}.get(name, 0 < n <= docs if name != "p8_found" else n <= 3 * docs)
