"""Subject areas of documents by a classifier chain over term, source and structure features.

Fit, on a bounded sample of labelled documents: a term lexicon (terms whose documents carry one subject
significantly often) and a chain of logistic models, one link per subject, that sees the features of
that subject and the subjects decided before it. Links share the feature weights and have their own
offsets and co-occurrence weights, so a subject with few labels still gets a sound link. Margins are
calibrated on held-out folds. Each document's label set is decoded with beam search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import hashed_words

#: labelled documents that the model is fitted on, at most; lexicon and source priors come from them alone (24 bytes a
#: distinct term that at least three of them share, one row a source), so this bounds the model and its broadcast too
MAX_LABELLED = 3000
SURE = 0.5  #: lower confidence bound of a term's share of documents with its subject
BEAM = 4


@dataclass
class Lexicon:
    keys: np.ndarray
    subject: np.ndarray
    weight: np.ndarray

    def of(self, terms: np.ndarray) -> np.ndarray:
        """Row in the lexicon of each term, or -1."""
        if not len(self.keys):
            return np.full(len(terms), -1)
        k = np.minimum(np.searchsorted(self.keys, terms), len(self.keys) - 1)
        return np.where(self.keys[k] == terms, k, -1)


@dataclass
class Model:
    subjects: list[str]
    lexicon: Lexicon
    prior: np.ndarray
    sources: dict[str, np.ndarray]
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    shared: np.ndarray = field(default_factory=lambda: np.zeros(0))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(0))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    scale: float = 1.0
    shift: float = 0.0


def learn_lexicon(doc: np.ndarray, term: np.ndarray, y: np.ndarray) -> Lexicon:
    """``doc``, ``term``: one row per distinct term of a document; ``y``: documents x subjects."""
    keys, at = np.unique(term, return_inverse=True)
    n = np.bincount(at, minlength=len(keys)).astype(float)
    per = np.stack([np.bincount(at, weights=y[doc, s], minlength=len(keys)) for s in range(y.shape[1])], 1) if len(keys) else np.zeros((0, y.shape[1]))
    share = per / np.maximum(n, 1)[:, None]
    z = 1.645
    low = (share + z * z / (2 * n[:, None]) - z * np.sqrt(share * (1 - share) / n[:, None] + z * z / (4 * n[:, None] ** 2))) / (1 + z * z / n[:, None])
    best = np.argmax(low, 1) if len(keys) else np.zeros(0, int)
    sure = low[np.arange(len(keys)), best]
    take = np.flatnonzero(sure >= SURE)
    return Lexicon(keys[take], best[take].astype(np.int64), share[take, best[take]])


def features(m: Model, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, source: list, n_chars: np.ndarray, n_files: np.ndarray) -> np.ndarray:
    """Documents x subjects x features. ``doc``, ``term``, ``count``: the distinct terms of each document."""
    S = len(m.subjects)
    k = m.lexicon.of(term)
    hit = k >= 0
    cell = doc[hit] * S + m.lexicon.subject[k[hit]]
    w = m.lexicon.weight[k[hit]]
    mass = np.bincount(cell, weights=count[hit] * w, minlength=n * S).reshape(n, S)
    kinds = np.bincount(cell, weights=w, minlength=n * S).reshape(n, S)
    total = mass.sum(1, keepdims=True)
    rank = np.argsort(np.argsort(-mass, axis=1, kind="stable"), axis=1)
    top = mass.max(1, keepdims=True)
    prior = np.stack([np.log(m.sources.get(s, m.prior)) for s in source]) if n else np.zeros((0, S))
    wide = lambda x: np.broadcast_to(np.nan_to_num(np.asarray(x, float))[:, None], (n, S))
    return np.stack(
        [
            np.log1p(mass), np.log1p(kinds), np.minimum(kinds, 6), np.minimum(mass, 8), kinds >= 3.2, mass / np.maximum(total, 1), mass / np.maximum(top, 1),
            rank == 0, rank == 1, rank > 1, prior, wide(np.log1p(np.maximum(n_chars, 0))), wide(np.log1p(np.maximum(n_files, 0))), kinds / np.maximum(mass, 1),
        ],
        axis=2,
    ).astype(float)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, steps: int = 15) -> np.ndarray:
    """Newton steps for a ridge logistic regression."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - y) + ridge * b
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        d = np.linalg.solve(h, g)
        b -= d
        if np.abs(d).max() < 1e-3:
            break
    return b


def fit_chain(m: Model, x: np.ndarray, y: np.ndarray) -> None:
    """Fits all links at once: shared feature weights, own offsets, weights of the subjects before."""
    n, S, k = x.shape
    flat = x.reshape(-1, k)
    m.mean, m.spread = flat.mean(0), np.maximum(flat.std(0), 1e-6)
    pairs = [(j, i) for j in range(S) for i in range(j)]
    design = np.zeros((n * S, k + 1 + S + len(pairs) + 1))
    design[:, :k] = (flat - m.mean) / m.spread
    design[:, k] = 1
    for j in range(S):
        design[j::S, k + 1 + j] = 1
    for c, (j, i) in enumerate(pairs):
        design[j::S, k + 1 + S + c] = y[:, i]
    design[:, -1] = (np.cumsum(y, 1) - y).reshape(-1)
    ridge = np.concatenate([np.full(k, 0.5), [0.01], np.full(S, 5.0), np.full(len(pairs), 10.0), [1.0]])
    b = _logistic(design, y.reshape(-1), ridge)
    m.shared, m.offset = b[:k], b[k] + b[k + 1 : k + 1 + S]
    m.chain = np.zeros((S, S))
    for c, (j, i) in enumerate(pairs):
        m.chain[j, i] = b[k + 1 + S + c] + b[-1]


def margins(m: Model, x: np.ndarray) -> np.ndarray:
    return ((x - m.mean) / m.spread) @ m.shared + m.offset


def decode(m: Model, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """The most probable label set of each document: documents x subjects of 0 and 1."""
    n, S, _ = x.shape
    base = margins(m, x)
    sets = np.zeros((n, 1, S))
    score = np.zeros((n, 1))
    for j in range(S):
        z = m.scale * (base[:, j, None] + sets @ m.chain[j]) + m.shift
        on, off = -np.logaddexp(0, -z), -np.logaddexp(0, z)
        with_j = sets.copy()
        with_j[:, :, j] = 1
        sets = np.concatenate([sets, with_j], 1)
        score = np.concatenate([score + off, score + on], 1)
        if sets.shape[1] > beam:
            keep = np.argsort(-score, axis=1, kind="stable")[:, :beam]
            sets, score = np.take_along_axis(sets, keep[:, :, None], 1), np.take_along_axis(score, keep, 1)
    return sets[np.arange(n), np.argmax(score, 1)]


def _distinct_terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, term, count) of the distinct terms of each text."""
    h, of = hashed_words(texts, parts=True)
    if not len(h):
        return of, h, of
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])))
    return of[first], h[first], np.diff(np.append(first, len(h)))


def _groups(b: pa.RecordBatch, size: int = 1_000_000) -> Iterator[dict[str, list]]:
    c = {n: b.column(n).to_pylist() for n in b.schema.names}
    lengths = np.cumsum([len(t or "") for t in c["text"]]) // size
    edges = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), len(lengths)]
    for x, y in zip(edges, edges[1:], strict=False):
        if y > x:
            yield {n: v[x:y] for n, v in c.items()}


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for g in _groups(b):
            doc, term, count = _distinct_terms([t or "" for t in g["text"]])
            cut = np.searchsorted(doc, np.arange(len(g["text"]) + 1))
            lists = lambda v, t: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(v, t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(g["doc_id"], pa.int64()), pa.array(g["source"], pa.string()), pa.array([len(t or "") for t in g["text"]], pa.int64()), pa.array(g["n_files"], pa.int64()),
                 pa.array(g["given"], pa.list_(pa.string())), lists(term.view(np.int64), pa.int64()), lists(count, pa.int64())],
                names=["doc_id", "source", "n_chars", "n_files", "given", "terms", "counts"],
            )


def fit(docs: DataFrame, labels: DataFrame, areas: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A model from at most ``max_labelled`` labelled documents, those of the smallest hash of doc_id.

    A document's labels are the subjects that any of its raters gave, if more than half of them gave some
    subject or its raters are even; labels that ``areas`` doesn't have count as none. The driver gets the
    distinct terms of the sampled documents only. However few they are, the model is fitted on them
    (ridge); without any label it gives no subject to anything.
    """
    subjects = sorted(r[0] for r in areas.select("subject").where("subject is not null").distinct().toLocalIterator())
    S = len(subjects)
    known = F.when(F.col("subject").isin(subjects), F.col("subject"))
    given = labels.where("doc_id is not null").withColumn("subject", known).groupBy("doc_id").agg(F.collect_set("subject").alias("given"), F.count("subject").alias("_n"), F.count(F.lit(1)).alias("_all"))
    given = given.withColumn("given", F.when(F.col("_n") * 2 >= F.col("_all"), F.col("given")).otherwise(F.array().cast("array<string>"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).select("doc_id", "given")
    d = docs.select("doc_id", "text", "source", F.col("n_files").cast("long").alias("n_files")).join(given, "doc_id")
    rows = d.mapInArrow(_terms_of, "doc_id long, source string, n_chars long, n_files long, given array<string>, terms array<long>, counts array<long>").toArrow().sort_by("doc_id")
    n = rows.num_rows
    place = {s: k for k, s in enumerate(subjects)}
    y = np.zeros((n, S))
    for k, g in enumerate(rows.column("given").to_pylist()):
        for s in g or []:
            y[k, place[s]] = 1
    order = np.argsort(-y.sum(0), kind="stable")  # frequent subjects first in the chain
    subjects, y = [subjects[k] for k in order], y[:, order]
    lists = rows.column("terms").combine_chunks()
    doc = np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False)) if n else np.zeros(0, int)
    term = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) if n else np.zeros(0, np.uint64)
    count = rows.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False) if n else np.zeros(0, int)
    source, chars, files = rows.column("source").to_pylist(), rows.column("n_chars").to_numpy(), rows.column("n_files").to_numpy().astype(float)
    prior = (y.sum(0) + 1) / (n + 2)
    m = Model(subjects, learn_lexicon(doc, term, y), prior, {})

    def priors(of: np.ndarray) -> dict[str, np.ndarray]:
        by: dict[str, list[int]] = {}
        for k in np.flatnonzero(of):
            if source[k] is not None:
                by.setdefault(source[k], []).append(k)
        return {s: (y[k].sum(0) + 20 * prior) / (len(k) + 20) for s, k in by.items()}

    m.sources = priors(np.ones(n, bool))
    if not y.any():
        m.mean, m.spread, m.shared, m.offset, m.chain = np.zeros(14), np.ones(14), np.zeros(14), np.full(S, -30.0), np.zeros((S, S))
        return m
    # features of a document come from a lexicon that has not seen it
    x = np.zeros((n, S, 14))
    z = np.zeros((n, S))
    fold = (np.arange(n) * 2654435761 >> 7) % 2
    for f in range(2):
        mine, rest = fold == f, fold != f
        sees = rest[doc]
        part = Model(subjects, learn_lexicon(doc[sees], term[sees], y), prior, priors(rest))
        x[mine] = features(part, doc, term, count, n, source, chars, files)[mine]
    for f in range(2):
        mine, rest = fold == f, fold != f
        part = Model(subjects, m.lexicon, prior, m.sources)
        fit_chain(part, x[rest], y[rest])
        z[mine] = margins(part, x[mine]) + y[mine] @ part.chain.T
    a = _logistic(np.stack([z.reshape(-1), np.ones(z.size)], 1), y.reshape(-1), np.array([1e-3, 1e-3]))
    fit_chain(m, x, y)
    m.scale, m.shift = float(a[0]), float(a[1])
    return m


def assign(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, subject) of all documents; none for a null or empty text or a text without a subject.

    Other columns are ignored; repeated rows give repeated rows; texts are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        names = np.array(m.subjects, object)
        for b in batches:
            for g in _groups(b):
                text = [t or "" for t in g["text"]]
                doc, term, count = _distinct_terms(text)
                k = m.lexicon.of(term) >= 0
                some = np.unique(doc[k])  # the others have no term of any subject
                if not len(some):
                    continue
                new = np.searchsorted(some, doc[k])
                files = np.array([np.nan if g["n_files"][i] is None else g["n_files"][i] for i in some], float)
                x = features(m, new, term[k], count[k], len(some), [g["source"][i] for i in some], np.array([len(text[i]) for i in some]), files)
                at, s = np.nonzero(decode(m, x))
                yield pa.RecordBatch.from_arrays([pa.array([g["doc_id"][i] for i in some[at]], pa.int64()), pa.array(names[s].tolist(), pa.string())], names=["doc_id", "subject"])

    return docs.select("doc_id", "text", "source", F.col("n_files").cast("long").alias("n_files")).where("doc_id is not null").mapInArrow(score, "doc_id long, subject string")
