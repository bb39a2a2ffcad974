"""Held-out evaluation passages inside a training corpus.

The n-grams of the normalised passages are a hash set, broadcast behind a check of its size; the token
windows of every text are looked up in it; hits of one passage in one text that follow one another are one
stretch, stretches are chained in the order of both, with small shifts for changed, dropped or inserted
words, and a chain that covers enough of the passage, its words compared as words, is a leak.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .text import hashed_words, words

N = 3  #: words of an n-gram: every fourth word may be another one
LEAST = 10  #: words of a passage: anything shorter is a fragment
STRETCH = 20  #: words of a passage that make a leak, or all of a shorter one
SLACK = 3  #: words that may be lacking at the ends of a stretch or be changed in a short passage
COVER = 12  #: words that a chain must cover with n-gram hits, or all but SLACK of a shorter passage
PAIRS = 2_000_000  #: hits that are in memory at once; what follows one another is put together before the next ones
SHIFT, GAP = 4, 16  #: words by which neighbouring hits of a chain may be out of step, and lie apart
#: words of the passages in one broadcast index (about 40 bytes each); more are scanned for in several passes
INDEX_WORDS = 2_000_000
_BITS = 22

SCHEMA = "doc_id long, passage_id long, first_word int, n_words int, covered int"


def _hashes(ids: np.ndarray) -> np.ndarray:
    """A hash per window of N word hashes."""
    n = len(ids) - N + 1
    h = np.zeros(max(0, n), np.uint64)
    for k in range(N if n > 0 else 0):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += ids[k : n + k]
        h ^= h >> np.uint64(29)
    return h


class Index:
    """Passages of at least LEAST words by the hashes of their n-grams."""

    def __init__(self, passages: list[tuple[int, str]]):
        passages = [(p, t) for p, t in passages if len(words(t)) >= LEAST]
        self.pids = np.array([p for p, _ in passages], np.int64)
        self.texts = [t for _, t in passages]
        self.ids, of = hashed_words(self.texts)
        self.start = np.searchsorted(of, np.arange(len(passages) + 1))
        size = np.diff(self.start)
        self.cover = np.minimum(COVER, size - SLACK)
        self.reach = np.minimum(STRETCH, size) - SLACK
        h = _hashes(self.ids)
        whole = of[: len(h)] == of[N - 1 :] if len(h) else np.zeros(0, bool)
        where = np.flatnonzero(whole)
        order = np.argsort(h[where], kind="stable")
        self.place = where[order]  # place in all passages' words
        self.owner = of[self.place]
        self.keys, self.first, self.count = np.unique(h[self.place], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def _known(self, ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``ids`` of known n-grams, none across two texts, and their keys."""
        h = _hashes(ids)
        if not len(h) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pos = np.flatnonzero(self.maybe[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        pos = pos[of[pos] == of[pos + N - 1]]
        k = np.minimum(np.searchsorted(self.keys, h[pos]), len(self.keys) - 1)
        same = self.keys[k] == h[pos]
        return pos[same], k[same]

    def _pairs(self, ids: np.ndarray, pos: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = self.count[k]
        each = np.repeat(np.arange(len(pos)), n)
        post = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p, q = pos[each], self.place[post]
        sure = np.ones(len(p), bool)  # the words' own hashes too
        for j in range(N):
            sure &= ids[p + j] == self.ids[q + j]
        return p[sure], self.owner[post][sure], q[sure]

    def hits(self, ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``ids``, passages (by their number) and places there of all n-grams in common."""
        return self._pairs(ids, *self._known(ids, of))

    def stretches(self, ids: np.ndarray, of: np.ndarray, pairs: int = PAIRS) -> np.ndarray:
        """Rows (text, passage, first place, first place in the passage, hits in a row) by text, passage and place."""
        pos, k = self._known(ids, of)
        cut = np.searchsorted(np.cumsum(self.count[k]), np.arange(pairs, self.count[k].sum() + pairs, pairs)) if len(pos) else []
        parts, a = [], 0
        for b in [*cut[:-1], len(pos)] if len(pos) else []:
            p, o, q = self._pairs(ids, pos[a:b], k[a:b])
            parts.append(_joined(np.stack([of[p], o, p, q, np.ones(len(p), np.int64)], 1)))
            a = b
        r = _joined(np.concatenate(parts)) if parts else np.zeros((0, 5), np.int64)
        return r[np.lexsort((r[:, 3], r[:, 2], r[:, 1], r[:, 0]))]


def _joined(r: np.ndarray) -> np.ndarray:
    """Stretches that go on where another one of the same diagonal ends are one."""
    r = r[np.lexsort((r[:, 2], r[:, 2] - r[:, 3], r[:, 1], r[:, 0]))]
    if not len(r):
        return r
    on = (r[1:, :2] == r[:-1, :2]).all(1) & (r[1:, 2] - r[1:, 3] == r[:-1, 2] - r[:-1, 3]) & (r[1:, 2] == r[:-1, 2] + r[:-1, 4])
    head = np.flatnonzero(np.append(True, ~on))
    out = r[head].copy()
    out[:, 4] = np.add.reduceat(r[:, 4], head)
    return out


def chains(r: list[list[int]], cover: int, reach: int) -> list[tuple[int, int, int, list[int]]]:
    """(first word, end, covered, stretches) of the parts of a text that hold a chain which covers and reaches enough.

    ``r``: (place, place in the passage, hits) of one passage's stretches in one text, by place. A stretch goes
    on from the last one on its own or a near diagonal; parts that overlap are one.
    """
    latest: dict[int, int] = {}
    score, first, back = [], [], []
    found: list[tuple[int, int, int, int]] = []
    for j, (p, q, n) in enumerate(r):
        best = (n + N - 1, (p, q), -1)
        for diagonal in range(p - q - SHIFT, p - q + SHIFT + 1):
            i = latest.get(diagonal)
            if i is None:
                continue
            lp, lq = r[i][0] + r[i][2] - 1, r[i][1] + r[i][2] - 1  # the last n-gram of it
            if lp < p <= lp + GAP and lq < q:
                got = score[i] + n - 1 + min(N, p - lp, q - lq)
                if got > best[0]:
                    best = (got, first[i], i)
        latest[p - q] = j
        score.append(best[0])
        first.append(best[1])
        back.append(best[2])
        end = p + n + N - 1
        if best[0] >= cover and q + n + N - 1 - best[1][1] >= reach:
            found.append((best[1][0], end, best[0], j))
    out: list[tuple[int, int, int, int]] = []
    for a, end, n, j in sorted(found):
        if out and a < out[-1][1]:
            x = out[-1]
            out[-1] = (x[0], max(x[1], end), max(x[2], n), j if n > x[2] else x[3])
        else:
            out.append((a, end, n, j))

    def whole(j: int) -> list[int]:
        path = []
        while j >= 0:
            path.append(j)
            j = back[j]
        return path

    return [(a, end, n, whole(j)) for a, end, n, j in out]


def _pieces(doc: list, text: list) -> Iterator[tuple[list, list]]:
    """Texts in groups of about a million characters: the arrays of a group take some tens of MB."""
    ids, ts, n = [], [], 0
    for i, t in zip(doc, text, strict=True):
        if t and i is not None:
            ids.append(i)
            ts.append(t)
            n += len(t)
            if n > 1_000_000:
                yield ids, ts
                ids, ts, n = [], [], 0
    if ids:
        yield ids, ts


def leaks_in(ix: Index, doc: list[int], text: list[str]) -> list[tuple[int, int, int, int, int]]:
    """Rows (doc_id, passage_id, first_word, n_words, covered) of a group of texts."""
    ids, of = hashed_words(text)
    r = ix.stretches(ids, of)
    if not len(r):
        return []
    starts = np.searchsorted(of, np.arange(len(doc)))
    edge = np.flatnonzero(np.append(True, (r[1:, :2] != r[:-1, :2]).any(1)))
    most = np.add.reduceat(r[:, 4] + N - 1, edge)
    rows = []
    for x, y, m in zip(edge.tolist(), np.append(edge[1:], len(r)).tolist(), most.tolist(), strict=True):
        d, o = int(r[x, 0]), int(r[x, 1])
        if m < ix.cover[o]:
            continue
        own = r[x:y, 2:] - np.array([starts[d], ix.start[o], 0])
        for a, end, n, path in chains(own.tolist(), int(ix.cover[o]), int(ix.reach[o])):
            t, p = words(text[d].encode("utf-8", "replace").decode()), words(ix.texts[o])
            wrong = sum(int(own[j, 2]) + N - 1 for j in path if t[own[j, 0] : own[j, 0] + own[j, 2] + N - 1] != p[own[j, 1] : own[j, 1] + own[j, 2] + N - 1])
            if n - wrong >= ix.cover[o]:  # equal hashes were equal words
                rows.append((doc[d], int(ix.pids[o]), a, end - a, n - wrong))
    return rows


def _scan(index) -> object:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text in _pieces(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if rows := leaks_in(index.value, doc, text):
                    ty = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ty, strict=True)], names=["doc_id", "passage_id", "first_word", "n_words", "covered"])

    return scan


def spans(docs: DataFrame, items: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """Rows (doc_id, item_id, first_word, n_words, covered): every leak with its place in the normalised words.

    ``docs`` has doc_id and text, ``items`` item_id and passage; other columns are ignored. Null or empty
    texts and passages give no rows, nor do passages of fewer than LEAST words, which are fragments. A leak
    is a passage of up to STRETCH words as a whole or a stretch of a longer one, up to SLACK words at its
    ends, with hits for COVER of its words or all but SLACK. Items that share a passage are all reported;
    repeated rows give repeated rows; texts are read whole, however long. The index is broadcast only up to
    ``index_words`` words of passages: more items are cut into parts by a hash of the passage, each with its
    own pass over the corpus, whose finds are stored before the next part is broadcast.
    """
    spark = docs.sparkSession
    it = items.select("item_id", "passage").where("item_id is not null and passage is not null and passage <> ''").withColumn("passage_id", F.xxhash64("passage"))
    size = it.agg(F.sum(F.length("passage") / 4)).first()[0] or 0
    parts = int(size // index_words) + 1
    found = None
    text = docs.select("doc_id", "text")
    for k in range(parts):
        mine = it.where(F.pmod("passage_id", F.lit(parts)) == k) if parts > 1 else it
        index = Index([(r[0], r[1]) for r in mine.select("passage_id", "passage").distinct().toLocalIterator()])
        shared = spark.sparkContext.broadcast(index)
        got = text.mapInArrow(_scan(shared), SCHEMA)
        if parts > 1:
            got = stored(got, "leaks")
            shared.unpersist()
        found = got if found is None else found.unionByName(got)
    return found.join(it.select("item_id", "passage_id"), "passage_id").select("doc_id", "item_id", "first_word", "n_words", "covered")


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """The documents that leak no item, all columns as they are; documents with a null doc_id stay."""
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti")


def without_spans(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """(doc_id, words): the normalised words of every document, leaking spans taken out. Null text gives null."""
    cut = leaks.groupBy("doc_id").agg(F.collect_set(F.struct("first_word", "n_words")).alias("_cut"))

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, cuts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                w = None if t is None else words(t)
                if w is not None and cuts:
                    keep = np.ones(len(w), bool)
                    for c in cuts:
                        keep[c["first_word"] : c["first_word"] + c["n_words"]] = False
                    w = [x for x, k in zip(w, keep, strict=True) if k]
                out.append(None if w is None else " ".join(w))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "words"])

    return docs.select("doc_id", "text").join(cut, "doc_id", "left").mapInArrow(trim, "doc_id long, words string")
