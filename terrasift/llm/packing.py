"""Texts into containers of fixed token capacity by best-two-fit.

Texts of one size are interchangeable, so packing works on the histogram of sizes, which has at most
``capacity`` rows however many texts there are. Bins are built as patterns (how many texts of which
sizes) with a multiplicity; texts are then ranked within their size and each rank is looked up in the
patterns. Only histogram and patterns pass the driver; both are bounded by the capacity.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import number_rows
from ..session import scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"  #: ranks of a public byte-level BPE
#: the public split pattern of that vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASCII = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^ \t\n\r\x0b\x0cA-Za-z0-9]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+")
BUCKET_ROWS = 20_000  #: pieces of one size that are ranked in one window, about
_RANKS = 1 << 40  # ranks of one size, at most


class Counter(dict):
    """Tokens of a pretoken: merges never cross pretokens, so each distinct one is encoded once."""

    LIMIT = 400_000

    def __init__(self, path: str):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.any = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not text.isascii():
            text = text.encode("utf-8", "replace").decode()  # lone surrogates
        return sum(map(self.__getitem__, (_ASCII if text.isascii() else self.any).findall(text)))


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of every row; a null or empty text has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Counter(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([c.count(t) for t in b.column(1).to_pylist()], pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def patterns(sizes: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best-two-fit on a histogram: (number of bins, texts per size in each of them).

    A bin starts with the largest size left and is filled with the largest sizes that fit. If room is
    left, its smallest text gives way to the two unpacked texts that fill the widened gap best, if they
    fill it better. The bin is repeated as often as its texts allow.
    """
    left = {s: n for s, n in sizes.items() if 0 < s <= capacity and n > 0}
    there = sorted(left)
    out = []
    while there:
        bin_: dict[int, int] = {}
        gap = capacity
        while gap > 0:
            i = bisect_right(there, gap) - 1
            while i >= 0 and bin_.get(there[i], 0) >= left[there[i]]:
                i -= 1
            if i < 0:
                break
            s = there[i]
            k = min(gap // s, left[s] - bin_.get(s, 0))
            bin_[s] = bin_.get(s, 0) + k
            gap -= k * s
        if gap:
            small = min(bin_)
            pair = _best_pair(there, left, bin_, gap + small)
            if pair and sum(pair) > small:
                bin_[small] -= 1
                for s in pair:
                    bin_[s] = bin_.get(s, 0) + 1
                bin_ = {s: k for s, k in bin_.items() if k}
        times = min(left[s] // k for s, k in bin_.items())
        out.append((times, bin_))
        for s, k in bin_.items():
            left[s] -= times * k
            if not left[s]:
                del there[bisect_right(there, s) - 1]
    return out


def _best_pair(there: list[int], left: dict[int, int], used: dict[int, int], gap: int) -> tuple[int, int] | None:
    """The two unpacked sizes with the largest sum up to ``gap``."""
    a = np.array([s for s in there[: bisect_right(there, gap - 1)] if left[s] > used.get(s, 0)], np.int64)
    if not len(a):
        return None
    j = np.searchsorted(a, gap - a, side="right") - 1
    alone = np.array([left[int(s)] - used.get(int(s), 0) < 2 for s in a])
    j = np.where((j == np.arange(len(a))) & alone, j - 1, j)  # a size of which one is left can't be both
    ok = j >= 0
    if not ok.any():
        return None
    total = np.where(ok, a + a[np.maximum(j, 0)], -1)
    i = int(np.argmax(total))
    return int(a[i]), int(a[j[i]])


def _segments(plan: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Sizes; sorted keys (number of the size) * _RANKS + first rank, first bin and texts per bin of each segment; number of bins."""
    sizes = sorted({s for _, b in plan for s in b})
    number = {s: i for i, s in enumerate(sizes)}
    next_rank: dict[int, int] = {}
    rows, base = [], 0
    for times, bin_ in plan:
        for s, k in bin_.items():
            at = next_rank.get(s, 0)
            rows.append((number[s] * _RANKS + at, base, k))
            next_rank[s] = at + times * k
        base += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return np.array(sizes, np.int64), a[:, 0], a[:, 1], a[:, 2], base


def pack(docs: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Rows (target_name, container_id, doc_id, piece_no, n_tokens): every text in a container of each target.

    A text is split only if it exceeds the capacity: into pieces of the capacity, each alone in its
    container, and a rest that is packed like a text. A null or empty text has no tokens and stands in
    some container. Repeated rows are packed each. Targets with a null name, a null capacity or one below
    1 are left out, repeated ones count once. An empty table gives no rows. Texts are read whole. The driver
    holds one count per distinct size up to the capacity, which is far fewer than texts.
    """
    spark = docs.sparkSession
    caps = [(r[0], int(r[1])) for r in targets.where("target_name is not null and capacity_tokens > 0").select("target_name", "capacity_tokens").distinct().toLocalIterator()]
    schema = "target_name string, container_id long, doc_id long, piece_no long, n_tokens long"
    if not caps:
        return spark.createDataFrame([], schema)
    # counted once, used three times: the counts are written, not the texts
    path = scratch(spark, "tokens")
    token_counts(docs, tokenizer).write.parquet(path)
    n = spark.read.schema("doc_id long, n_tokens long").parquet(path)
    cap = F.col("cap")
    whole = F.struct(F.lit(0).cast("long").alias("piece_no"), F.col("n_tokens").alias("size"))
    cut = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / cap)), lambda k: F.struct(k.alias("piece_no"), F.least(cap, F.col("n_tokens") - k * cap).alias("size")))
    each = F.array(*(F.struct(F.lit(k).alias("target"), F.lit(c).cast("long").alias("cap")) for k, (_, c) in enumerate(caps)))
    pieces = n.select("doc_id", "n_tokens", F.inline(each)).select("doc_id", "target", F.inline(F.when(F.col("n_tokens") > cap, cut).otherwise(F.array(whole))))
    hist: list[dict[int, int]] = [{} for _ in caps]
    for t, s, k in pieces.groupBy("target", "size").count().toLocalIterator():  # at most capacity + 1 rows a target
        hist[t][s] = k
    plans = spark.sparkContext.broadcast([_segments(patterns(h, c)) for h, (_, c) in zip(hist, caps, strict=True)])
    names = [c for c, _ in caps]
    # sizes that very many pieces have (whole capacities above all) are ranked in buckets of bounded size
    buckets = max(1024, max((k for h in hist for k in h.values()), default=0) // BUCKET_ROWS)
    ranked = number_rows(pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(buckets))), ["target", "size"], "_b", ["doc_id", "piece_no"], "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {x: b.column(x).to_numpy(zero_copy_only=False) for x in ("target", "size", "rank")}
            out = np.zeros(b.num_rows, np.int64)
            for t, (sizes, keys, base, per, bins) in enumerate(plans.value):
                m = c["target"] == t
                s, r = c["size"][m], c["rank"][m]
                if bins:
                    i = np.maximum(np.searchsorted(keys, np.searchsorted(sizes, s) * _RANKS + r, side="right") - 1, 0)
                    out[m] = np.where(s > 0, base[i] + (r - keys[i] % _RANKS) // per[i], r % bins)
            target = pa.array([names[t] for t in c["target"].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([target, pa.array(out), b.column("doc_id"), b.column("piece_no"), b.column("size")], names=["target_name", "container_id", "doc_id", "piece_no", "n_tokens"])

    return ranked.select("target", "size", "rank", "doc_id", "piece_no").mapInArrow(place, schema)


def fill_report(docs: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per target: containers, pieces, tokens and the share of the capacity in use."""
    per = pack(docs, targets, tokenizer).groupBy("target_name", "container_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"), F.max("piece_no").alias("_p"))
    caps = targets.groupBy("target_name").agg(F.max("capacity_tokens").alias("capacity"))
    out = per.groupBy("target_name").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_pieces"), F.sum("tokens").alias("n_tokens"))
    return out.join(caps, "target_name").withColumn("share_used", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 6))
