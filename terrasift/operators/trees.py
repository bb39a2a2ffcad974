"""Tree ensembles as node tables and as flat arrays.

A model is a list of nodes (tree, node, feature, threshold, left, right, leaf) and a rule. ``mean``: leaves
hold class probabilities, which are averaged over the trees, the largest wins, ties go to the smaller class,
splits go left on x <= threshold. ``vote``: every tree gives a class, the most frequent wins, ties go to the
smaller class, splits as before. ``sum``: leaves are margins, the sign of their sum and a base decides, splits
go left on x < threshold in single precision, a missing value goes the node's own way.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

RULES = ("mean", "vote", "sum")


@dataclass(frozen=True)
class Node:
    tree: int
    node: int
    feature: int
    threshold: float
    left: int
    right: int
    leaf: float | tuple[float, ...]
    missing_left: bool = False


@dataclass
class Ensemble:
    """All trees in flat arrays: children are places in them, a leaf has feature -1 and points at itself."""

    rule: str
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray  # nodes x outputs
    classes: np.ndarray  # class of each output; of a sum without classes, those of a negative and a positive one
    base: float = 0.0
    output: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of each tree of a sum over several classes

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Classes of the rows of x; NaN is missing."""
        wide = x.astype(np.float32) if self.rule == "sum" else x
        limit = self.threshold.astype(np.float32) if self.rule == "sum" else self.threshold
        many = len(self.classes) if self.rule != "sum" or len(self.output) else 1
        total = np.zeros((len(x), many))
        for k, root in enumerate(self.roots):
            at = np.full(len(x), root)
            live = np.flatnonzero(self.feature[at] >= 0)
            while len(live):
                n = at[live]
                v = wide[live, self.feature[n]]
                down = v < limit[n] if self.rule == "sum" else v <= limit[n]
                down |= np.isnan(v) & self.missing_left[n]
                at[live] = np.where(down, self.left[n], self.right[n])
                live = live[self.feature[at[live]] >= 0]
            if self.rule == "sum":
                total[:, self.output[k] if len(self.output) else 0] += self.value[at, 0]
            else:
                total += self.value[at]
        if many == 1:
            return self.classes[(total[:, 0] + self.base > 0).astype(int)]
        return self.classes[np.argmax(total, 1)]


def ensemble(nodes: Sequence[Node], rule: str, classes: Sequence[int] | None = None) -> Ensemble:
    """Node rows as flat arrays. Leaves of ``mean`` give the probabilities of ``classes`` in their order."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    own = sorted(nodes, key=lambda n: (n.tree, n.node))
    place = {(n.tree, n.node): i for i, n in enumerate(own)}
    leaf = np.array([n.feature < 0 for n in own])
    if rule == "mean":
        wide = len(classes or ())
        value = np.array([n.leaf if n.feature < 0 else (0.0,) * wide for n in own], float)
    elif rule == "vote":
        classes = sorted({int(n.leaf) for n in own if n.feature < 0})
        value = np.array([[float(n.feature < 0 and n.leaf == c) for c in classes] for n in own])
    else:
        classes = classes or (0, 1)
        value = np.array([[n.leaf if n.feature < 0 else 0.0] for n in own], float)
    child = lambda n, k: place.get((n.tree, k), place[n.tree, n.node])
    roots = [i for i, n in enumerate(own) if not i or own[i - 1].tree != n.tree]
    return Ensemble(
        rule, np.array(roots), np.where(leaf, -1, np.array([n.feature for n in own])), np.array([n.threshold for n in own], float),
        np.array([child(n, n.left) for n in own]), np.array([child(n, n.right) for n in own]), np.array([n.missing_left for n in own]), value, np.array(classes),
    )


def boosted_model(text: str, classes: Sequence[int] | None = None) -> Ensemble:
    """A gradient-boosted classifier from its public JSON form: tree arrays, base score, number of classes."""
    m = json.loads(text)["learner"]
    param, booster = m["learner_model_param"], m["gradient_booster"]["model"]
    score, n_class = float(str(param["base_score"]).strip("[]").split(",")[0]), int(param.get("num_class", "0"))
    parts: dict[str, list] = {k: [] for k in ("roots", "feature", "threshold", "left", "right", "missing")}
    at = 0
    for t in booster["trees"]:
        left, right = np.array(t["left_children"]), np.array(t["right_children"])
        leaf, here = left < 0, np.arange(len(left))
        parts["roots"].append(at)
        parts["feature"].append(np.where(leaf, -1, t["split_indices"]))
        parts["threshold"].append(np.array(t["split_conditions"], float))
        parts["left"].append(at + np.where(leaf, here, left))
        parts["right"].append(at + np.where(leaf, here, right))
        parts["missing"].append(np.array(t["default_left"]).astype(bool))
        at += len(left)
    flat = {k: np.concatenate(v) if k != "roots" else np.array(v) for k, v in parts.items()}
    base = math.log(score / (1 - score)) if "logistic" in m["objective"]["name"] and 0 < score < 1 else score
    output = np.array(booster["tree_info"]) if n_class > 1 else np.zeros(0, np.int64)
    labels = np.array(classes if classes is not None else range(max(2, n_class)))
    return Ensemble("sum", flat["roots"], flat["feature"], flat["threshold"], flat["left"], flat["right"], flat["missing"], flat["threshold"][:, None], labels, base, output)


def forest_model(text: str) -> Ensemble:
    """A forest from JSON: classes, and per tree the arrays left, right, feature, threshold, value (class weights per node)."""
    m = json.loads(text)
    nodes = []
    for k, t in enumerate(m["trees"]):
        for i, (left, right, f, x, v) in enumerate(zip(t["left"], t["right"], t["feature"], t["threshold"], t["value"], strict=True)):
            whole = sum(v) or 1.0
            nodes.append(Node(k, i, -1, 0.0, 0, 0, tuple(w / whole for w in v)) if left < 0 else Node(k, i, f, x, left, right, 0.0))
    return ensemble(nodes, "mean", m["classes"])


def expression(nodes: Sequence[Node], features: Column, rule: str, classes: Sequence[int] | None = None) -> Column:
    """A small ensemble as one column expression, inside whole-stage code."""
    trees: dict[int, dict[int, Node]] = {}
    for n in nodes:
        trees.setdefault(n.tree, {})[n.node] = n

    def descend(t: dict[int, Node], k: int, out: int | None = None) -> Column:
        n = t[k]
        if n.feature < 0:
            return F.lit(float(n.leaf if out is None else n.leaf[out]))
        x = F.get(features, F.lit(n.feature))
        left = x < n.threshold if rule == "sum" else x <= n.threshold
        if n.missing_left:
            left = left | x.isNull()
        return F.when(left, descend(t, n.left, out)).otherwise(descend(t, n.right, out))

    def total(out: int | None = None) -> Column:
        leaves = [descend(t, 0, out) for _, t in sorted(trees.items())]
        s = leaves[0]
        for x in leaves[1:]:
            s = s + x
        return s

    if rule == "sum":
        return F.when(total() > 0, 1).otherwise(0)
    if rule == "mean":
        best = F.array_max(F.array(*(F.struct(total(k).alias("p"), F.lit(-k).alias("k")) for k in range(len(classes)))))
        return F.get(F.array(*(F.lit(int(c)) for c in classes)), -best["k"])
    leaves = [descend(t, 0) for _, t in sorted(trees.items())]
    votes = F.array(*leaves)
    count = lambda c: F.size(F.filter(votes, lambda v: v == c))
    given = sorted({n.leaf for n in nodes if n.feature < 0})
    best = F.array_max(F.array(*(F.struct(count(c).alias("n"), F.lit(-float(c)).alias("c")) for c in given)))
    return (-best["c"]).cast("int")


def matrix(column: pa.Array, missing: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are not null, their values as a matrix) of a list column; null values are ``missing``."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    v = flat.to_numpy(zero_copy_only=False).astype(float)
    if flat.null_count:
        v = np.where(flat.is_valid().to_numpy(zero_copy_only=False), v, missing)
    return at, v.reshape(len(at), -1) if len(at) else np.zeros((0, 0))


def predict(df: DataFrame, model: Sequence[Node] | Ensemble, features: str, rule: str = "mean", missing: float = 0.0, classes: Sequence[int] | None = None) -> DataFrame:
    """Adds ``cls`` for ensembles too large for an expression; their arrays (about 40 bytes a node) travel as a broadcast.

    Null feature arrays give null; null values count as ``missing`` (NaN: they go a node's own way). Arrays
    of one table have one length.
    """
    shared = df.sparkSession.sparkContext.broadcast(model if isinstance(model, Ensemble) else ensemble(model, rule, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = matrix(b.column(b.schema.get_field_index(features)), missing)
            res = np.zeros(b.num_rows, np.int32)
            none = np.ones(b.num_rows, bool)
            if len(at):
                res[at] = shared.value.predict(x)
                none[at] = False
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(res, pa.int32(), mask=none)], names=[*b.schema.names, "cls"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("cls", IntegerType())]))
