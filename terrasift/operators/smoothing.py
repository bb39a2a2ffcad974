"""Whittaker smoothing of pixel series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

LAMBDA, ORDER, CLIP = 0.5, 2, 1.0


def penalty_matrix(n: int, lam: float = LAMBDA, order: int = ORDER) -> np.ndarray:
    """lam * D'D of the differences of the given order; zeros for series too short to have one."""
    if n <= order:
        return np.zeros((n, n))
    d = np.diff(np.eye(n), n=order, axis=0)
    return lam * d.T @ d


def smoother(n: int, lam: float = LAMBDA, order: int = ORDER) -> np.ndarray:
    """The matrix that smooths a complete series."""
    return np.linalg.inv(np.eye(n) + penalty_matrix(n, lam, order))


def smooth_complete(series: Column, n: int, lam: float = LAMBDA, order: int = ORDER, digits: int | None = None) -> Column:
    """Smoothed array of a complete series of length n, in the JVM: its product with a constant matrix."""
    m = smoother(n, lam, order)
    rows = F.array(*(F.array(*(F.lit(float(x if digits is None else round(x, digits))) for x in r)) for r in m))
    dot = lambda r: F.aggregate(F.zip_with(r, series, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(rows, lambda r: F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), dot(r))))


def solve_block(v: np.ndarray, lam: float = LAMBDA, order: int = ORDER) -> np.ndarray:
    """Smooths the rows of a matrix with NaN gaps; rows of one gap pattern share one solve.

    Rows without any value stay NaN. A pattern whose system is singular gets the least-squares solution of
    smallest norm: the null space of the penalty are the polynomials below ``order``, so with differences of
    any order that is so where fewer than ``order`` values are there.
    """
    n = v.shape[1]
    out = np.full(v.shape, np.nan)
    p = penalty_matrix(n, lam, order)
    seen = ~np.isnan(v)
    kinds, which = np.unique(np.packbits(seen, axis=1), axis=0, return_inverse=True)
    which = which.reshape(-1)
    for k in range(len(kinds)):
        rows = np.flatnonzero(which == k)
        w = seen[rows[0]].astype(float)
        if not w.any():
            continue
        a, y = np.diag(w) + p, np.nan_to_num(v[rows]).T * w[:, None]
        few = w.sum() < order and n > order
        z = np.linalg.lstsq(a, y, rcond=None)[0] if few else np.linalg.solve(a, y)
        out[rows] = np.clip(z.T, -CLIP, CLIP)
    return out


def smooth(df: DataFrame, series: str, lam: float = LAMBDA, order: int = ORDER) -> DataFrame:
    """Adds ``smooth``, the smoothed series, stored as float like the series it comes from.

    Null series give null; all-missing series stay missing; lengths may differ between rows. Arrow
    batches, numpy solves, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.schema.get_field_index(series))
            flat = lists.flatten()
            v = np.where(flat.is_valid().to_numpy(zero_copy_only=False), flat.to_numpy(zero_copy_only=False).astype(float), np.nan)
            size = np.where(lists.is_valid().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
            start = np.append(0, np.cumsum(size))
            out = np.full(len(v), np.nan)
            for n in np.unique(size[size > 0]):  # mostly one length
                at = start[:-1][size == n][:, None] + np.arange(n)
                out[at] = solve_block(v[at], lam, order)
            values = pa.array(out.astype(np.float32), mask=np.isnan(out))
            made = pa.ListArray.from_arrays(pa.array(start, pa.int32()), values, mask=pa.array(lists.is_null().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, "smooth"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("smooth", ArrayType(FloatType()))]))
