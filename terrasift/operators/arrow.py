"""Arrow batches of rows sorted by a key, cut at the key's changes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables that hold only whole groups, many at a time; a group may cross batches. Keys have no nulls."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        other = np.zeros(b.num_rows, bool)
        for k in keys:
            c = b.column(b.schema.get_field_index(k))
            other |= pc.not_equal(c, c[-1]).to_numpy(zero_copy_only=False)
        before = np.flatnonzero(other)
        if len(before):
            cut = int(before[-1]) + 1
            yield pa.Table.from_batches([*held[:-1], b.slice(0, cut)])
            held = [b.slice(cut)]
        elif len(held) > 1 and any(not held[-2].column(held[-2].schema.get_field_index(k))[-1].equals(b.column(b.schema.get_field_index(k))[0]) for k in keys):
            yield pa.Table.from_batches(held[:-1])
            held = [b]
    if held:
        yield pa.Table.from_batches(held)


def edges(t: pa.Table, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """First row and end of each group of a sorted table."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        c = t.column(k).combine_chunks()
        new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], t.num_rows)
