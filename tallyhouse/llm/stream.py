"""Groups out of partitions that are sorted by the group's key, held one group at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups: every table holds all rows of the keys in it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        same = bool(held) and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
        if held and not same:
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of every group, and the number of rows."""
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)
