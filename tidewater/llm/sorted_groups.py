"""Groups of a sorted stream of Arrow batches, one at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) for each run of equal ``keys`` (integers without nulls); one run is held at a time."""
    key, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, dtype=bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        at = [*np.flatnonzero(new), b.num_rows]
        for a, z in zip(at, at[1:], strict=False):
            this = tuple(int(c[a]) for c in columns)
            if this != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = this
            held.append(b.slice(a, z - a))
    if held:
        yield key, pa.Table.from_batches(held)
