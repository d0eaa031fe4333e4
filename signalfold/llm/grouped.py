"""Runs of equal keys in sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

from signalfold.llm.text import release


def group_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """One table for each run of rows with equal values in the first ``keys`` columns (none of them null).

    Rows must come sorted by those columns. A group is held whole, so the caller bounds its size.
    """
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in range(keys)]
        changed = None
        for c in columns:
            unlike = pc.not_equal(c.slice(1), c.slice(0, len(c) - 1))
            changed = unlike if changed is None else pc.or_(changed, unlike)
        bounds = [0, *(i + 1 for i in pc.indices_nonzero(changed).to_pylist()), batch.num_rows]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            key = tuple(c[lo].as_py() for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)
    held = []
    release()
