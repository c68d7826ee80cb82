"""Arrow batches in small parts.

Spark fills a batch up to 10,000 rows or 64 MB, and values in Python take a
multiple of that in each worker.  Row-wise functions take their batches in
parts, so that only a part at a time is there as Python values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

#: Rows and bytes of a part; a row that is larger is a part of its own.
ROWS, BYTES = 256, 1 << 20


def parts(batch, rows: int = ROWS) -> Iterator:
    """Slices of a batch or array, in order; nothing is copied."""
    n = len(batch)
    step = max(1, min(rows, n * BYTES // max(1, batch.nbytes)))
    for at in range(0, n, step):
        yield batch.slice(at, step)


def all_parts(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from parts(batch, rows)


def map_parts(values: pa.Array, fn: Callable[[pa.Array], pa.Array], kind: pa.DataType) -> pa.Array:
    """``fn`` of an array, computed part by part."""
    done = [fn(p) for p in parts(values)]
    return pa.concat_arrays(done) if done else pa.array([], kind)
