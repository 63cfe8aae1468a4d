"""Arrow batches of bounded text size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 4_000_000


def by_size(batches: Iterator[pa.RecordBatch], column: str | int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts in ``column`` take at most ``limit`` bytes, so that memory depends neither on how
    many rows Spark puts into a batch nor on how long their texts are. Batches without rows are left out."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto, start = np.cumsum(size, dtype=np.int64), 0
        while start < len(size):
            base = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
