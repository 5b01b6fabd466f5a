"""Arrow batches in tasks: slices of bounded size, and the columns of an operator's input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have at most `limit` bytes; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end
