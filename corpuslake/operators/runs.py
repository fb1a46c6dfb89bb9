"""Arrow batches in runs of bounded size, so that a task's memory doesn't follow the size of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in runs of about so many bytes.
RUN_BYTES = 1_000_000


def borders(lengths: np.ndarray, size: int) -> list[tuple[int, int]]:
    """First and last place of runs whose ``lengths`` add up to about ``size``; a long one ends its run."""
    number = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(lengths)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def text_runs(batches: Iterator[pa.RecordBatch], text: str, size: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in runs of about ``size`` bytes of ``text``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        for first, end in borders(lengths.astype(np.int64) + 1, size):
            yield batch.slice(first, end - first)
