"""Arrow batches in pieces that bound what a task holds beside the batch itself, and workers that keep nothing after a task."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text in a piece, unless one text alone has more.
PIECE_BYTES = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], text: str | int = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, cut where the texts of a column reach the limit."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def give_back() -> None:
    """Memory that is free goes back to the system, where the allocators would keep it for the process."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # glibc has it
        trim(0)


def leaving_nothing(work: Callable) -> Callable:
    """work over a task's batches, after which its memory is given back. An executor's workers take turns and each waits for its
    next task with what it holds, so what they keep adds up beyond the tasks that run at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run
