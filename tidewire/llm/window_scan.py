"""Groups of windows of a text's bytes that share their anchor, so that equal windows of any texts fall to the same anchor.

A window is SPAN bytes. Its anchor is the least hash of the strings of GRAM bytes in it, which depends on the window's bytes
alone. Windows that follow each other mostly share it, so they are handed on as one run: the bytes of n windows in a row are
n + SPAN - 1, not n * SPAN.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPAN, GRAM = 100, 32
#: Grams of a window, and the most windows of a run: an anchor at one place is never in more.
PLACES = SPAN - GRAM + 1
#: Windows that are worked on at a time, so that a text of any length takes the same memory.
PIECE = 1 << 18
_DRAW = np.random.default_rng(12)
_CODES = _DRAW.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _DRAW.integers(1 << 61, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the strings of GRAM bytes at each place; halves of equal length are put together, so GRAM is a power of two."""
    hashed, span = _CODES[data], 1
    for odd in _ODD:
        if span == GRAM:
            break
        hashed = hashed[:-span] * odd + hashed[span:]
        span *= 2
    hashed = (hashed ^ (hashed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (hashed ^ (hashed >> np.uint64(29))) | np.uint64(1)


def _sliding(values: np.ndarray, width: int, better: Callable) -> np.ndarray:
    """The best of each width values in a row."""
    span = 1
    while span * 2 <= width:
        values = better(values[:-span], values[span:])
        span *= 2
    return better(values[: len(values) - (width - span)], values[width - span:]) if width > span else values


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, places where texts start and the last ends) of a string column without nulls."""
    large = texts.cast(pa.large_binary())
    ends = np.frombuffer(large.buffers()[1], np.int64, len(large) + 1, large.offset * 8)
    data = np.frombuffer(large.buffers()[2], np.uint8) if large.buffers()[2] is not None and large.buffers()[2].size else np.empty(0, np.uint8)
    return data, ends


def runs(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, anchor, echo) of the runs of windows within each text, a piece at a time. echo tells that the anchor may
    stand in the run more than once, so that its windows may equal each other."""
    for at in range(int(ends[0]), int(ends[-1]) - SPAN + 1, PIECE):
        piece = data[at : min(at + PIECE + SPAN - 1, int(ends[-1]))]
        windows = len(piece) - SPAN + 1
        grams = _grams(piece)
        least = _sliding(grams, PLACES, np.minimum)
        # Windows that cross the end of a text don't count.
        first, last = np.searchsorted(ends, at, "right") - 1, np.searchsorted(ends, at + windows, "left")
        change = np.zeros(windows + 1, np.int32)
        own, after = ends[first:last], ends[first + 1 : last + 1]
        long = after - own >= SPAN
        np.add.at(change, np.clip(own[long] - at, 0, windows), 1)
        np.add.at(change, np.clip(after[long] - SPAN + 1 - at, 0, windows), -1)
        inside = np.cumsum(change[:-1]) > 0
        least = np.where(inside, least, np.uint64(0))
        edge = np.empty(windows, bool)
        edge[0] = True
        np.not_equal(least[1:], least[:-1], out=edge[1:])
        starts = np.flatnonzero(edge)
        sizes = np.diff(np.append(starts, windows))
        held = inside[starts]
        starts, sizes = starts[held], sizes[held]
        if (sizes > PLACES).any():
            parts = -(-sizes // PLACES)
            within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            starts = np.repeat(starts, parts) + within * PLACES
            sizes = np.minimum(np.repeat(sizes, parts) - within * PLACES, PLACES)
        if not len(starts):
            continue
        blank = np.zeros(PLACES - 1, np.uint64)
        anchors = np.flatnonzero(grams == _sliding(np.concatenate((blank, least, blank)), PLACES, np.maximum))
        again = anchors[1:][grams[anchors[1:]] == grams[anchors[:-1]]]
        echo = np.searchsorted(again, starts + sizes + PLACES - 1) > np.searchsorted(again, starts, "right")
        text = np.searchsorted(ends, starts + at, "right") - 1
        yield text, starts + at - ends[text], sizes, least[starts].astype(np.int64), echo


def packed_place(start: np.ndarray, windows: np.ndarray, echo: np.ndarray) -> np.ndarray:
    """One number for a run's start, windows (at most PLACES, so under 128) and echo."""
    return start * 256 + windows * 2 + echo


def scanner(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pos, text) -> (anchor, pos, place), see packed_place."""
    for batch in batches:
        data, ends = text_bytes(batch.column("text"))
        for text, start, windows, anchor, echo in runs(data, ends):
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), batch.column("pos").take(pa.array(text)), pa.array(packed_place(start, windows, echo))], ["anchor", "pos", "place"])
