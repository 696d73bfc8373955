"""Burrows-Wheeler transforms of sets of byte strings, and their merging by iterative refinement of the interleave.

The transform of a set is that of its suffixes, each string ended by a terminator of its own which sorts before all bytes, the
strings' terminators in order. Merging takes no suffix of two shards in hand to compare them: the interleave starts as one
block, shard after shard, and each round moves every entry to its predecessor's place, stably by the symbol that precedes it. After h
rounds the blocks are the sets of suffixes that agree in h symbols (so the round in which neighbours part is the length of
their common prefix). A suffix alone in its block stays alone whatever comes before it, so only blocks of several go on. And a
suffix takes part only if enough symbols stand before it to be the tail of one of the wanted length when the rounds end.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Symbols packed into one number when a shard's suffixes are sorted first: nine bits each.
_PACKED = 7
END = 256


def transform(strings: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The transform (uint16 symbols; END stands for a string's start) of strings laid end to end, of the given sizes."""
    count, total = len(sizes), int(sizes.sum()) + len(sizes)
    stops = np.cumsum(sizes + 1) - 1
    symbols = np.zeros(total + _PACKED, np.uint64)
    body = np.ones(total, bool)
    body[stops] = False
    symbols[:total][body] = strings.astype(np.uint64) + np.uint64(1)
    key, open_ = np.zeros(total, np.uint64), np.ones(total, bool)
    for i in range(_PACKED):
        own = np.where(open_, symbols[i : i + total], np.uint64(0))
        key = (key << np.uint64(9)) | own
        open_ &= own > 0
    # The ended ones differ by their string at the latest; a stable sort has them in that order.
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], (key[order[1:]] != key[order[:-1]]) | ~open_[order[1:]] | ~open_[order[:-1]]))
    rank = np.empty(total, np.int64)
    leads = np.flatnonzero(fresh)
    rank[order] = np.repeat(leads, np.diff(np.append(leads, total)))
    known = _PACKED
    alone = fresh & np.append(fresh[1:], True)
    tied = np.flatnonzero(~alone)  # places in order whose suffixes are not told apart yet
    while len(tied):
        own = order[tied]
        pair = rank[own] * total + rank[own + known]
        by = np.argsort(pair, kind="stable")
        order[tied] = own = own[by]
        pair = pair[by]
        fresh = np.concatenate(([True], pair[1:] != pair[:-1]))
        leads = np.flatnonzero(fresh)
        rank[own] = np.repeat(tied[leads], np.diff(np.append(leads, len(own))))
        tied = tied[~(fresh & np.append(fresh[1:], True))]
        known *= 2
    before = np.concatenate(([END], np.where(body, symbols[:total].astype(np.int64) - 1, END)[:-1]))
    assert count == 0 or rank[stops[-1]] == count - 1
    return before[order].astype(np.uint16)


def _steps(symbols: np.ndarray) -> np.ndarray:
    """Where each entry's symbol, as the first of the suffix that it begins, stands in the same transform."""
    steps = np.empty(len(symbols), np.int64)
    order = np.argsort(np.where(symbols == END, 0, symbols.astype(np.int32) + 1).astype(np.uint16), kind="stable")
    steps[order] = np.arange(len(symbols))
    return steps


def merged(shards: list[tuple[np.ndarray, np.ndarray]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(interval, string, offset) of all suffixes that share their first length symbols with another, over the transforms of
    all shards, given as (symbols, sizes of the strings). Strings are numbered through the shards; intervals are in merged order."""
    bases = np.cumsum([0, *(len(s) for s, _ in shards)])
    symbols = np.concatenate([s for s, _ in shards])
    steps = np.concatenate([base + _steps(s) for base, (s, _) in zip(bases, shards)])
    # Walk all strings back from their ends at once, to name the suffix that each entry stands for.
    sizes = np.concatenate([n for _, n in shards])
    string, offset = np.empty(len(symbols), np.int64), np.empty(len(symbols), np.int64)
    at = np.concatenate([base + np.arange(len(n)) for base, (_, n) in zip(bases, shards)])
    who, left = np.arange(len(sizes)), sizes.copy()
    while len(at):
        string[at], offset[at] = who, left
        on = left > 0
        at, who, left = steps[at[on]], who[on], left[on] - 1

    entry = np.flatnonzero(offset >= length)
    block = np.zeros(len(entry), np.int64)
    for _ in range(length):
        symbol = symbols[entry].astype(np.uint8)  # none of them stands at its string's start
        order = np.argsort(symbol, kind="stable")
        symbol, entry, block = symbol[order], steps[entry[order]], block[order]
        if not len(entry):
            break
        fresh = np.concatenate(([True], (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])))
        several = ~(fresh & np.append(fresh[1:], True))
        block = (np.cumsum(fresh) - 1)[several]
        entry = entry[several]
    return block, string[entry], offset[entry]
