"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are put in a random but fixed order and cut into blocks. Slots of the mix take one block each. The
mix that is aimed at is a fluid: at any time the sources that still have blocks flow at rates in proportion to their weights,
and when one runs out, the others speed up. Block i of a source is released in the slot in which its part of the fluid
begins to flow and is due when that part has flown; of the released blocks, the one due first takes the slot. Every block
meets its due time, so after any number of slots each source has had less than one block more or less than its fluid. The
weights are taken as they are, without rounding. No row is lost: the mix ends with the last block of all.

The fluid has a closed form (Fluid), so any frame of FRAME slots can be scheduled by itself: the blocks that earliest due time
first leaves open where a frame begins are those due last, as far as there were slots for the others (open_at). So frames are
rows that tasks work on, none waits for another, and a lost one is worked out again.

The MAX_SOURCES largest sources have fluids of their own. What a table has beyond them flows as one source with the sum of
their weights, its rows in random order, so that each of those gets its share only on average. This bounds what reaches the
driver: MAX_SOURCES sources, and one number for each FRAME blocks.

Null sources are a source of their own. Rows without a key are ordered by their text; repeated rows take places side by
side. A source without a target weight is given the smallest one; weights that are not above zero are refused. An empty table
gives no rows.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewire.llm.arrow_slices import leaving_nothing
from tidewire.llm.common import ROW, packed, row_name, stored, unpacked, whole_text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sources with a fluid of their own.
MAX_SOURCES = 20_000
#: Rows of a block.
BLOCK_ROWS = 32
#: Slots that are scheduled together.
FRAME = 1 << 16
#: Times this close to a whole slot are taken as whole; doubles are that exact up to 10^10 slots.
NEAR = 1e-5
#: Power of a source's size that is its weight where none are given; it flattens the sizes.
TEMPER = 0.7
#: Columns of a row's slot and its place within, where in_mixed_order adds them.
PLACES = ("mix_slot", "mix_place")
#: Hex digits of the row's hash that divide a source for numbering.
BUCKET_DIGITS = 3
#: Name of the sources beyond MAX_SOURCES; names of sources begin otherwise.
REST = "rest"


class Fluid:
    """The mix as a fluid of sources with so many blocks and such weights.

    Virtual time runs so that source s has had i of its blocks at i / weight, whatever the others do; in slots that is the
    blocks of all sources that have run out by then, and the share of each of the others.
    """

    def __init__(self, blocks: Iterable[int], weights: Iterable[float]):
        self.blocks, weights = np.array(list(blocks), np.int64), np.array(list(weights), float)
        self.weights = weights / weights.sum() if len(weights) else weights
        order = np.argsort(self.blocks / self.weights, kind="stable")
        self.ends = (self.blocks / self.weights)[order]
        self.gone = np.concatenate([[0], np.cumsum(self.blocks[order])])
        self.flow = np.concatenate([np.cumsum(self.weights[order][::-1])[::-1], [0.0]])
        self.turns = self.gone[:-1] + self.ends * self.flow[:-1]
        self.length = int(self.blocks.sum())

    def _slots(self, virtual: np.ndarray) -> np.ndarray:
        stage = np.searchsorted(self.ends, virtual)
        return self.gone[stage] + virtual * self.flow[stage]

    def release(self, source: np.ndarray, block: np.ndarray) -> np.ndarray:
        return np.floor(self._slots(block / self.weights[source]) + NEAR).astype(np.int64)

    def due(self, source: np.ndarray, block: np.ndarray) -> np.ndarray:
        return np.ceil(self._slots((block + 1) / self.weights[source]) - NEAR).astype(np.int64)

    def phase(self, source: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Number of sources that have run out when the block begins to flow."""
        return np.searchsorted(self.ends, block / self.weights[source], side="right")

    def released(self, slot: int) -> np.ndarray:
        """Blocks of each source that are released before the slot."""
        if slot >= self.length:
            return self.blocks.copy()
        stage = np.searchsorted(self.turns, slot)
        virtual = (slot - self.gone[stage]) / self.flow[stage]
        every = np.arange(len(self.blocks))
        found = np.clip(np.ceil(virtual * self.weights).astype(np.int64), 0, self.blocks)
        # The way back from slots to virtual time is not exact; the release of the block itself decides.
        for _ in range(2):
            found += (found < self.blocks) & (self.release(every, found) < slot)
            found -= (found > 0) & (self.release(every, np.maximum(found - 1, 0)) >= slot)
        return found

    def between(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(source, block, release) of the blocks released in slots first to end - 1, by release."""
        low, high = self.released(first), self.released(end)
        source = np.repeat(np.arange(len(low)), high - low)
        block = np.arange(len(source)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[source]
        at = self.release(source, block)
        order = np.argsort(at, kind="stable")
        return source[order], block[order], at[order]


def waiting(fluid: Fluid, first: int, end: int) -> np.ndarray:
    """Number of blocks that are released and not taken, after each of the slots first to end - 1; those released in the next slot don't count."""
    _, _, at = fluid.between(first, end)
    before = int(fluid.released(first).sum()) - first
    return before + np.cumsum(np.bincount(at - first, minlength=end - first)) - np.arange(1, end - first + 1)


def open_at(fluid: Fluid, frame: int, least: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(due, source, block) of the blocks that are released before the frame and not taken there, as a heap.

    least has the smallest number of waiting blocks in each frame before. Of the blocks that are due later, at most as many as
    were waiting at any time since can have been released before that time and still be open: of each such set, the blocks
    due first are the ones that were taken.
    """
    start = frame * size
    released = fluid.released(start)
    source = np.flatnonzero(released)
    block = released[source] - 1
    due, at = fluid.due(source, block), fluid.release(source, block)
    kept = np.flatnonzero(due > start)
    kept = kept[np.argsort(at[kept], kind="stable")]
    source, block, due, at = source[kept], block[kept], due[kept], at[kept]
    since = np.minimum.accumulate(np.append(least[:frame], np.iinfo(np.int64).max)[::-1])[::-1]  # from each frame on
    own = at // size
    room = since[own] if len(own) else np.empty(0, np.int64)
    for k in np.unique(own[room <= np.arange(len(own))]):  # elsewhere even the least number of a frame leaves room for all
        here = own == k
        later = np.minimum.accumulate(waiting(fluid, k * size, (k + 1) * size)[::-1])[::-1]
        room[here] = np.minimum(later[at[here] - k * size], since[k + 1])
    heap: list[tuple[int, int, int]] = []
    for j, item in enumerate(zip(due.tolist(), source.tolist(), block.tolist())):
        heapq.heappush(heap, item)
        if j + 1 == len(at) or at[j + 1] > at[j]:
            while len(heap) > room[j]:
                heapq.heappop(heap)
    return heap


def schedule_frame(fluid: Fluid, frame: int, least: np.ndarray, size: int = FRAME) -> tuple[np.ndarray, np.ndarray]:
    """(source, block) that takes each slot of the frame: of the released blocks the one due first, then the earlier source."""
    first, end = frame * size, min((frame + 1) * size, fluid.length)
    source, block, at = fluid.between(first, end)
    items = list(zip(fluid.due(source, block).tolist(), source.tolist(), block.tolist()))
    upto = np.searchsorted(at, np.arange(first, end), side="right").tolist()
    ready, known, taken = open_at(fluid, frame, least, size), 0, []
    for slot, n in zip(range(first, end), upto):
        for item in items[known:n]:
            heapq.heappush(ready, item)
        known = n
        taken.append(heapq.heappop(ready))
        assert slot < taken[-1][0], "the fluid takes each slot once, so no block is late"
    rows = np.array(taken, np.int64).reshape(-1, 3)
    return rows[:, 1], rows[:, 2]


def _least(fluid: Fluid, size: int) -> Callable:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frame in batch.column(0).to_pylist():
                found = waiting(fluid, frame * size, min((frame + 1) * size, fluid.length)).min()
                yield pa.RecordBatch.from_arrays([pa.array([frame], pa.int64()), pa.array([int(found)], pa.int64())], ["frame", "least"])

    return work


def _scheduled(fluid: Fluid, names: list[str], least: np.ndarray, size: int) -> Callable:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.array(names, pa.string())
        for batch in batches:
            for frame in batch.column(0).to_pylist():
                source, block = schedule_frame(fluid, frame, least, size)
                columns = [block, fluid.release(source, block), fluid.due(source, block), np.arange(len(source)) + frame * size]
                phase = pa.array(fluid.phase(source, block).astype(np.int32))
                yield pa.RecordBatch.from_arrays([own.take(pa.array(source)), *map(pa.array, columns), phase], ["name", "block", "release", "due", "slot", "phase"])

    return work


def schedule(spark: SparkSession, names: list[str], fluid: Fluid, size: int) -> DataFrame:
    """One row per block: name, block, release, due, slot, phase."""
    frames = -(-fluid.length // size)
    rows = spark.range(0, frames, 1, max(1, min(frames, 10_000)))
    least = np.zeros(frames, np.int64)
    if frames > 1:  # one number for each frame
        found = rows.mapInArrow(leaving_nothing(_least(fluid, size)), "frame long, least long").toArrow()
        least[found.column("frame").to_numpy()] = found.column("least").to_numpy()
    return rows.mapInArrow(leaving_nothing(_scheduled(fluid, names, least, size)), "name string, block long, release long, due long, slot long, phase int")



def _source(column: str) -> Column:
    """A name for each source that no other has, for null too."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("none"))


def _weighed(sizes: DataFrame, weights: Mapping[str | None, float] | None) -> DataFrame:
    """sizes (name, n) with the target weight of each source."""
    if weights is None:
        return sizes.withColumn("weight", F.pow("n", F.lit(TEMPER)))
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be above zero")
    given = sizes.sparkSession.createDataFrame([("none" if s is None else f"={s}", float(w)) for s, w in weights.items()], "name string, weight double")
    return sizes.join(given, "name", "left").withColumn("weight", F.coalesce("weight", F.lit(float(min(weights.values())))))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, source, block, release, due, slot, place (within the slot), phase, content.

    Without weights, a source's is its number of rows to the power TEMPER. Slots count from 0; phase is the number of sources
    that have run out. content, a hash of key and text, tells rows apart that have one key.
    """
    content = row_name(key, text)
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.md5(whole_text(text))))
    rows = stored(
        docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), _source(source).alias("name"), order.alias("order"), content.alias("content"))
        .withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS)),
        "mix-rows",
    )
    spark = docs.sparkSession
    sizes = _weighed(rows.groupBy("name").agg(F.count("*").alias("n")), weights)
    largest = sizes.orderBy(F.desc("n"), "name").limit(MAX_SOURCES + 1).collect()
    if len(largest) > MAX_SOURCES:
        largest.pop()
        own = F.broadcast(spark.createDataFrame([(r["name"], r["name"]) for r in largest], "name string, own string"))  # MAX_SOURCES rows
        rest = sizes.join(own, "name", "left_anti").agg(F.lit(REST).alias("name"), F.sum("n").alias("n"), F.sum("weight").alias("weight"))
        largest += rest.collect()
        rows = rows.join(own, "name", "left").withColumn("name", F.coalesce("own", F.lit(REST))).drop("own")
    largest.sort(key=lambda r: r["name"])  # of blocks due at once, the earlier name goes first
    fluid = Fluid([-(-r["n"] // BLOCK_ROWS) for r in largest], [r["weight"] for r in largest])
    slots = schedule(spark, [r["name"] for r in largest], fluid, FRAME)

    before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("name", "bucket").count()
    offsets = counts.select("name", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("name", "bucket").orderBy("order", "content"))
    # The rows lie by source and bucket already, for their numbers within.
    ranked = rows.withColumn("within", within).join(offsets, ["name", "bucket"]).withColumn("rank", F.col("offset") + F.col("within") - 1)
    placed = ranked.withColumn("block", F.floor(F.col("rank") / BLOCK_ROWS)).join(slots, ["name", "block"])
    return placed.select("doc_id", "source", "block", "release", "due", "slot", (F.col("rank") % BLOCK_ROWS).alias("place"), "phase", "content")


def in_mixed_order(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, key: str = "doc_id", source: str = "source", text: str = "text", places: bool = False
) -> DataFrame:
    """All rows of docs in the order of the mix: written out, the files in order of name hold the slots in order.

    Spark reads files in another order. With places, the columns of PLACES are added, which any reader can sort by; columns of
    those names that docs has give way to them.
    """
    if places:
        docs = docs.drop(*PLACES)
    mixed = mix(docs, weights, key, source, text).groupBy("content").agg(F.min("slot").alias("slot"), F.min("place").alias("place"))
    rows = packed(docs, content=row_name(key, text)).join(mixed, "content")
    ordered = rows.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return ordered.select(f"{ROW}.*", *(F.col(x).alias(name) for x, name in zip(("slot", "place"), PLACES))) if places else unpacked(ordered.select(ROW))
