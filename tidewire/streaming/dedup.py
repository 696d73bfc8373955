"""Sliding-term duplicate removal on a stream.

The last sightings of signatures are keyed state that expires by itself (transformWithState with a time to live, in RocksDB
with a changelog). A call for a key costs some milliseconds of Python, so signatures share STATE_GROUPS keys by a hash: a batch
makes at most so many calls however many signatures it brings, and writes the groups that it touches. Before rows are shuffled to
their state, each map task reduces its own to one per signature and bucket of the term's length: the first row and the last
moment, which is all that the rule needs. A signature with a third of the stream thus costs one row per task and bucket.
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewire import fixed_values as fixed

# Executors get these functions with the task: they need numpy, pandas and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What the state needs; they hold while a query starts, which keeps its own copy.
STATE_OPTIONS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Batches without data would follow each other for ever, as the clock may always end something.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
#: Keys that the signatures' state is spread over; a checkpoint keeps to the number it began with.
STATE_GROUPS = 1 << 14
#: Rows travel as JSON, with all digits of their moments.
_JSON = {"timestampFormat": _MICROS + "XXX", "timestampNTZFormat": _MICROS, "ignoreNullFields": "false"}
_DAY = 86_400_000_000


def _reduced(table: pa.Table) -> pa.Table:
    """One row per signature and bucket: the first row by moment and tie, and the last moment."""
    table = table.take(pc.sort_indices(table, sort_keys=[(x, "ascending") for x in ("sig", "bucket", "first", "tie")])).combine_chunks()
    if not table.num_rows:
        return table
    codes = pc.fill_null(table.column("sig").combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    bucket = table.column("bucket").to_numpy()
    leads = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (bucket[1:] != bucket[:-1]))))
    last = np.maximum.reduceat(table.column("last").to_numpy(), leads)
    return table.take(pa.array(leads)).set_column(table.schema.get_field_index("last"), "last", pa.array(last))


def reduce_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task, one per signature and bucket. Rows that have been reduced are reduced again with those that follow, so that
    a task holds little more than its result."""
    held, waiting, rows = None, [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if held is None or rows > held.num_rows:
            held = _reduced(pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches(waiting)]))
            waiting, rows = [], 0
    if waiting:
        held = _reduced(pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches(waiting)]))
    if held is not None:
        yield from held.to_batches()


def chain(before: int | None, reduced: list[tuple], term: int) -> tuple[list[str], int]:
    """(rows that stay, last moment) of one signature, from its last moment before and the reduced rows (bucket, first, tie, last, row)
    of any number of tasks."""
    kept, current = [], None
    for bucket, first, _, last, row in sorted(reduced, key=lambda r: r[:3]):
        if bucket != current and (before is None or first - before > term):
            kept.append(row)
        current = bucket
        before = last if before is None else max(before, last)
    return kept, before


def _tied(tie) -> tuple:
    """What a tie is compared by: null ties come last, as in a task."""
    return (True, 0) if tie is None or tie != tie else (False, tie)


def _processor(term: int, keep_ms: int) -> StatefulProcessor:
    names = ("sig", "bucket", "first", "tie", "last", "row")

    class LastSightings(StatefulProcessor):
        """The state of a group: [signature, last moment, clock when last taken in] of each of its signatures, as JSON.

        A signature's time to live is its own; that of the state ends a group that no batch touches."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.held = handle.getValueState("held", "held string", keep_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
            found = defaultdict(list)
            for part in rows:
                for sig, bucket, first, tie, last, row in zip(*(part[name].tolist() for name in names)):
                    found[sig].append((bucket, first, _tied(tie), last, row))
            now, held = timerValues.getCurrentProcessingTimeInMs(), self.held.get()
            known = {sig: (last, taken) for sig, last, taken in json.loads(held[0]) if taken + keep_ms > now} if held else {}
            stay = []
            for sig, reduced in found.items():
                kept, last = chain(known[sig][0] if sig in known else None, reduced, term)
                known[sig] = (last, now)
                stay += kept
            self.held.update((json.dumps([(sig, last, taken) for sig, (last, taken) in known.items()]),))
            if stay:
                yield pd.DataFrame({"row": stay}, dtype="object")

        def close(self) -> None:
            pass

    return LastSightings()


def _named(stream: DataFrame, signature: str) -> Column:
    """The signature as text, which is what the state holds."""
    return F.hex(signature) if stream.schema[signature].dataType.typeName() == "binary" else F.col(signature).cast("string")


def kept_stream(stream: DataFrame, signature: str, ts: str, tie: str, days: int, keep_days: int) -> DataFrame:
    """The rows of a stream (or, for tests of its parts, a table) that stay, as they came."""
    micros = F.unix_micros(ts)
    slim = stream.select(
        _named(stream, signature).alias("sig"), F.floor(micros / F.lit(days * _DAY)).alias("bucket"), micros.alias("first"), F.col(tie).alias("tie"),
        micros.alias("last"), F.to_json(F.struct(*stream.columns), _JSON).alias("row"))
    kinds = ", ".join(f"{n} {t}" for n, t in slim.dtypes)
    reduced = slim.where("first is not null").mapInArrow(reduce_rows, kinds)
    grouped = reduced.withColumn("part", F.pmod(F.xxhash64("sig"), F.lit(STATE_GROUPS)).cast("int")).groupBy("part")
    rows = grouped.transformWithStateInPandas(_processor(days * _DAY, keep_days * 86_400_000), "row string", "Append", "ProcessingTime")
    return rows.select(F.from_json("row", stream.schema, _JSON).alias("row")).select("row.*")


def _started(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """A query started under the state's options; the session's own stand again afterwards."""
    before = {name: spark.conf.get(name, None) for name in STATE_OPTIONS}
    try:
        for name, value in STATE_OPTIONS.items():
            spark.conf.set(name, value)
        return start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def dedup_ttl_stream(
    stream: DataFrame, path: str, checkpoint: str, signature: str, ts: str = "ts", tie: str = "event_id",
    days: int = fixed.DEDUP_TTL_DAYS, lag_days: int = fixed.DEDUP_TTL_DAYS,
) -> StreamingQuery:
    """Write the kept rows of all available input to path/kept/batch=N; a batch that is repeated overwrites its folder.

    Equals the batch operator when batches arrive in time order. A sighting older than the last one of its signature
    counts as a duplicate; one without a moment is left out. A signature leaves the state when none was taken in for days + lag_days
    by the clock, so rows may arrive up to lag_days later, relative to each other, than they happened.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/kept/batch={batch_id}")

    kept = kept_stream(stream, signature, ts, tie, days, days + lag_days)
    writer = kept.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    return _started(stream.sparkSession, writer.start)


def read_kept(spark: SparkSession, path: str) -> DataFrame | None:
    """Everything kept so far; None before the first batch."""
    try:
        return spark.read.parquet(f"{path}/kept").drop("batch")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
