"""Removal of passages that stand earlier in the corpus, by merged Burrows-Wheeler transforms.

A byte goes if a string of SPAN bytes covers it that starts earlier, too: in a document before (by key), or before in its own.
Strings are judged on the texts as they came. The work is cut down before any suffix is sorted, always by what can be proved:

1. Of equal texts only the first is looked at; the others go whole (if they have SPAN bytes).
2. window_scan puts equal windows under one anchor. Anchors that the whole corpus has once are done. The runs of windows of the
   others are cut out of their texts; of runs of equal bytes all but the first go, as each of their windows stands earlier.
3. An anchor with different runs (or one that may repeat itself) goes to a bucket of some megabyte. Within a bucket the runs
   are dealt to shards, each shard makes its Burrows-Wheeler transform, and the shards' are merged by refining their interleave
   up to SPAN symbols (see bwt). What is then left are the intervals of suffixes that share SPAN bytes; all but the first of
   each go. An anchor whose runs pass HOT_BYTES is spread over buckets by its windows' hashes, so that no bucket grows
   with the corpus.

Texts are scanned twice rather than stored; what moves are anchors, the runs of shared anchors, and texts that have such runs.
Each step is stored and its shuffle files go then, so the disk holds those of one step at a time.

Null texts count as empty. Documents without a key come last, those that repeat a key with another text stand in order of
their hashes, and rows that repeat key and text are one document and get its result each. An empty table gives no rows. Only
the key and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tidewire.llm.arrow_slices import slices
from tidewire.llm.bwt import END, merged, transform
from tidewire.llm.common import settled, whole_text
from tidewire.llm.keymap import key_map, maybe_in
from tidewire.llm.window_scan import SPAN, scanner, text_bytes
from tidewire.session import dropping_shuffles

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of runs in a bucket, shards of a bucket, and bytes of an anchor's runs beyond which its windows are spread.
BUCKET_BYTES, SHARDS, HOT_BYTES = 1 << 20, 4, 1 << 22


# Texts in order --------------------------------------------------------------------------------------------------------


def _placed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): rows (doc_id, pos, sha, n_bytes, later) of all documents, pos in the documents' order and later telling that an
    equal text stands before; texts (pos, text) of the others. Whole keys that occur once are their own pos."""
    source = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    named = source.select("doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes"))
    rows = settled(named, "passages-rows")
    whole = dict(rows.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    with dropping_shuffles(docs.sparkSession):
        whole = whole and rows.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty()
    if whole:
        rows = rows.withColumn("pos", F.col("doc_id").cast("long"))
        texts = source.select(F.col("doc_id").cast("long").alias("pos"), "text")
    else:
        order = settled(
            rows.select("doc_id", "sha").distinct().orderBy(F.col("doc_id").asc_nulls_last(), "sha").withColumn("pos", F.monotonically_increasing_id()),
            "passages-order").withColumnRenamed("doc_id", "id").withColumnRenamed("sha", "own")
        same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("sha"))
        rows = rows.join(order, same).drop("id", "own")
        texts = settled(
            source.withColumn("sha", F.sha2("text", 256)).join(order, same).select("pos", "text").dropDuplicates(["pos"]), "passages-texts")
    first = rows.groupBy("sha").agg(F.min("pos").alias("first"))
    rows = settled(rows.join(first, "sha").select("doc_id", "pos", "sha", "n_bytes", (F.col("pos") > F.col("first")).alias("later")), "passages-placed")
    later = settled(rows.where("later").select("pos").distinct(), "passages-later")
    marked = texts.withColumn("maybe", maybe_in(key_map(later), F.col("pos")))
    apart = marked.where("maybe").join(later, "pos", "left_anti")
    return rows, marked.where("not maybe").select("pos", "text").unionByName(apart.select("pos", "text"))


# Runs ------------------------------------------------------------------------------------------------------------------

_RUN = "anchor long, pos long, start long, windows int, echo int, h1 long, h2 long, content binary"


def _cutter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, pos, spans) -> a row per span with its bytes and their hash."""
    for batch in slices(batches):
        data, ends = text_bytes(batch.column("text"))
        raw, base = data[ends[0] : ends[-1]].tobytes(), int(ends[0])
        spans = batch.column("spans")
        owner = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        anchor, place = spans.flatten().flatten()
        place = place.to_numpy()
        start, windows, echo = place // 256, place % 256 // 2, place % 2
        begins = ends[owner] - base + start
        stops = begins + windows + SPAN - 1
        content = [raw[a:b] for a, b in zip(begins.tolist(), stops.tolist())]
        hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in content), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [anchor, batch.column("pos").take(pa.array(owner)), pa.array(start), pa.array(windows.astype(np.int32)), pa.array(echo.astype(np.int32)),
             pa.array(np.ascontiguousarray(hashes[:, 0])), pa.array(np.ascontiguousarray(hashes[:, 1])), pa.array(content, pa.binary())],
            ["anchor", "pos", "start", "windows", "echo", "h1", "h2", "content"])


def shared_runs(texts: DataFrame) -> DataFrame:
    """(anchor, pos, start, windows, echo, h1, h2, content) of all runs whose anchor the corpus has more than once."""
    found = texts.mapInArrow(scanner, "anchor long, pos long, place long")
    shared = found.groupBy("anchor").agg(F.sum(F.col("place") % 2 + 1).alias("times")).where("times > 1").select("anchor")
    spans = found.join(settled(shared, "passages-shared"), "anchor").groupBy("pos").agg(F.collect_list(F.struct("anchor", "place")).alias("spans"))
    spans = settled(spans, "passages-spans", compression="zstd")
    cut = texts.join(spans, "pos").select("text", "pos", "spans")
    return cut.mapInArrow(_cutter, _RUN)


# Transforms ------------------------------------------------------------------------------------------------------------

_SHARD = "bucket long, symbols binary, ends binary, sizes binary, pos binary, start binary"
_SPANS = "pos long, begin long, stop long"


def _build(table: pa.Table) -> pa.Table:
    """The transform of a shard's strings, as one row."""
    table = table.combine_chunks()
    data, ends = text_bytes(table.column("content").chunk(0))
    sizes = np.diff(ends)
    symbols = transform(data[ends[0] : ends[-1]], sizes)
    packed = [symbols.astype(np.uint8), np.flatnonzero(symbols == END).astype(np.int32), sizes.astype(np.int32),
              table.column("pos").to_numpy(), table.column("start").to_numpy()]
    names = ("symbols", "ends", "sizes", "pos", "start")
    return pa.table({"bucket": table.column("bucket").slice(0, 1), **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(names, packed)}})


def _joined_spans(pos: np.ndarray, start: np.ndarray) -> pa.Table:
    """Windows that follow each other, as spans."""
    order = np.lexsort((start, pos))
    pos, start = pos[order], start[order]
    fresh = np.flatnonzero(np.concatenate(([True], (pos[1:] != pos[:-1]) | (start[1:] != start[:-1] + 1))) if len(pos) else [])
    last = np.append(fresh[1:], len(pos)) - 1 if len(pos) else fresh
    return pa.table({"pos": pa.array(pos[fresh], pa.int64()), "begin": pa.array(start[fresh], pa.int64()), "stop": pa.array(start[last] + SPAN, pa.int64())})


def _merge(table: pa.Table) -> pa.Table:
    """The windows of a bucket that stand earlier in it, from its shards' transforms."""
    rows = table.to_pylist()
    shards = []
    for row in rows:
        symbols = np.frombuffer(row["symbols"], np.uint8).astype(np.uint16)
        symbols[np.frombuffer(row["ends"], np.int32)] = END
        shards.append((symbols, np.frombuffer(row["sizes"], np.int32).astype(np.int64)))
    interval, string, offset = merged(shards, SPAN)
    pos = np.concatenate([np.frombuffer(row["pos"], np.int64) for row in rows])[string]
    start = np.concatenate([np.frombuffer(row["start"], np.int64) for row in rows])[string] + offset
    order = np.lexsort((start, pos, interval))
    interval = interval[order]
    again = order[1:][interval[1:] == interval[:-1]]
    return _joined_spans(pos[again], start[again])


def repeated_spans(runs: DataFrame) -> DataFrame:
    """(pos, begin, stop) spans that cover all windows of the runs (stored) that stand earlier in them; they may overlap."""
    same = ["anchor", "h1", "h2"]
    classes = settled(
        runs.groupBy(*same).agg(
            F.min(F.struct("pos", "start")).alias("first"), F.count(F.lit(1)).alias("times"), F.max("echo").alias("echo"), F.max("windows").alias("windows")),
        "passages-classes")
    size = F.col("windows").cast("long") + SPAN - 1
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max("echo").alias("echoes"), F.sum(size).alias("bytes"))
    several = several.where("kinds > 1 or echoes > 0").select("anchor", (F.col("bytes") > HOT_BYTES).alias("hot"))
    chosen = settled(classes.join(several, "anchor").select("first.pos", "first.start", "windows", "hot"), "passages-chosen")
    with dropping_shuffles(runs.sparkSession):
        total = chosen.agg(F.sum(F.when(F.col("hot"), F.col("windows") * F.lit(SPAN)).otherwise(size))).first()[0] or 0
    buckets = F.lit(1 + total // BUCKET_BYTES)

    content = runs.select("anchor", "pos", "start", "content").join(chosen, ["pos", "start"])
    single = content.where("not hot").select(F.pmod(F.xxhash64("anchor"), buckets).alias("bucket"), "pos", "start", "content")
    places = content.where("hot").select("anchor", "pos", "start", "content", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("at"))
    windows = places.select("anchor", "pos", (F.col("start") + F.col("at")).alias("start"), F.substr("content", F.col("at") + 1, F.lit(SPAN)).alias("content"))
    spread = windows.select(F.pmod(F.xxhash64("anchor", "content"), buckets).alias("bucket"), "pos", "start", "content")
    strings = single.unionByName(spread).withColumn("shard", F.pmod(F.xxhash64("pos", "start"), F.lit(SHARDS)))
    transforms = strings.groupBy("bucket", "shard").applyInArrow(_build, _SHARD)
    inner = settled(transforms.groupBy("bucket").applyInArrow(_merge, _SPANS), "passages-inner")

    copies = runs.select(*same, "pos", "start", "windows").join(classes.where("times > 1").select(*same, "first"), same)
    copies = copies.where(F.struct("pos", "start") != F.col("first"))
    whole = copies.select("pos", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + SPAN - 1).alias("stop"))
    return inner.unionByName(settled(whole, "passages-copies"))


# Removal ---------------------------------------------------------------------------------------------------------------


def _remover(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, pos, spans) -> (pos, n_removed, n_spans, kept_sha256)."""
    for batch in slices(batches):
        data, ends = text_bytes(batch.column("text"))
        spans = batch.column("spans")
        begin, stop = (x.to_numpy() for x in spans.flatten().flatten())
        cuts = spans.offsets.to_numpy() - spans.offsets[0].as_py()
        found = []
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            order = np.argsort(begin[a:b], kind="stable")
            begins, furthest = begin[a:b][order], np.maximum.accumulate(stop[a:b][order])
            fresh = np.flatnonzero(np.concatenate(([True], begins[1:] > furthest[:-1])))
            starts, stops = begins[fresh], furthest[np.append(fresh[1:], len(begins)) - 1]
            own, kept = data[ends[i] : ends[i + 1]], hashlib.sha256()
            for x, y in zip([0, *stops.tolist()], [*starts.tolist(), len(own)]):
                kept.update(own[x:y])
            found.append((int((stops - starts).sum()), len(starts), kept.hexdigest()))
        removed, number, sha = zip(*found)
        yield pa.RecordBatch.from_arrays([batch.column("pos"), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(sha)], ["pos", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the bytes that stay."""
    rows, texts = _placed(docs, key, text)
    spans = repeated_spans(settled(shared_runs(texts), "passages-runs", compression="zstd"))
    lists = spans.groupBy("pos").agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    cut = texts.join(lists, "pos").select("text", "pos", "spans")
    removed = cut.mapInArrow(_remover, "pos long, n_removed long, n_spans long, kept_sha256 string")
    whole = F.col("later") & (F.col("n_bytes") >= SPAN)
    return rows.join(removed, "pos", "left").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
