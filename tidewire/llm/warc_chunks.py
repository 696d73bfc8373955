"""WARC archives through a table of record chunks.

A payload becomes rows of record id and chunk number; each row carries the SHA-1 of all bytes up to its end, so that writer
and reader hold one chunk and one digest state at a time, never a whole record beyond its input row. Chunks are stored as
WARC segments: the first in the record itself, the others in "continuation" records. Spark's text source writes and reads
the archives (gzip, or plain and then splittable): each text row is one segment, and what lies between two segments is the
source's line separator. A payload that would show this separator is cut inside it, so payloads may hold anything.

Null payloads count as empty. Record ids may repeat or be null: rows are told apart by a number of their own. Payloads of
at least MIN_SHARED bytes that equal each other (SHA-256) are stored once, under the largest id; the others revisit it.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a chunk at most, and the least size of payloads that are stored once.
CHUNK_BYTES = 1 << 16
MIN_SHARED = 1000
#: First line of a record, what closes a record, and what therefore lies between two.
_VERSION, _CLOSE = b"WARC/1.1\r\n", b"\r\n\r\n"
_BETWEEN = _CLOSE + _VERSION

_CHUNKS = "record_id string, page_id long, url string, record_type string, refers_to long, payload_bytes long, chunk int, last boolean, running_sha1 string, data binary"
_DIGESTS = "record_id string, payload_bytes long, payload_digest string, complete boolean"


def cut_points(payload: bytes, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of the chunks: at most size bytes each, no separator inside or with the header's end. One empty chunk if empty."""
    at = 0
    while True:
        end = min(at + size, len(payload))
        seen = (_CLOSE + payload[at : at + len(_BETWEEN)]).find(_BETWEEN)
        if seen < 0:
            seen = payload.find(_BETWEEN, at, end)
            seen = seen - at + len(_CLOSE) if seen >= 0 else -1
        if seen >= 0:  # the cut comes behind the version's first letter
            end = min(end, at + seen + 1)
        yield at, end
        at = end
        if at >= len(payload):
            return


def _chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, held = [], 0
        for row in _rows(batch):
            payload = (row.pop("html") or "").encode()
            digest, row["payload_bytes"] = hashlib.sha1(), len(payload)
            if row["record_type"] == "revisit":  # stores nothing, but knows the digest of its payload
                digest.update(payload)
                rows.append(row | {"chunk": 0, "last": True, "running_sha1": digest.hexdigest(), "data": b""})
                continue
            for number, (start, end) in enumerate(cut_points(payload)):
                digest.update(payload[start:end])
                rows.append(row | {"chunk": number, "last": end == len(payload), "running_sha1": digest.hexdigest(), "data": payload[start:end]})
                held += end - start
                if held > 64 * CHUNK_BYTES:
                    yield _batch(rows, _CHUNK_SCHEMA)
                    rows, held = [], 0
        yield _batch(rows, _CHUNK_SCHEMA)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_CHUNK_SCHEMA = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("running_sha1", pa.string()), ("data", pa.binary())])
_DIGEST_SCHEMA = pa.schema([("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("complete", pa.bool_())])


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """record_id, page_id, url, record_type, refers_to, html: what is stored for each row. Payloads move once."""
    numbered = stored(
        pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("html"))
        .select("page_id", F.sha2("html", 256).alias("content"), F.octet_length("html").alias("size"), F.xxhash64("url").alias("url_hash"))
        .groupBy("page_id", "url_hash", "content", "size").agg(F.count(F.lit(1)).alias("times")),
        "warc-keys",
    )
    keepers = numbered.where(f"size >= {MIN_SHARED}").groupBy("content").agg(F.max("page_id").alias("keep"))
    shared = F.when(F.col("size") >= MIN_SHARED, F.col("content")).otherwise(F.concat_ws(" ", F.lit("small"), "page_id", "url_hash"))
    known = numbered.withColumn("shared", shared).join(keepers.withColumnRenamed("content", "shared"), "shared", "left")
    revisit = F.col("page_id") < F.col("keep")
    typed = known.select(
        F.col("page_id").alias("id"), "url_hash", "content", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keep")).alias("refers_to"))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("html"))
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.xxhash64("url") == F.col("url_hash")) & (F.sha2("html", 256) == F.col("content"))
    number = F.format_string("%d-%d", F.spark_partition_id(), F.monotonically_increasing_id())
    return rows.join(typed, same).select(
        F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), number).alias("record_id"),
        "page_id", "url", "record_type", "refers_to", "html")


def chunk_table(records: DataFrame) -> DataFrame:
    """Rows of record and chunk number with the running digest, from plan_records."""
    return records.mapInArrow(_chunked, _CHUNKS)


def write_archives(chunks: DataFrame, folder: str, compression: str = "gzip") -> None:
    """The chunk rows as WARC segments, into files of the folder."""
    first = F.col("chunk") == 0
    def header(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")
    segment = F.concat(F.col("record_id"), F.lit("/"), F.col("chunk").cast("string"))
    split = ~(first & F.col("last"))
    head = F.concat(
        F.lit("WARC-Type: "), F.when(first, F.col("record_type")).otherwise("continuation"), F.lit("\r\n"),
        header("WARC-Record-ID", F.concat(F.lit("<"), F.when(first, F.col("record_id")).otherwise(segment), F.lit(">"))),
        header("WARC-Page-ID", F.when(first, F.col("page_id"))),
        header("WARC-Target-URI", F.when(first, F.regexp_replace("url", r"[\r\n]+", " "))),
        header("WARC-Refers-To-Page", F.col("refers_to")),
        header("WARC-Segment-Origin-ID", F.when(~first, F.concat(F.lit("<"), F.col("record_id"), F.lit(">")))),
        header("WARC-Segment-Number", F.when(split, F.col("chunk") + 1)),
        header("WARC-Segment-Total-Length", F.when(split & F.col("last"), F.col("payload_bytes"))),
        header("WARC-Payload-Bytes", F.when(F.col("record_type") == "revisit", F.col("payload_bytes"))),
        header("WARC-Payload-Digest", F.when(F.col("last"), F.concat(F.lit("sha1:"), F.col("running_sha1")))),
        header("Content-Length", F.octet_length("data")), F.lit("\r\n"))
    body = F.concat(F.encode(F.concat(F.lit(_VERSION.decode()), head), "UTF-8"), F.col("data")).cast("string")
    chunks.select(body.alias("value")).write.option("lineSep", _CLOSE.decode()).option("compression", compression).text(folder)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """One row per segment of the archives: record_id, chunk, last, page_id, url, record_type, refers_to, stated, digest, data."""
    raw = spark.read.option("lineSep", _BETWEEN.decode()).text(folder)
    lines = raw.select(F.substring("value", F.lit(1), F.instr("value", "\r\n\r\n") + 1).alias("head"), F.col("value").cast("binary").alias("raw"))
    def field(name):
        found = F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)
        return F.when(found != "", found)
    number, origin = field("WARC-Segment-Number").cast("int"), field("WARC-Segment-Origin-ID")
    length = field("Content-Length").cast("int")
    data = F.substring("raw", F.octet_length("head") + 3, length)  # a file's last record is followed by closing lines
    return lines.select(
        F.translate(F.coalesce(origin, field("WARC-Record-ID")), "<>", "").alias("record_id"), F.coalesce(number - 1, F.lit(0)).alias("chunk"),
        field("WARC-Payload-Digest").isNotNull().alias("last"), field("WARC-Page-ID").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"), field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
        F.coalesce(field("WARC-Segment-Total-Length"), field("WARC-Payload-Bytes")).cast("long").alias("stated_bytes"),
        F.substring(field("WARC-Payload-Digest"), 6, 40).alias("stated_digest"), length.alias("content_length"), data.alias("data"))


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each record from its chunks, which come in order: one digest state is carried along."""
    name, digest, size, expected, good = None, hashlib.sha1(), 0, 0, True
    for batch in batches:
        done = []
        for row in _rows(batch):
            if row["record_id"] != name:
                if name is not None:
                    done.append({"record_id": name, "payload_bytes": size, "payload_digest": digest.hexdigest(), "complete": False})
                name, digest, size, expected, good = row["record_id"], hashlib.sha1(), 0, 0, True
            digest.update(row["data"])
            size += len(row["data"])
            good, expected = good and row["chunk"] == expected, expected + 1
            if row["last"]:
                found = digest.hexdigest()
                done.append({"record_id": name, "payload_bytes": size, "payload_digest": found, "complete": good and found == row["stated_digest"]})
                name = None
        yield _batch(done, _DIGEST_SCHEMA)
    if name is not None:
        yield _batch([{"record_id": name, "payload_bytes": size, "payload_digest": digest.hexdigest(), "complete": False}], _DIGEST_SCHEMA)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, complete.

    Digests are worked out anew from the stored bytes; complete says that they agree with what was stated and that no
    segment lacks. Revisits carry the size and digest that the archive states. Only segmented records are shuffled.
    """
    segments = read_segments(spark, folder)
    alone = segments.where("chunk = 0 and last").select(
        "page_id", "url", "record_type", "refers_to",
        F.when(F.col("record_type") == "revisit", F.col("stated_bytes")).otherwise(F.octet_length("data")).cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("stated_digest")).otherwise(F.sha1("data")).alias("payload_digest"),
        F.col("stated_digest"), (F.octet_length("data") == F.col("content_length")).alias("whole"))
    single = alone.withColumn("complete", F.col("whole") & (F.col("payload_digest") == F.col("stated_digest"))).drop("whole", "stated_digest")
    parts = segments.where("chunk > 0 or not last")
    ordered = parts.select("record_id", "chunk", "last", "stated_digest", "data").repartition("record_id").sortWithinPartitions("record_id", "chunk")
    digests = ordered.mapInArrow(_digested, _DIGESTS)
    heads = parts.where("chunk = 0").select("record_id", "page_id", "url", "record_type", "refers_to")
    return single.unionByName(heads.join(digests, "record_id").drop("record_id"))
