"""Signature, duplicate-removal and streaming queries over event sightings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import session
from tidewire.functions import links as fn
from tidewire.functions.dates import fmt_iso
from tidewire.operators import dedup
from tidewire.plans import fixtures as fx
from tidewire.plans.catalog import sqltext as sql
from tidewire.session import fresh_path
from tidewire.sinks.signatures import SignatureStore
from tidewire.sources import payloads as landed
from tidewire.streaming import dedup as stream_dedup, intake

c = F.col
ROWS_PER_FILE, FILES_PER_TRIGGER = 10_000, 100


def sightings(spark, sf):
    rows = fx.derive(spark, sf, fx.SIGHTINGS)
    return rows.withColumn("sig", fn.signature(F.lower(F.trim("name")), c("url")))


def content_hash(spark, sf):
    return fx.derive(spark, sf, fx.SIGHTINGS).select("event_id", fn.content_hash(c("name"), c("ts"), c("url")).alias("hash"))


def dedup_ttl(spark, sf):
    return dedup.dedup_ttl(sightings(spark, sf), "sig").select("event_id", fmt_iso(c("ts")).alias("ts"), "sig")


def dedup_url_title(spark, sf):
    """The rest of the month against the signatures stored on its first day."""
    rows = fx.derive(spark, sf, fx.SIGHTINGS).withColumn("sig", fn.url_title_signature(c("url"), c("name")))
    old = c("ts") < F.lit("2024-01-02").cast("timestamp")
    fresh = dedup.dedup_signatures(rows.where(~old), rows.where(old).select("sig").distinct(), "sig", ["ts", "event_id"])
    return fresh.select("event_id", "sig")


def dedup_store(spark, sf):
    """Three batches by moment, each against what the ones before stored; the last one is run twice."""
    rows = fx.derive(spark, sf, fx.SIGHTINGS).withColumn("sig", fn.url_title_signature(c("url"), c("name")))
    day = F.when(c("ts") < F.lit("2024-01-02").cast("timestamp"), 1).when(c("ts") < F.lit("2024-01-10").cast("timestamp"), 2).otherwise(3)
    store, found = SignatureStore(spark, fresh_path(spark, "signatures")), []
    for batch in (1, 2, 3, 3):
        kept = store.unseen(rows.where(day == batch), "sig", ["ts", "event_id"], batch)
        store.write(kept, "sig", batch)
        found.append(kept.select(F.lit(batch).alias("batch"), "event_id", "sig"))
    return found[0].unionByName(found[1]).unionByName(found[3])


def event_stream(spark, sf, files_per_trigger=1):
    """The events table as a file stream, with moments in UTC."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("ts", c("ts").cast("timestamp"))


def _arrivals(rows):
    """Events arrive 0 to 47 hours after they happen; each 50th carries a moment an hour ahead."""
    late = F.when(c("event_id") % 50 == 49, -1).otherwise(c("event_id") % 48).cast("int")
    return rows.withColumn("arrival_ts", c("ts") + F.make_dt_interval(F.lit(0), late))


def _run(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_fresh(spark, sf):
    session.configure(spark)
    out = session.fresh_path(spark, "stream-fresh")
    admitted = intake.admit_fresh(_arrivals(event_stream(spark, sf))).drop("arrival_ts")
    _run(intake.append_stream(admitted, f"{out}/rows", f"{out}/log"))
    return _shown(spark.read.parquet(f"{out}/rows"))


def _shown(events):
    return events.select("event_id", fmt_iso(c("ts")).alias("ts"), "user_id", "event_type", "value", "props")


def stream_append(spark, sf):
    """Two runs from one checkpoint: the second finds nothing new."""
    session.configure(spark)
    out = session.fresh_path(spark, "stream-append")
    for _ in range(2):
        _run(intake.append_stream(event_stream(spark, sf), f"{out}/rows", f"{out}/log", ["event_type"]))
    return _shown(spark.read.parquet(f"{out}/rows"))


def stream_dedup_ttl(spark, sf):
    """Three time-ordered batches through the streaming form."""
    rows = sightings(spark, sf)
    out = session.fresh_path(spark, "stream-dedup")
    for day in (1, 11, 21):
        low = F.make_date(F.lit(2024), F.lit(1), F.lit(day))
        upper = F.lit("2999-01-01").cast("date") if day == 21 else F.date_add(low, 10)
        lower = F.lit("1900-01-01").cast("date") if day == 1 else low
        part = rows.where((c("ts") >= lower.cast("timestamp")) & (c("ts") < upper.cast("timestamp")))
        part.write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/in")
        _run(stream_dedup.dedup_ttl_stream(stream, f"{out}/store", f"{out}/log", "sig"))
    return stream_dedup.read_kept(spark, f"{out}/store").select("event_id", fmt_iso(c("ts")).alias("ts"), "sig")


def stream_telemetry(spark, sf):
    """All hours: counts of each batch, added up."""
    session.configure(spark)
    out = session.fresh_path(spark, "stream-telemetry")
    _run(intake.count_hours(event_stream(spark, sf), "ts", "event_type", f"{out}/counts", f"{out}/log"))
    return intake.read_hours(spark, f"{out}/counts", "event_type").withColumn("hour", fmt_iso(c("hour")))


def src_stream(spark, sf):
    """Pages as landed payloads, taken in by stream and stored by root domain."""
    session.configure(spark)
    out = session.fresh_path(spark, "src-stream")
    pages = fx.table(spark, sf, "pages")
    pages.select(
        F.lit("web").alias("source_name"), "url", F.lit(200).alias("status"), c("html").alias("body"),
        F.lit(fx.NOW).cast("timestamp").alias("fetched_at"),
    ).write.parquet(f"{out}/in")
    stream = landed.read_payload_stream(spark, f"{out}/in").select("url", "domain", "body")
    _run(intake.append_stream(stream, f"{out}/rows", f"{out}/log", ["domain"]))
    return spark.read.parquet(f"{out}/rows").select("domain", "url", "body")


def sink_checkpoint(spark, sf):
    """Documents stored in files of a fixed number of rows and taken in some files per trigger, over a restart."""
    session.configure(spark)
    out = session.fresh_path(spark, "sink-checkpoint")
    docs = fx.table(spark, sf, "documents")
    schema = docs.schema
    docs.where("doc_id % 2 = 0").write.option("maxRecordsPerFile", ROWS_PER_FILE).mode("append").parquet(f"{out}/in")

    def take_in():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(f"{out}/in")
        _run(intake.append_stream(stream, f"{out}/rows", f"{out}/log"))

    take_in()
    docs.where("doc_id % 2 = 1").write.option("maxRecordsPerFile", ROWS_PER_FILE).mode("append").parquet(f"{out}/in")
    take_in()
    return spark.read.parquet(f"{out}/rows")


QUERIES = {
    "content_hash": content_hash,
    "dedup_ttl": dedup_ttl,
    "dedup_url_title": dedup_url_title,
    "dedup_store": dedup_store,
    "stream_fresh": stream_fresh,
    "stream_append": stream_append,
    "stream_dedup_ttl": stream_dedup_ttl,
    "stream_telemetry": stream_telemetry,
    "src_stream": src_stream,
    "sink_checkpoint": sink_checkpoint,
}

_S = f"({fx.oracle(fx.SIGHTINGS)})"
_SIG = "sha256(concat(lower(trim(name)), chr(31), url))"
_TTL = f"""SELECT event_id, strftime(ts, {sql.ISO}) AS ts, sig FROM (
  SELECT event_id, ts, sig, lag(ts) OVER (PARTITION BY sig ORDER BY ts, event_id) AS before FROM
    (SELECT *, {_SIG} AS sig FROM {_S} AS s)) WHERE before IS NULL OR ts - before > INTERVAL 7 DAYS"""
_LATE = "CASE WHEN event_id % 50 = 49 THEN -1 ELSE event_id % 48 END"
_EVENT = f"event_id, strftime(ts, {sql.ISO}) AS ts, user_id, event_type, value, props"

ORACLES = {
    "content_hash": f"""SELECT event_id, sha256(concat(lower(trim(name)), chr(31), strftime(ts, {sql.ISO}), chr(31), url)) AS hash
      FROM {_S} AS s""",
    "dedup_ttl": _TTL,
    "dedup_url_title": f"""WITH s AS (SELECT event_id, ts, sha256(concat(lower(trim(url)), chr(31), lower(trim(name)))) AS sig FROM {_S} AS raw)
      SELECT event_id, sig FROM (SELECT *, row_number() OVER (PARTITION BY sig ORDER BY ts, event_id) AS nth FROM s
        WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' AND sig NOT IN (SELECT sig FROM s AS old WHERE ts < TIMESTAMP '2024-01-02 00:00:00')) WHERE nth = 1""",
    "dedup_store": f"""SELECT CASE WHEN ts < TIMESTAMP '2024-01-02 00:00:00' THEN 1 WHEN ts < TIMESTAMP '2024-01-10 00:00:00' THEN 2 ELSE 3 END AS batch, event_id, sig
      FROM (SELECT *, row_number() OVER (PARTITION BY sig ORDER BY ts, event_id) AS nth FROM
        (SELECT event_id, ts, sha256(concat(lower(trim(url)), chr(31), lower(trim(name)))) AS sig FROM {_S} AS raw)) WHERE nth = 1""",
    "stream_fresh": f"SELECT {_EVENT} FROM events WHERE {_LATE} BETWEEN 0 AND 24",
    "stream_append": f"SELECT {_EVENT} FROM events",
    "stream_dedup_ttl": _TTL,
    "stream_telemetry": f"SELECT strftime(date_trunc('hour', ts), {sql.ISO}) AS hour, event_type, count(*) AS records FROM events GROUP BY 1, 2",
    "src_stream": r"""SELECT regexp_extract(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '([^.]+\.)?[^.]+$', 0) AS domain, url, html AS body FROM pages""",
    "sink_checkpoint": "SELECT doc_id, text, lang, source, n_chars FROM documents",
}
