import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from tidewire.operators import dedup, extraction, ranking
from tidewire.sinks.signatures import SignatureStore
from tidewire.streaming import dedup as stream_dedup, intake

START = datetime(2024, 1, 1)


def sightings(spark, seed=1, count=400, days=60):
    """Half of all rows share one signature; several share a moment."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        sig = "hot" if rng.random() < 0.5 else f"s{rng.randrange(40)}"
        rows.append((i, START + timedelta(hours=rng.randrange(days * 24)), sig))
    return spark.createDataFrame(rows, "event_id long, ts timestamp, sig string")


def plain_rule(rows, days=7):
    last, kept = {}, []
    for row in sorted(rows, key=lambda r: (r.ts, r.event_id)):
        if row.sig not in last or row.ts - last[row.sig] > timedelta(days=days):
            kept.append(row.event_id)
        last[row.sig] = row.ts
    return sorted(kept)


@pytest.mark.parametrize("days", [1, 7])
def test_dedup_ttl_equals_plain_rule(spark, days):
    rows = sightings(spark)
    got = sorted(r.event_id for r in dedup.dedup_ttl(rows, "sig", days=days).collect())
    assert got == plain_rule(rows.collect(), days)


def test_dedup_ttl_bound_is_inclusive(spark):
    rows = [(1, START, "a"), (2, START + timedelta(days=7), "a"), (3, START + timedelta(days=14, seconds=1), "a")]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp, sig string")
    assert sorted(r.event_id for r in dedup.dedup_ttl(frame, "sig").collect()) == [1, 3]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_first_per_key_does_not_depend_on_partitions(spark, parts):
    rows = sightings(spark, 2).repartition(parts)
    got = {r.sig: r.event_id for r in dedup.first_per_key(rows, ["sig"], ["ts", "event_id"]).collect()}
    expected = {}
    for row in sorted(rows.collect(), key=lambda r: (r.ts, r.event_id)):
        expected.setdefault(row.sig, row.event_id)
    assert got == expected


def test_hot_keys_shrink_before_the_shuffle(spark):
    first = dedup.first_per_key(sightings(spark), ["sig"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert first.index("WindowGroupLimit") < first.index("Exchange") < first.rindex("WindowGroupLimit")
    ttl = dedup.dedup_ttl(sightings(spark), "sig")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in ttl and "partial_max" in ttl


def test_change_between_equals_lag(spark):
    rows = sightings(spark, 4).withColumn("stars", F.col("event_id") * 7 % 101)
    got = dedup.change_between(rows, "sig", "ts", "event_id", "stars", bucket="day", name="gained")
    lag = F.lag("stars").over(Window.partitionBy("sig").orderBy("ts", "event_id"))
    expected = rows.withColumn("gained", F.col("stars") - lag)
    assert sorted(map(str, got.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_change_between_keeps_rows_without_key(spark):
    rows = spark.createDataFrame([(1, START, None, 5), (2, START + timedelta(days=3), None, 9)], "event_id long, ts timestamp, sig string, stars int")
    got = dedup.change_between(rows, "sig", "ts", "event_id", "stars", name="gained").orderBy("event_id").collect()
    assert [r.gained for r in got] == [None, 4]


def test_signatures_against_store(spark):
    seen = spark.createDataFrame([("s1",), ("hot",)], "sig string")
    got = dedup.dedup_signatures(sightings(spark), seen, "sig", ["ts", "event_id"])
    sigs = [r.sig for r in got.collect()]
    assert len(sigs) == len(set(sigs)) and not {"s1", "hot"} & set(sigs)


def test_pages(spark):
    rows = spark.createDataFrame([(i, START + timedelta(hours=i // 3)) for i in range(50)], "i int, t timestamp")
    order = sorted(((-(i // 3), i) for i in range(50)))
    expected = [i for _, i in order]
    assert [r.i for r in ranking.page_offset(rows, 10, 15, [F.desc("t"), "i"]).collect()] == expected[10:25]
    assert ranking.page_offset(rows, 50, 15, [F.desc("t"), "i"]).collect() == []
    seen, last = [], None
    while page := ranking.page_after(rows, "t", "i", last, 7).collect():
        seen += [r.i for r in page]
        last = (page[-1].t, page[-1].i)
    assert seen == expected


def test_stream_dedup_equals_batch(spark, tmp_path):
    rows = sightings(spark, 5)
    base = str(tmp_path)
    for low, high in ((0, 15), (15, 16), (16, 60)):
        part = rows.where(F.col("ts").between(START + timedelta(days=low), START + timedelta(days=high, microseconds=-1)))
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        stream_dedup.dedup_ttl_stream(stream, f"{base}/store", f"{base}/log", "sig").awaitTermination()
    kept = stream_dedup.read_kept(spark, f"{base}/store")
    assert sorted(r.event_id for r in kept.collect()) == plain_rule(rows.collect())


def test_stream_writes_changes_and_not_all_state(spark, tmp_path):
    """Thirty small batches after a large one, a third of each being one signature: every batch equals the batch rule, and what it
    writes does not follow the number of signatures known."""
    base = str(tmp_path)
    rows = [(i, START + timedelta(hours=i / 1000), f"old{i}", {"k": i}) for i in range(2000)]
    for day in range(30):
        at = START + timedelta(days=1 + day)
        rows += [(10_000 + 100 * day + i, at + timedelta(minutes=i, microseconds=day), "hot" if i % 3 == 0 else f"s{i * (day + 3) % 41}", None) for i in range(60)]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp, sig string, more map<string,int>")
    edges = [START, *(START + timedelta(days=1 + day) for day in range(31))]
    written = []
    for number, (low, high) in enumerate(zip(edges, edges[1:])):
        frame.where(F.col("ts").between(low, high - timedelta(microseconds=1))).coalesce(1).write.parquet(f"{base}/in/part={number}")
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    query = stream_dedup.dedup_ttl_stream(stream, f"{base}/store", f"{base}/log", "sig")
    query.awaitTermination()
    kept = stream_dedup.read_kept(spark, f"{base}/store")
    assert sorted(r.event_id for r in kept.collect()) == plain_rule(frame.drop("more").collect())
    assert kept.schema == frame.schema and kept.where("more['k'] = event_id").count() == 2000
    import glob
    import os
    sizes = {}
    for name in glob.glob(f"{base}/log/state/0/*/*.changelog"):
        batch = int(os.path.basename(name).split(".")[0].split("_")[0])
        sizes[batch] = sizes.get(batch, 0) + os.path.getsize(name)
    written = [sizes[b] for b in sorted(sizes)]
    assert len(written) >= 31 and max(written[1:31]) < written[0] / 5


def test_signatures_share_a_bounded_number_of_state_keys(spark, tmp_path, monkeypatch):
    """Three batches of 400 signatures and null through four keys: the batch rule's rows, and no more calls than keys."""
    monkeypatch.setattr(stream_dedup, "STATE_GROUPS", 4, raising=False)
    rows = [(i, START + timedelta(hours=i % 1000, microseconds=i % 7), None if i % 50 == 0 else f"s{i * i % 401}") for i in range(1200)]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp, sig string")
    base = str(tmp_path)
    for number, (low, high) in enumerate(((0, 9), (9, 18), (18, 90))):
        frame.where(F.col("ts").between(START + timedelta(days=low), START + timedelta(days=high, microseconds=-1))).coalesce(1).write.parquet(f"{base}/in/part={number}")
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    query = stream_dedup.dedup_ttl_stream(stream, f"{base}/store", f"{base}/log", "sig")
    query.awaitTermination()
    kept = stream_dedup.read_kept(spark, f"{base}/store")
    assert sorted(r.event_id for r in kept.collect()) == plain_rule(frame.collect())
    assert all(0 < state.numRowsTotal <= 4 for step in query.recentProgress for state in step.stateOperators)


def test_a_signature_expires_by_itself_in_a_shared_key():
    import pandas as pd

    class State:
        value = None
        get = lambda self: self.value
        update = lambda self, value: setattr(self, "value", value)

    state, clock = State(), {"now": 0}
    handle = type("Handle", (), {"getValueState": lambda self, name, schema, ttl: state})()
    timers = type("Timers", (), {"getCurrentProcessingTimeInMs": lambda self: clock["now"]})()
    processor = stream_dedup._processor(100, 50)
    processor.init(handle)

    def run(now, *rows):
        clock["now"] = now
        part = pd.DataFrame(rows, columns=["sig", "bucket", "first", "tie", "last", "row"])
        return [text for out in processor.handleInputRows((1,), iter([part]), timers) for text in out["row"]]

    assert run(0, ("a", 0, 10, 2, 10, "a2"), ("a", 0, 10, 1, 10, "a1"), (None, 0, 5, 1, 9, "n")) == ["a1", "n"]
    assert run(30, ("b", 0, 20, 1, 20, "b"), (None, 0, 50, 1, 50, "n2")) == ["b"]
    assert run(49, ("a", 0, 60, 1, 60, "known")) == []
    assert run(80, ("b", 0, 21, 1, 21, "forgotten"), ("a", 0, 61, 1, 61, "known")) == ["forgotten"]
    assert "null" not in state.value[0]  # the signature without a name went 50 ms after it was last taken in


def test_a_task_sends_one_row_per_signature_and_bucket():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({
        "sig": ["a", None, "a", "b"], "bucket": [0, 0, 0, 1], "first": [5 - i, 7, 9, 3], "tie": [1, 1, 1, 1], "last": [5 - i, 7, 9, 3], "row": [f"a{i}", "n", "x", "b"]})
        for i in range(4)]
    found = pa.Table.from_batches(list(stream_dedup.reduce_rows(batches))).to_pylist()
    assert sorted((str(r["sig"]), r["bucket"], r["first"], r["last"], r["row"]) for r in found) == [
        ("None", 0, 7, 7, "n"), ("a", 0, 2, 9, "a3"), ("b", 1, 3, 3, "b")]
    assert list(stream_dedup.reduce_rows([])) == []


def test_store_without_batches(spark):
    assert read_none(spark)


def read_none(spark):
    return stream_dedup.read_kept(spark, "/tmp/tidewire-no-such-store") is None


def test_stream_admits_fresh_and_appends_once(spark, tmp_path):
    rows = sightings(spark, 7).withColumn("arrival_ts", F.col("ts") + F.make_dt_interval(F.lit(0), (F.col("event_id") % 30).cast("int")))
    base = str(tmp_path)
    rows.write.parquet(f"{base}/in")
    for _ in range(2):
        stream = intake.admit_fresh(spark.readStream.schema(rows.schema).parquet(f"{base}/in"))
        intake.append_stream(stream, f"{base}/out", f"{base}/log").awaitTermination()
    got = sorted(r.event_id for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [i for i in range(400) if i % 30 <= 24]


def attempts(spark, *rows):
    return spark.createDataFrame([(*r, f"p{i}") for i, r in enumerate(rows)], "doc_id int, tier int, attempt int, status int, payload string")


def test_first_success_rules(spark):
    rows = attempts(
        spark,
        (1, 1, 1, 429), (1, 1, 2, 413), (1, 1, 3, 200),  # third attempt of the tier still counts
        (2, 1, 1, 429), (2, 1, 2, 429), (2, 1, 3, 429), (2, 1, 4, 200), (2, 2, 5, 200),  # the fourth does not
        (3, 1, 1, 500), (3, 1, 2, 200), (3, 3, 3, 200),  # a fatal status ends its tier
        (4, 1, 1, 500), (4, 2, 2, 429), (4, 3, 3, 413),  # exhausted
        (5, 2, 1, 200), (5, 1, 9, 200),  # tiers go before attempts
    )
    outcomes = extraction.select_first_success(rows)
    assert {r.doc_id: (r.tier, r.attempt, r.payload) for r in outcomes.collect()} == {
        1: (1, 3, "p2"), 2: (2, 5, "p7"), 3: (3, 3, "p10"), 4: (None, None, None), 5: (1, 9, "p15"),
    }
    extracted, exhausted = extraction.split_outcomes(outcomes)
    assert extracted.count() == 4 and [r.doc_id for r in exhausted.collect()] == [4]


def test_validate_payloads(spark):
    full = '{"source_name":"s","source_url":"u","entityName":"e","employeeCount":3,"collectedAt":"c","more":1}'
    texts = [full, full.replace(',"employeeCount":3', ""), full.replace('"entityName":"e",', ""), "{oops", "", None, full.replace("3", '"many"')]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, payload string")
    got = {r.i: r for r in extraction.validate_payloads(frame).collect()}
    assert [got[i].reason for i in range(7)] == [None, None, "missing entityName", "corrupt", "corrupt", "corrupt", "corrupt"]
    assert got[0].record.employeeCount == 3 and got[1].record.employeeCount is None and got[3].record is None
    assert got[0].record.schemaVersion == "1.0" and got[0].record.recordType == "STARTUP"


def test_signature_store_is_read_by_the_next_run(spark, tmp_path):
    store = SignatureStore(spark, f"{tmp_path}/seen")
    batch = lambda *rows: spark.createDataFrame(list(rows), "id long, sig string")

    def run(rows, number):
        kept = store.unseen(rows, "sig", ["id"], number)
        store.write(kept, "sig", number)
        return sorted((r.id, r.sig) for r in kept.collect() if r.sig is not None), sum(r.sig is None for r in kept.collect())

    first = batch((1, "a"), (2, "b"), (3, "a"), (4, None))
    assert run(first, 1) == ([(1, "a"), (2, "b")], 1)
    second = batch((5, "b"), (6, "c"), (7, None), (8, "c"))
    for _ in range(2):  # a batch that is run again finds and stores the same
        assert run(second, 2) == ([(6, "c")], 1)
        assert sorted(r.sig for r in store.stored(9).collect()) == ["a", "b", "c"]
    assert run(first, 1) == ([(1, "a"), (2, "b")], 1)
    assert run(batch().limit(0), 3) == ([], 0)
    assert run(batch((9, "a"), (10, "d")), 4) == ([(10, "d")], 0)


def test_a_look_up_reads_only_the_shards_asked_for(spark, tmp_path):
    store = SignatureStore(spark, f"{tmp_path}/seen")
    store.write(spark.range(5000).selectExpr("concat('s', id) AS sig"), "sig", 1)
    spark.createDataFrame([(1, "s17"), (2, "new")], "id long, sig string").write.parquet(f"{tmp_path}/asked")
    found = store.seen(spark.read.parquet(f"{tmp_path}/asked").where("id > 0").select("sig"), 2)
    assert [r.sig for r in found.collect()] == ["s17"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
