from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewire.functions import dates
from tidewire.operators import signals

NOW = "2024-01-15 12:00:00"

CASES = [
    ("Mon, 15 Jan 2024 12:00:00 +0000", "2024-01-15T12:00:00Z"),
    ("15 Jan 2024 12:00:00 GMT", "2024-01-15T12:00:00Z"),
    ("Mon, 15 Jan 2024 12:00 EST", "2024-01-15T17:00:00Z"),
    ("Sun, 06 Nov 94 08:49:37 GMT", "1994-11-06T08:49:37Z"),
    ("Mon, 15 Jan 2024 12:00:00 -0530", "2024-01-15T17:30:00Z"),
    ("2024-01-15T12:00:00Z", "2024-01-15T12:00:00Z"),
    ("2024-01-15T12:00:00.25+05:30", "2024-01-15T06:30:00Z"),
    ("2024-01-15 12:00:00", "2024-01-15T12:00:00Z"),
    ("2024-01-15", "2024-01-15T00:00:00Z"),
    ("now", "2024-01-15T12:00:00Z"),
    ("yesterday", "2024-01-14T12:00:00Z"),
    ("3 hours ago", "2024-01-15T09:00:00Z"),
    ("2 weeks ago", "2024-01-01T12:00:00Z"),
    ("January 5, 2024", "2024-01-05T00:00:00Z"),
    ("2024-01-15T10:30Z", "2024-01-15T10:30:00Z"),
    ("20240115", "2024-01-15T00:00:00Z"),
    ("20240115T103000Z", "2024-01-15T10:30:00Z"),
    ("2024-W03-1", "2024-01-15T00:00:00Z"),
    ("2024-01-15T10:30:00,5+02", "2024-01-15T08:30:00Z"),
    ("Mon Jan 15 10:30:00 2024", "2024-01-15T10:30:00Z"),
    ("Mon Jan 15 10:30:00 EST 2024", "2024-01-15T15:30:00Z"),
    ("Jan 15 2024 10:30:00 GMT", "2024-01-15T10:30:00Z"),
    ("15 Jan 2024 10.30.00 GMT", "2024-01-15T10:30:00Z"),
    ("3 months ago", "2023-10-15T12:00:00Z"),
    ("1 year ago", "2023-01-15T12:00:00Z"),
    ("in 2 hours", "2024-01-15T14:00:00Z"),
    ("2 days 3 hours ago", "2024-01-13T09:00:00Z"),
    ("01/15/2024", "2024-01-15T00:00:00Z"),
    ("2024/01/15 9:05 PM", "2024-01-15T21:05:00Z"),
    ("January 5, 2024 12:30 AM", "2024-01-05T00:30:00Z"),
    ("Friday, January 5, 2024 at 1:00 pm EST", "2024-01-05T18:00:00Z"),
    ("2024-13-01", None),
    ("13/45/2024", None),
    ("2 hours", None),
    ("in 2 hours ago", None),
    ("32 Jan 2024 10:00:00 GMT", None),
    ("2024", None),
    ("not a date", None),
    ("", None),
    (None, None),
]


def test_parse_date(column):
    parsed = column(lambda c: dates.fmt_iso(dates.parse_date(c, NOW)), [text for text, _ in CASES])
    assert parsed == [moment for _, moment in CASES]


def test_fresh_bounds_are_inclusive(spark):
    now = datetime(2024, 1, 15, 12)
    offsets = [timedelta(0), timedelta(hours=24), timedelta(seconds=-1), timedelta(hours=24, seconds=1), timedelta(hours=3)]
    rows = spark.createDataFrame([(i, (now - o).isoformat()) for i, o in enumerate(offsets)] + [(9, None)], "i int, t string")
    fresh = signals.fresh_only(rows.withColumn("t", F.col("t").cast("timestamp")), "t", NOW)
    assert sorted(r.i for r in fresh.collect()) == [0, 1, 4]


def test_freshness_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "2024-01-15")], "i int, t string").withColumn("t", F.col("t").cast("timestamp")).write.parquet(path)
    plan = signals.fresh_only(spark.read.parquet(path), "t", NOW)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "LessThanOrEqual(t," in plan


@pytest.mark.parametrize("blank", ["", " ", " \t", None])
def test_drop_blank(spark, blank):
    rows = spark.createDataFrame([(blank,), ("a",)], "n string")
    assert [r.n for r in signals.drop_blank(rows, "n").collect()] == ["a"]


def test_count_by_source_keeps_silent_sources(spark):
    records = spark.createDataFrame([("a",), ("a",), ("x",)], "source_name string")
    registry = spark.createDataFrame([("a",), ("b",)], "source_name string")
    counts = {r.source_name: r.records for r in signals.count_by_source(records, registry).collect()}
    assert counts == {"a": 2, "b": 0}
