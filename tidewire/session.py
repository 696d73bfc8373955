"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators count on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def build_session(app_name: str = "tidewire", master: str | None = None, **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


#: Whole texts that go to a Python worker at a time.
TEXT_ROWS = 500


def text_batches(spark: SparkSession) -> None:
    """Let no more than TEXT_ROWS rows go to a Python worker at a time, where Spark's 10,000 whole texts are tens of MB that the
    executor and the worker both hold. Holds for the session from now on, as frames that operators return run later."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_ROWS:
        spark.conf.set(name, str(TEXT_ROWS))


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs in here go when it ends, where they else stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@cache
def _test_root() -> str:
    return tempfile.mkdtemp(prefix="tidewire-")


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors see: the cluster's setting. Only a local master may do without, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master", ""):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = _test_root()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/tidewire/{label}-{uuid.uuid4().hex}"
