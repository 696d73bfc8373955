"""Jobs over landed payloads: python -m tidewire <job> ... (or spark-submit with the same arguments).

papers    --payloads P --links L --repos R --out O [--target N] [--compat]
signals   --payloads P --jobs J --now T --out O
startups  --payloads P --now T --out O [--target N]
mapping   --startups S --products P --out O [--dictionary D] [--threshold X]
stream    --payloads P --out O --checkpoint C

Payloads, links and repos are Parquet folders; records are written as CSV folders with ordered headers. Every batch job writes the
payloads that gave no records, with the reason, to quarantine/<job> under --out. papers, signals and startups also leave
report/<job>: rows of each kind and step of the run, for signals by registered source as well.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire import fixed_values as fixed, model
from tidewire.operators import resolve
from tidewire.operators.counting import RunCounts
from tidewire.plans import records
from tidewire.session import build_session
from tidewire.sinks.files import reuse_or_compute, write_csv
from tidewire.sources import feeds, hub
from tidewire.sources.payloads import feed_format, quarantined, read_payload_stream
from tidewire.sources.tables import csv_column
from tidewire.streaming.intake import append_stream


def set_aside(parsed: DataFrame, args: argparse.Namespace, kind: str, counts: RunCounts) -> None:
    """Write the payloads that could not be read; a new run replaces those of the one before."""
    lot = counts.watch(quarantined(parsed), kind, "quarantined", "source_name" if "source_name" in parsed.columns else None)
    lot.write.mode("overwrite").parquet(f"{args.out}/quarantine/{kind}")


def leave_report(spark: SparkSession, args: argparse.Namespace, counts: RunCounts, job: str) -> None:
    """One small file with the counts of the run."""
    counts.report(spark).coalesce(1).write.mode("overwrite").parquet(f"{args.out}/report/{job}")


def papers(spark: SparkSession, args: argparse.Namespace) -> None:
    payloads, links, repos = (spark.read.parquet(p) for p in (args.payloads, args.links, args.repos))
    counts = RunCounts()
    found = counts.watch(records.papers(payloads, links, repos, args.target, args.compat), "papers", "accepted")
    write_csv(found, "RESEARCH_PAPER", f"{args.out}/research_papers")
    set_aside(feeds.parse_documents(payloads), args, "papers", counts)
    leave_report(spark, args, counts, "papers")


def signals(spark: SparkSession, args: argparse.Namespace) -> None:
    posts, boards = spark.read.parquet(args.payloads), spark.read.parquet(args.jobs)
    counts = RunCounts([name for name, _ in fixed.JOB_FEEDS])
    write_csv(records.news(posts, args.now, counts), "NEWS", f"{args.out}/news")
    write_csv(records.jobs(boards, args.now, counts), "JOB", f"{args.out}/jobs")
    set_aside(feeds.parse_documents(posts), args, "news", counts)
    is_json = feed_format(F.col("url")) == "json"
    parsed = [feeds.parse_jobs(boards.where(is_json)), feeds.parse_documents(boards.where(~is_json))]
    set_aside(parsed[0].drop("doc").unionByName(parsed[1].drop("doc")), args, "jobs", counts)
    leave_report(spark, args, counts, "signals")


def startups(spark: SparkSession, args: argparse.Namespace) -> None:
    """Products already stored in the wanted number are kept as they are; without a target they are always made anew."""
    lists = spark.read.parquet(args.payloads)
    items = records.hub_rows(lists)
    counts = RunCounts()
    set_aside(hub.parse_lists(lists), args, "startups", counts)
    write_csv(counts.watch(records.startups(items, args.now, args.target), "startups", "accepted"), "STARTUP", f"{args.out}/startups")
    products, path = records.products(items, args.now, args.target), f"{args.out}/products"
    if args.target:
        reuse_or_compute(spark, path, "PRODUCT", args.target, lambda: products)
    else:
        write_csv(counts.watch(products, "products", "accepted"), "PRODUCT", path)
    leave_report(spark, args, counts, "startups")


def mapping(spark: SparkSession, args: argparse.Namespace) -> None:
    sources = [
        csv_column(spark, args.startups, "content.entityName"),
        csv_column(spark, args.products, "content.startupName"),
    ]
    dictionary: DataFrame = spark.read.parquet(args.dictionary) if args.dictionary else resolve.dictionary_frame(spark)
    write_csv(records.entity_mapping(sources, dictionary, args.threshold), "ENTITY_MAPPING", f"{args.out}/entity_mapping")


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """News of payload files as they land, each measured against its own arrival."""
    payloads = read_payload_stream(spark, args.payloads)
    flat = model.to_contract(records.news(payloads, F.col("fetched_at")), "NEWS")
    append_stream(flat, f"{args.out}/news", args.checkpoint).awaitTermination()


JOBS = {
    papers: ["payloads", "links", "repos", "out"],
    signals: ["payloads", "jobs", "now", "out"],
    startups: ["payloads", "now", "out"],
    mapping: ["startups", "products", "out"],
    stream: ["payloads", "out", "checkpoint"],
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidewire")
    jobs = parser.add_subparsers(required=True)
    for job, needed in JOBS.items():
        one = jobs.add_parser(job.__name__)
        one.set_defaults(job=job)
        for name in needed:
            one.add_argument(f"--{name}", required=True)
        if job in (papers, startups):
            one.add_argument("--target", type=int)
        if job is papers:
            one.add_argument("--compat", action="store_true")
        if job is mapping:
            one.add_argument("--dictionary")
            one.add_argument("--threshold", type=float, default=fixed.FUZZY_THRESHOLD)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    args.job(spark or build_session(), args)


if __name__ == "__main__":
    main()
