from datetime import datetime

from pyspark.sql import functions as F

from tests.test_sources import ATOM, JOBS, NOW, RSS, landed
from tidewire.__main__ import main
from tidewire.sources.tables import read_csv


def store(frame, path):
    moment = F.lit(datetime.strptime(NOW, "%Y-%m-%d %H:%M:%S")).cast("timestamp")
    frame.withColumn("fetched_at", moment).write.parquet(path)
    return path


def test_signals_papers_and_stream(spark, tmp_path):
    base = str(tmp_path)
    news = store(landed(spark, RSS, ATOM), f"{base}/in-news")
    jobs = store(landed(spark, JOBS, "broken", url="https://b/api/x"), f"{base}/in-jobs")
    main(["signals", "--payloads", news, "--jobs", jobs, "--now", NOW, "--out", base], spark)
    assert read_csv(spark, f"{base}/news").count() == 4
    assert spark.read.parquet(f"{base}/quarantine/news").count() == 0
    assert [(r.body, r.reason) for r in spark.read.parquet(f"{base}/quarantine/jobs").collect()] == [("broken", "unreadable")]
    assert {r["content.is_remote"] for r in read_csv(spark, f"{base}/jobs").collect()} == {"True"}

    report = {(r.kind, r.step): r.rows for r in spark.read.parquet(f"{base}/report/signals").where("source is null").collect()}
    assert (report["news", "accepted"], report["news", "quarantined"], report["jobs", "quarantined"]) == (4, 0, 1)
    assert report["jobs", "accepted"] == read_csv(spark, f"{base}/jobs").count()
    for kind in ("news", "jobs"):
        assert report[kind, "items"] == report[kind, "accepted"] + report[kind, "rejected"]

    for _ in range(2):
        main(["stream", "--payloads", news, "--out", f"{base}/live", "--checkpoint", f"{base}/log"], spark)
    live = spark.read.parquet(f"{base}/live/news")
    batch = read_csv(spark, f"{base}/news")
    assert sorted(r["content.title"] for r in live.collect()) == sorted(r["content.title"] or "" for r in batch.collect())

    spark.createDataFrame([("2401.00002", 1, "https://github.com/own/two")], "arxiv_id string, rank int, repository_url string").write.parquet(f"{base}/links")
    spark.createDataFrame([("own1", "repo-1", 5)], "owner string, repo string, stars long").write.parquet(f"{base}/repos")
    main(["papers", "--payloads", news, "--links", f"{base}/links", "--repos", f"{base}/repos", "--out", base], spark)
    assert [(r.step, r.rows) for r in spark.read.parquet(f"{base}/report/papers").collect()] == [("accepted", 2), ("quarantined", 0)]
    rows = {r["content.paper_url"]: (r["content.github_url"], r["content.github_stars"]) for r in read_csv(spark, f"{base}/research_papers").collect()}
    assert rows == {
        "http://arxiv.org/abs/2401.00001v2": ("https://github.com/own1/repo-1", "5"),
        "http://arxiv.org/abs/2401.00002v1": ("https://github.com/own/two", "0"),
    }


def test_startups_and_mapping(spark, tmp_path):
    base = str(tmp_path)
    body = '[{"id":"open-ai/m","downloads":20000,"likes":1},{"id":"groq/x","author":"groq"},{"id":"solo"}]'
    lists = store(landed(spark, body, url="https://h/api/models"), f"{base}/in")
    main(["startups", "--payloads", lists, "--now", NOW, "--out", base], spark)
    main(["mapping", "--startups", f"{base}/startups", "--products", f"{base}/products", "--out", base], spark)
    report = {(r.kind, r.step): r.rows for r in spark.read.parquet(f"{base}/report/startups").collect()}
    stored = {kind: read_csv(spark, f"{base}/{kind}").count() for kind in ("startups", "products")}
    assert report == {("startups", "quarantined"): 0, ("startups", "accepted"): stored["startups"], ("products", "accepted"): stored["products"]}
    rows = {r.raw_name: (r.canonical_name, r.match_type) for r in read_csv(spark, f"{base}/entity_mapping").collect()}
    assert len(rows) == 11 + 3
    assert rows["Open Ai"] == ("OpenAI", "FUZZY")
    assert rows["Groq"] == ("Groq", "EXACT") and rows["Independent"] == ("Independent", "FALLBACK")
