import pytest
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed, model
from tidewire.plans import records
from tidewire.sources import feeds, hub, payloads, tables
from tidewire.sinks import files

NOW = "2024-01-15 12:00:00"

RSS = """<?xml version="1.0"?><rss><channel><title>Feed</title>
<item><title> First
  item &amp; more </title><link>https://n/1</link><pubDate>Mon, 15 Jan 2024 11:00:00 +0000</pubDate></item>
<item><title><![CDATA[<b>Bold</b>]]></title><pubDate> Mon, 15 Jan 2024 12:00:01 GMT </pubDate></item>
<item><title>Old</title><link>https://n/3</link><pubDate>Sun, 14 Jan 2024 11:59:59 GMT</pubDate></item>
<item><title>Acme: Data: Lead</title><link>https://n/4</link><pubDate>2024-01-14T12:00:00Z</pubDate></item>
</channel></rss>"""

ATOM = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
<entry><id>http://arxiv.org/abs/2401.00001v2</id><title type="html">On  x</title><published>2024-01-15T10:00:00Z</published>
<updated>2024-01-01T00:00:00Z</updated><link rel="alternate" href="https://n/a"/><link rel="self" href="https://n/b"/>
<author><name>A B</name></author><author><name> C </name></author><author><name/></author>
<summary>Text with https://github.com/own1/repo-1.git</summary><arxiv:comment>c</arxiv:comment></entry>
<entry><id> http://arxiv.org/abs/2401.00002v1 </id><updated>2024-01-15T09:00:00Z</updated><summary>none</summary></entry>
</feed>"""

JOBS = '{"jobs":[{"company_name":"Co","title":"ML Engineer","publication_date":"2024-01-15T10:00:00","x":1},' \
    '{"title":"Scientist","publication_date":"","pubDate":"Mon, 15 Jan 2024 10:00:00 GMT"},' \
    '{"company_name":"","title":null,"pubDate":"2024-01-15"},{"company_name":"Late","pubDate":"nope"}]}'


def landed(spark, *bodies, url="https://feed/rss"):
    rows = [(i, f"s{i}", url, 200, body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "src_rank int, source_name string, url string, status int, body string")


def test_feed_items_of_both_shapes(spark):
    got = feeds.feed_items(landed(spark, RSS, ATOM)).orderBy("src_rank", "item_pos").collect()
    assert [(r.title, r.link, r.pub_str) for r in got] == [
        ("First item & more", "https://n/1", "Mon, 15 Jan 2024 11:00:00 +0000"),
        ("<b>Bold</b>", "", "Mon, 15 Jan 2024 12:00:01 GMT"),
        ("Old", "https://n/3", "Sun, 14 Jan 2024 11:59:59 GMT"),
        ("Acme: Data: Lead", "https://n/4", "2024-01-14T12:00:00Z"),
        ("On x", "https://n/a", "2024-01-15T10:00:00Z"),
        ("", "", "2024-01-15T09:00:00Z"),
    ]


def test_rss_items_with_atom_elements(spark):
    body = (
        '<rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><atom:link href="https://n/self"/><item><title>A</title>'
        '<atom:link href="https://n/1"/><atom:updated>2024-01-15</atom:updated></item>'
        '<item><link>https://n/2</link><atom:link href="https://n/x"/><pubDate/><atom:updated>2024-01-15</atom:updated></item></channel></rss>'
    )
    got = feeds.feed_items(landed(spark, body)).orderBy("item_pos").collect()
    assert [(r.title, r.link, r.pub_str) for r in got] == [("A", "https://n/1", "2024-01-15"), ("", "https://n/2", "")]


def test_items_at_any_depth_in_document_order(spark):
    body = (
        '<rss xmlns:at="http://www.w3.org/2005/Atom"><item><title>beside</title></item><channel><item id="a>b"><title>in</title></item>'
        '<!-- <item><title>hidden</title></item> --><x><y><item><at:title>deep</at:title><at:updated>2024-01-15</at:updated></item></y></x>'
        '<note><![CDATA[<item><title>quoted</title></item>]]></note><item/><items>no</items>'
        '<item><title><![CDATA[a </item> & <b>]]></title></item ></channel><item><title>after</title></item></rss>'
    )
    got = feeds.feed_items(landed(spark, body, "<rss><channel/></rss>", "", None)).orderBy("item_pos").collect()
    assert [(r.src_rank, r.item_pos, r.title) for r in got] == [
        (0, 0, "beside"), (0, 1, "in"), (0, 2, "deep"), (0, 3, ""), (0, 4, "a </item> & <b>"), (0, 5, "after")]
    assert got[2].pub_str == "2024-01-15"
    many = "<rss><channel>" + "<item><title>t<b/></title></item>" * 5000 + "<item><title>" + "x" * 300_000 + "</title></item></channel></rss>"
    assert feeds.feed_items(landed(spark, many)).count() == 5001
    assert [r.title for r in feeds.rss_jobs(landed(spark, body)).orderBy("item_pos").collect()][:2] == ["beside", "in"]


def test_every_payload_is_read_or_set_aside(spark):
    lots = {
        feeds.parse_documents: [RSS, ATOM, RSS[:-9], "", None, "<rss><channel><item></channel></rss>"],
        feeds.parse_jobs: [JOBS, '{"jobs":[]}', JOBS[:-4], " ", None],
        hub.parse_lists: ["[]", '[{"id":"a/b"}]', '[{"id":"a', '{"error":1}', None],
    }
    for parse, bodies in lots.items():
        parsed = parse(landed(spark, *bodies))
        good, _ = payloads.split_corrupt(parsed)
        assert sorted(r.src_rank for r in good.collect()) == [0, 1], parse
        aside = {r.src_rank: r.reason for r in payloads.quarantined(parsed).collect()}
        assert set(aside) == set(range(2, len(bodies))) and aside[len(bodies) - 1] in ("empty", "unreadable")
        failed = payloads.quarantined(parse(landed(spark, bodies[0]).withColumn("status", F.lit(503)))).first()
        assert failed.reason == "failed" and failed.body == bodies[0]


def test_atom_papers(spark):
    got = feeds.atom_papers(landed(spark, ATOM)).orderBy("item_pos").collect()
    assert [(r.title, r.authors, r.paper_url, r.published, r.comment) for r in got] == [
        ("On x", "A B, C", "http://arxiv.org/abs/2401.00001v2", "2024-01-15T10:00:00Z", "c"),
        ("", "", "http://arxiv.org/abs/2401.00002v1", "", ""),
    ]


def test_atom_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ATOM)
    got = feeds.read_atom_files(spark, str(tmp_path)).orderBy("paper_url").collect()
    assert [(r.title, r.authors, r.comment) for r in got] == [("On x", "A B, C", "c"), ("", "", "")]


def test_bad_document_is_set_aside(spark):
    parsed = feeds.parse_documents(landed(spark, RSS, RSS[:-20], "", ATOM))
    good, bad = payloads.split_corrupt(parsed)
    assert sorted(r.src_rank for r in good.collect()) == [0, 3]
    assert sorted(r.src_rank for r in bad.collect()) == [1, 2]
    assert feeds.feed_items(landed(spark, RSS[:-20], ATOM)).count() == 2


def test_news_records(spark):
    rows = records.news(landed(spark, RSS, ATOM).withColumn("status", F.lit(200)), NOW)
    flat = model.to_contract(rows, "NEWS").orderBy("`content.title`").collect()
    assert [(r["content.title"], r["source.url"], r["content.published_date"]) for r in flat] == [
        ("", "https://feed/rss", "2024-01-15T09:00:00Z"),
        ("Acme: Data: Lead", "https://n/4", "2024-01-14T12:00:00Z"),
        ("First item & more", "https://n/1", "2024-01-15T11:00:00Z"),
        ("On x", "https://n/a", "2024-01-15T10:00:00Z"),
    ]
    assert {r["collectedAt"] for r in flat} == {"2024-01-15T12:00:00Z"}


def test_job_records(spark):
    boards = landed(spark, JOBS, "broken", url="https://b/api/x").unionByName(landed(spark, RSS, ATOM, url="https://b/rss"))
    flat = model.to_contract(records.jobs(boards, NOW), "JOB").collect()
    assert sorted((r["content.company"], r["content.role_family"], r["content.date"]) for r in flat) == [
        ("", "Data & AI", "2024-01-15T00:00:00Z"),
        ("AI Enterprise", "AI Research", "2024-01-15T10:00:00Z"),
        ("AI Startup", "Engineering", "2024-01-15T11:00:00Z"),
        ("Acme", "Engineering", "2024-01-14T12:00:00Z"),
        ("Co", "Engineering", "2024-01-15T10:00:00Z"),
    ]


def test_failed_payloads_are_left_out(spark):
    rows = landed(spark, RSS, ATOM).withColumn("status", F.when(F.col("src_rank") == 0, 500).otherwise(200))
    assert [r.src_rank for r in payloads.ok_payloads(rows).collect()] == [1]


def test_registry_formats(spark):
    formats = [r.format for r in payloads.registry_frame(spark, fixed.JOB_FEEDS).orderBy("rank").collect()]
    assert formats == ["json", "json", "json", "rss", "rss"]


def test_hub_defaults(spark, tmp_path):
    body = '[{"id":"a/b","author":"a","downloads":5,"likes":1,"tags":["paid"]},{"id":"c"},{"author":"x","likes":null}]'
    rows = hub.hub_items(landed(spark, body)).orderBy("item_pos").collect()
    expected = [("a/b", "a", 5, 1, ["paid"]), ("c", None, 0, 0, []), ("", "x", 0, 0, [])]
    assert [(r.id, r.author, r.downloads, r.likes, r.tags) for r in rows] == expected
    (tmp_path / "l.json").write_text(body)
    rows = hub.read_hub_files(spark, str(tmp_path)).collect()
    assert sorted((r.id, r.author, r.downloads, r.likes, r.tags) for r in rows if r.author) == sorted(e for e in expected if e[1])


def test_contract(spark):
    rows = spark.sql("SELECT 'a' AS raw_name, 'b' AS canonical_name, 'EXACT' AS match_type, 100.0 AS score")
    assert model.to_contract(rows.select("score", "match_type", "raw_name", "canonical_name"), "ENTITY_MAPPING").columns == [
        "raw_name", "canonical_name", "match_type", "score",
    ]
    for wrong in (rows.drop("score"), rows.withColumn("more", F.lit(1))):
        with pytest.raises(model.ContractError):
            model.to_contract(wrong, "ENTITY_MAPPING")


def test_export_texts(spark):
    nested = spark.sql(
        "SELECT '1.0' AS schemaVersion, 'JOB' AS recordType, struct(CAST(NULL AS STRING) AS company, 'd' AS date, "
        "true AS is_remote, 'x' AS role_family) AS content"
    )
    assert list(model.to_export(nested, "JOB").first()) == ["1.0", "JOB", "", "d", "True", "x"]


def mapping_rows(spark, *names):
    return spark.createDataFrame([(n, n.strip(), "FALLBACK", None) for n in names], "raw_name string, canonical_name string, match_type string, score double")


def test_csv_overwrite_and_round_trip(spark, tmp_path):
    path = str(tmp_path / "m")
    files.write_csv(mapping_rows(spark, "old"), "ENTITY_MAPPING", path)
    names = [' padded ', 'a "quoted", one', "comma,", "é"]
    files.write_csv(mapping_rows(spark, *names), "ENTITY_MAPPING", path)
    stored = tables.read_csv(spark, path)
    assert stored.columns == ["raw_name", "canonical_name", "match_type", "score"]
    assert sorted(r.raw_name for r in stored.collect()) == sorted(names)
    assert {r.score for r in stored.collect()} == {None}


def test_csv_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "m")
    files.append_csv(mapping_rows(spark, "stale"), "ENTITY_MAPPING", path, 7, fresh=True)
    files.append_csv(mapping_rows(spark, "a"), "ENTITY_MAPPING", path, 0, fresh=True)
    for _ in range(2):
        files.append_csv(mapping_rows(spark, "b", "c"), "ENTITY_MAPPING", path, 1)
    assert sorted(r.raw_name for r in tables.read_csv(spark, path).collect()) == ["a", "b", "c"]


def test_reuse(spark, tmp_path):
    path, calls = str(tmp_path / "m"), []

    def compute(*names):
        calls.append(names)
        return mapping_rows(spark, *names)

    reuse = lambda target, *names: sorted(
        r.raw_name for r in files.reuse_or_compute(spark, path, "ENTITY_MAPPING", target, lambda: compute(*names)).collect()
    )
    assert reuse(2, "a", "b", "c") == ["a", "b", "c"]
    assert reuse(2, "x") == ["a", "b", "c"] and len(calls) == 1
    assert reuse(4, "y") == ["y"]


def test_csv_column(spark, tmp_path):
    path = str(tmp_path / "m")
    files.write_csv(mapping_rows(spark, "a"), "ENTITY_MAPPING", path)
    assert [r.value for r in tables.csv_column(spark, path, "raw_name").collect()] == ["a"]
    assert tables.csv_column(spark, path, "score").count() == 0
    assert tables.csv_column(spark, path, "absent").count() == 0
    assert tables.csv_column(spark, path + "-absent", "raw_name").count() == 0


def test_startups_and_products(spark):
    items = spark.createDataFrame(
        [
            (1, 0, "Org/m", None, 9, 600, ["x"], "https://h/api/models"),
            (0, 1, "org/m", "ORG", 2_000_000, 0, ["commercial"], "https://h/api/spaces"),
            (0, 0, "solo", None, 0, 0, [], "https://h/api/spaces"),
            (0, 2, "", "a", 0, 0, [], "https://h/api/spaces"),
            (2, 0, "Org/m", "two-words_x", 20_000, 0, ["paid"], "https://h/api/models"),
        ],
        "src_rank int, item_pos int, id string, author string, downloads long, likes long, tags array<string>, list_url string",
    )
    startups = model.to_contract(records.startups(items, NOW), "STARTUP").collect()
    assert sorted((r["content.entityName"], r["content.data.employeeCount"], r["source.url"]) for r in startups) == [
        ("Org", 250, "https://huggingface.co/ORG"), ("Two Words X", 15, "https://huggingface.co/two-words_x"),
    ]
    products = model.to_contract(records.products(items, NOW, target=2), "PRODUCT").collect()
    assert sorted((r["content.startupName"], r["content.pricingModel"], r["source.url"]) for r in products) == [
        ("Independent", "FREE", "https://huggingface.co/spaces/solo"), ("Org", "FREEMIUM", "https://huggingface.co/spaces/org/m"),
    ]
