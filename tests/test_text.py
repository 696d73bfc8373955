import random

from pyspark.sql import functions as F

from tidewire.functions import links, names, rules, text
from tidewire.functions.register import register_sql_functions

SAMPLE_PAGE = """
<html lang="en"><head><title>Harbour</title>
<style type="text/css">body > p { color: teal }</style>
<script async>if (a < b) { tide("high") }</script></head>
<body><h2>Harbour   Notes</h2><ul><li>Low water at six.</li>
<li>Ferry leaves at <b>seven</b>.</li></ul></body></html>
"""
SAMPLE_TEXT = (
    "Harbour Harbour Notes Low water at six. Ferry leaves at seven ."
)


def cut(value, limit):
    """Plain statement of the chunk rule."""
    if len(value) <= limit:
        return value
    head = value[:limit]
    return head[: head.rfind(".") + 1] or head


def test_clean_html(column):
    pages = [
        SAMPLE_PAGE,
        'a<SCRIPT x="1">b\n</p>c</script>d',
        '<img src="data:image/png;base64,AAAA+/=" alt="k">e&amp;f&#8217;',
        "<svg><path/></svg><noscript>n</noscript>g",
        "no tags   here\x1c.",
        None,
    ]
    assert column(text.clean_html, pages) == [SAMPLE_TEXT, "a d", "e&amp;f&#8217;", "g", "no tags here .", None]


def test_chunk_payload_matches_rule(column):
    rng = random.Random(3)
    values = ["".join(rng.choice("ab.é𝒳 ") for _ in range(rng.randrange(0, 30))) for _ in range(200)]
    for limit in (0, 1, 5, 17, 4000):
        assert column(lambda c: text.chunk_payload(c, limit), values) == [cut(v, limit) for v in values]


def test_shrink_ladder(column):
    values = [SAMPLE_TEXT, "", "x" * 50, "a.b.c.d.e.f.g.h"]
    ladders = column(lambda c: text.shrink_ladder(c, 60, 6), values)
    for value, ladder in zip(values, ladders):
        body = cut(value, 60)
        for step, rung in enumerate(ladder):
            assert (rung.step, rung.text, rung.length) == (step, body, len(body))
            body = cut(body, len(body) // 2)


def test_shrink_ladder_as_long_as_each_row_asks(spark):
    rows = spark.createDataFrame([("word. " * 900, 0), ("word. " * 900, 2), ("word. " * 900, 30), ("x", None)], "t string, n int")
    found = [r.ladder for r in rows.select(text.shrink_ladder(F.col("t"), 4000, F.col("n")).alias("ladder")).collect()]
    assert [len(x) if x else x for x in found] == [1, 3, 31, None]
    assert found[1] == found[2][:3] and found[2][-1].length <= 1


def test_fit_to_budget(column):
    fitted = column(lambda c: text.fit_to_budget(text.shrink_ladder(c, 60, 3), 20)["step"], [SAMPLE_TEXT, "x" * 300])
    assert fitted == [1, 2]


def test_clean_name(column):
    raw = ["OpenAI, Inc.", "Scale AI Corp", "AI Labs Inc.", "Stability.AI", "Acme® Co. Ltd", "Tech artificial intelligence X", "Incline Labsy"]
    assert column(names.clean_name, raw) == ["OpenAI", "Scale", "", "Stability", "Acme", "X", "Incline Labsy"]


def test_org_names(column):
    raw = ["meta-llama", "BIG_science--hub", "", None, "-_-"]
    assert column(names.clean_org_name, raw) == ["Meta Llama", "Big Science Hub", "AI Innovator", "AI Innovator", ""]
    assert column(names.product_org, ["a-b/m/x", "solo", "/m"]) == ["A B", "Independent", "AI Innovator"]


def test_author_from_id(spark):
    rows = spark.createDataFrame([(None, "o/m"), ("", "o/m"), ("a", "o/m"), (None, "m"), ("", "m")], "author string, id string")
    got = [r[0] for r in rows.select(names.author_from_id(F.col("author"), F.col("id"))).collect()]
    assert got == ["o", "o", "a", None, ""]


def test_split_company_title(column):
    got = column(names.split_company_title, [" Acme : Lead: ML", "Analyst", "", ":x"])
    assert [(g.company, g.role) for g in got] == [("Acme", " Lead: ML"), ("AI Startup", "Analyst"), ("AI Startup", ""), ("", "x")]


def test_join_authors(column):
    values = [["A", " B ", "", None, "C"], [], None]
    assert column(names.join_authors, values, "array<string>") == ["A, B, C", "", ""]


def test_role_family(column):
    titles = ["Research Engineer", "Research Scientist", "Product Researcher", "Product Lead", "Analyst", None, "PRODUCT DEVELOPER"]
    expected = ["Engineering", "AI Research", "AI Research", "Product Management", "Data & AI", "Data & AI", "Engineering"]
    assert column(rules.role_family, titles) == expected


def test_tiers_are_strict(spark):
    rows = [(1_000_001, 0), (1_000_000, 0), (100_001, 0), (100_000, 501), (100_000, 500), (10_001, 0), (10_000, 0), (None, None)]
    frame = spark.createDataFrame(rows, "d long, l long")
    got = [r[0] for r in frame.select(rules.employee_tier(F.col("d"), F.col("l"))).collect()]
    assert got == [250, 50, 50, 50, 15, 15, None, None]
    priced = [(["enterprise"], 0), ([], 2001), ([], 2000), (["commercial"], 0), (["paid"], 500), (["paid"], 501), ([], 500), (None, None)]
    frame = spark.createDataFrame(priced, "t array<string>, l long")
    got = [r[0] for r in frame.select(rules.pricing_tier(F.col("t"), F.col("l"))).collect()]
    assert got == ["ENTERPRISE", "ENTERPRISE", "FREEMIUM", "FREEMIUM", "PAID", "FREEMIUM", "FREE", "FREE"]


def test_repo_links(column):
    texts = [
        "see https://github.com/a/b.git.",
        "HTTP://GitHub.com/Own/pytorch-lightning)",
        "https://github.com/topics/ml then https://github.com/a/b",
        "https://github.com/site/x",
        "https://gitlab.com/a/b",
        None,
        "http://github.com/a-b/c_d.e/tree",
    ]
    assert column(links.extract_repo_link, texts) == [
        "https://github.com/a/b", "https://github.com/Own/pytorch-lightning", None, None, None, None, "https://github.com/a-b/c_d.e",
    ]
    compat = column(lambda c: links.extract_repo_link(c, compat=True), texts)
    assert compat[:2] == ["https://github.com/a/b", "https://github.com/Own/pytorch-lightnin"]
    short = column(lambda c: links.extract_repo_link(c, ["topics"]), texts)
    assert short[3] == "https://github.com/site/x"


def test_ids_and_domains(column):
    assert column(links.arxiv_id, ["http://arxiv.org/abs/2401.00001v2", "2401.1 ", ""]) == ["2401.00001", "2401.1", ""]
    urls = ["https://Export.ArXiv.org/abs/1", "http://localhost:80/x", "not a url", "https://a.b.c.example.com?x=1"]
    assert column(links.root_domain, urls) == ["arxiv.org", "localhost", None, "example.com"]


def test_signature_keeps_parts_apart(spark):
    row = spark.range(1).select(
        links.signature(F.lit("ab"), F.lit("c")).alias("x"), links.signature(F.lit("a"), F.lit("bc")).alias("y"),
        links.signature(F.lit(None), F.lit("c")).alias("z"),
    ).first()
    assert len({row.x, row.y, row.z}) == 3


def test_sql_functions_equal_columns(spark):
    register_sql_functions(spark)
    rows = spark.createDataFrame([(SAMPLE_PAGE,), ("OpenAI, Inc.  x",), ('<a href="data:image/x;base64,ab\'c">.',)], "x string")
    both = rows.select(
        F.expr("tw_clean_html(x)") == text.clean_html(F.col("x")),
        F.expr("tw_collapse_ws(x)") == text.collapse_ws(F.col("x")),
        F.expr("tw_clean_name(x)") == names.clean_name(F.col("x")),
        F.expr("tw_chunk_payload(x, 9)") == text.chunk_payload(F.col("x"), 9),
    )
    assert all(all(r) for r in both.collect())


def test_failover_chain_counts_the_halvings_before_success(spark):
    from tidewire.operators.extraction import failover_chain

    tries = [
        (1, 1, 1, 413), (1, 1, 2, 429), (1, 1, 3, 413), (1, 1, 4, 200), (1, 2, 5, 413), (1, 2, 6, 200),  # the fourth try is not made
        (2, 1, 1, 500), (2, 1, 2, 413), (2, 2, 3, 200),  # a fatal status ends its tier
        (3, 1, 1, 413), (3, 2, 2, 500),
    ]
    rows = spark.createDataFrame([(*t, f"p{t[2]}") for t in tries], "doc_id long, tier int, attempt long, status int, payload string")
    found = {r.doc_id: (r.tier, r.attempt, r.payload, r.shrinks) for r in failover_chain(rows).collect()}
    assert found == {1: (2, 6, "p6", 3), 2: (2, 3, "p3", 0), 3: (None, None, None, None)}
