"""RSS, Atom and job-board payloads to item rows.

Every reader keeps the payload's columns, adds item_pos and never relies on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.functions.names import join_authors
from tidewire.functions.once import bind, compute_once
from tidewire.functions.text import collapse_ws, fallback, strip_ws

_TEXTS = "array<struct<_VALUE:string,_href:string>>"
_ITEM = (
    f"struct<title:{_TEXTS},link:{_TEXTS},pubDate:{_TEXTS},`atom:title`:{_TEXTS},`atom:link`:{_TEXTS},"
    f"`atom:published`:{_TEXTS},`atom:updated`:{_TEXTS},`a10:updated`:{_TEXTS}>"
)
_ENTRY = (
    f"struct<id:{_TEXTS},title:{_TEXTS},summary:{_TEXTS},published:{_TEXTS},updated:{_TEXTS},link:{_TEXTS},"
    f"author:array<struct<name:{_TEXTS}>>,`arxiv:comment`:{_TEXTS}>"
)
_DOCUMENT = f"entry array<{_ENTRY}>, _corrupt string"
# An item with its attributes, whose values may hold any sign; closed at once, or up to its end.
_ITEMS = r"""(?s)<item(?:\s(?:[^>"'/]++|"[^"]*"|'[^']*'|/(?!>))*+)?(?:/>|>.*?</item\s*>)"""
_ATOM_PREFIX = r"""xmlns:([^\s=:]+)\s*=\s*["']http://www\.w3\.org/2005/Atom["']"""
_XML = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "attributePrefix": "_", "valueTag": "_VALUE"}
_JOBS = "jobs array<struct<company_name:string,title:string,publication_date:string,pubDate:string>>, _corrupt string"
_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _first(elements: Column, part: str = "_VALUE") -> Column:
    return F.get(elements, F.lit(0))[part]


def _text(elements: Column) -> Column:
    return F.coalesce(_first(elements), F.lit(""))


def _present(*elements: Column) -> Column:
    """The first of several elements that is there, be it empty."""
    return F.coalesce(*[F.when(F.size(e) > 0, e) for e in elements])


def parse_documents(payloads: DataFrame) -> DataFrame:
    """payloads + doc (entry) and _corrupt, which holds the body of unreadable documents."""
    return _marked(compute_once(payloads, "doc", F.from_xml("body", _DOCUMENT, _XML)))


def parse_jobs(payloads: DataFrame) -> DataFrame:
    """payloads + doc (jobs) and _corrupt, for JSON documents."""
    return _marked(compute_once(payloads, "doc", F.from_json("body", _JOBS, _JSON)))


def _marked(parsed: DataFrame) -> DataFrame:
    unreadable = F.col("doc").isNull() | F.col("doc._corrupt").isNotNull()
    return parsed.withColumn("_corrupt", F.when(unreadable, F.coalesce("body", F.lit(""))))


def _plain_markup(body: Column) -> Column:
    """The document without CDATA sections, whose text is escaped instead, and without comments: every < is markup now."""

    def section(part: Column) -> Column:
        end = F.instr(part, "]]>")
        inside = F.replace(F.replace(F.substr(part, F.lit(1), end - 1), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(end > 0, F.concat(inside, F.substr(part, end + 3))).otherwise(part)

    opened = bind(
        F.split(body, r"<!\[CDATA\["),
        lambda parts: F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), section), "")),
    )
    return F.regexp_replace(opened, "(?s)<!--.*?-->", "")


def _rss_items(body: Column) -> Column:
    """The items of a document wherever they stand, in document order, each cut from the text and parsed alone.

    Elements of the Atom namespace are read under whatever prefix the document gives it. Items within items are not told apart.
    """

    def parsed(plain: Column) -> Column:
        prefix = F.regexp_extract(body, _ATOM_PREFIX, 1)

        def one(item: Column) -> Column:
            renamed = F.replace(F.replace(item, F.concat(F.lit("<"), prefix, F.lit(":")), F.lit("<atom:")), F.concat(F.lit("</"), prefix, F.lit(":")), F.lit("</atom:"))
            return F.from_xml(F.when(prefix == "", item).otherwise(renamed), _ITEM, _XML)

        return F.transform(F.regexp_extract_all(plain, F.lit(_ITEMS), 0), one)

    return bind(_plain_markup(body), parsed)


def feed_items(payloads: DataFrame) -> DataFrame:
    """Items of RSS documents, else entries of Atom documents: item_pos, title, link, pub_str.

    RSS items may carry Atom elements under the prefixes atom and a10; they stand in for missing RSS ones.
    """
    doc = F.col("doc")

    def unified(title: Column, link: Column, *dates: Column) -> Column:
        date = _text(_present(*dates))
        href = fallback(_first(link), _first(link, "_href"))
        return F.struct(
            collapse_ws(_text(title)).alias("title"),
            F.coalesce(href, F.lit("")).alias("link"),
            strip_ws(date).alias("pub_str"),
        )

    def of_item(i: Column) -> Column:
        title, link = _present(i["title"], i["atom:title"]), _present(i["link"], i["atom:link"])
        return unified(title, link, i["pubDate"], i["atom:published"], i["atom:updated"], i["a10:updated"])

    items = F.transform(_rss_items(F.col("body")), of_item)
    entries = F.transform(doc["entry"], lambda e: unified(e["title"], e["link"], e["published"], e["updated"]))
    return _exploded(parse_documents(payloads), bind(items, lambda found: F.when(F.size(found) > 0, found).otherwise(entries)))


def _exploded(parsed: DataFrame, items: Column) -> DataFrame:
    kept = [c for c in parsed.columns if c not in ("doc", "body", "_corrupt")]
    good = parsed.where(F.col("_corrupt").isNull())
    return good.select(*kept, F.posexplode(items).alias("item_pos", "it")).select(*kept, "item_pos", "it.*")


def rss_jobs(payloads: DataFrame) -> DataFrame:
    """Items of RSS documents only: item_pos, title, pub_str."""
    items = F.transform(
        _rss_items(F.col("body")),
        lambda i: F.struct(strip_ws(_text(i["title"])).alias("title"), strip_ws(_text(i["pubDate"])).alias("pub_str")),
    )
    return _exploded(parse_documents(payloads), items)


def json_jobs(payloads: DataFrame) -> DataFrame:
    """Jobs of JSON documents: item_pos, company, title, pub_str; company is NULL where the key is missing."""
    items = F.transform(
        F.col("doc.jobs"),
        lambda j: F.struct(
            j["company_name"].alias("company"),
            F.coalesce(j["title"], F.lit("")).alias("title"),
            F.coalesce(fallback(j["publication_date"], j["pubDate"]), F.lit("")).alias("pub_str"),
        ),
    )
    return _exploded(parse_jobs(payloads), items)


def _paper(entry: Column) -> Column:
    names = F.transform(entry["author"], lambda a: _first(a["name"]))
    return F.struct(
        collapse_ws(_text(entry["title"])).alias("title"),
        strip_ws(_text(entry["published"])).alias("published"),
        join_authors(names).alias("authors"),
        strip_ws(_text(entry["id"])).alias("paper_url"),
        _text(entry["summary"]).alias("summary"),
        _text(entry["arxiv:comment"]).alias("comment"),
    )


def atom_papers(payloads: DataFrame) -> DataFrame:
    """Entries of Atom documents: item_pos, title, published, authors, paper_url, summary, comment."""
    return _exploded(parse_documents(payloads), F.transform(F.col("doc.entry"), _paper))


def read_atom_files(spark: SparkSession, path: str) -> DataFrame:
    """The same paper rows from Atom files, split by entry; files carry no position, so there is no item_pos."""
    schema = spark.sql(f"SELECT CAST(NULL AS {_ENTRY}) AS e").schema["e"].dataType
    entries = spark.read.schema(schema).options(rowTag="entry", **_XML).xml(path)
    return entries.select(_paper(F.struct(*[F.col(f"`{c}`") for c in entries.columns])).alias("p")).select("p.*")
