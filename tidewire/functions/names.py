"""Organisation, author and product names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.text import collapse_ws, fallback, non_empty, strip_ws

_SUFFIX = r"(?iU)\b(" + "|".join(fixed.LEGAL_SUFFIXES) + r")\b\.?"


def clean_name(raw: Column) -> Column:
    """Name without punctuation noise and legal-suffix words, wherever they stand."""
    plain = F.regexp_replace(raw, fixed.NAME_PUNCTUATION, " ")
    return collapse_ws(F.regexp_replace(plain, _SUFFIX, " "))


def is_blank(name: Column) -> Column:
    return F.coalesce(F.length(strip_ws(name)) == 0, F.lit(True))


def clean_org_name(raw: Column) -> Column:
    """Slug to display name: separators to blanks, each word capitalised."""
    words = F.initcap(collapse_ws(F.translate(raw, "-_", "  ")))
    return F.when(non_empty(raw).isNull(), F.lit(fixed.DEFAULT_ORG)).otherwise(words)


def _before_slash(item_id: Column) -> Column:
    return F.when(F.contains(item_id, F.lit("/")), F.substring_index(item_id, "/", 1))


def author_from_id(author: Column, item_id: Column) -> Column:
    """The author, else the id's part before its first slash."""
    return F.coalesce(non_empty(author), _before_slash(item_id), author)


def valid_author(author: Column) -> Column:
    return F.length(author) >= 2


def product_org(item_id: Column) -> Column:
    """Display name of the id's owner part, or the stand-in for ids without owner."""
    owner = _before_slash(item_id)
    return F.when(owner.isNull(), F.lit(fixed.DEFAULT_PRODUCT_ORG)).otherwise(clean_org_name(owner))


def split_company_title(title: Column) -> Column:
    """struct<company,role> of a title 'Company: Role', cut at the first colon."""
    parts = F.split(title, ":", 2)
    has_colon = F.contains(title, F.lit(":"))
    company = F.when(has_colon, strip_ws(parts[0])).otherwise(F.lit(fixed.DEFAULT_RSS_COMPANY))
    role = F.when(has_colon, F.get(parts, F.lit(1))).otherwise(title)
    return F.struct(company.alias("company"), role.alias("role"))


def json_company(company: Column) -> Column:
    """A missing company gets the stand-in; an empty one stays empty."""
    return F.coalesce(company, F.lit(fixed.DEFAULT_JSON_COMPANY))


def join_authors(names: Column) -> Column:
    """Non-empty author names, stripped, in order, comma-joined."""
    kept = F.filter(names, lambda n: n.isNotNull() & (n != ""))
    return F.coalesce(F.array_join(F.transform(kept, strip_ws), ", "), F.lit(""))


def link_or_source(link: Column, source_url: Column) -> Column:
    return fallback(link, source_url)
