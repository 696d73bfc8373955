"""Links, paper ids, signatures and domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.dates import fmt_iso
from tidewire.functions.text import non_empty, strip_ws


def _trim_repo(repo: Column, compat: bool) -> Column:
    if compat:
        return F.rtrim(repo, F.lit(".git"))
    without_dots = F.rtrim(repo, F.lit("."))
    return F.rtrim(F.regexp_replace(without_dots, r"\.git\z", ""), F.lit("."))


def repo_parts(text: Column, compat: bool = False) -> Column:
    """struct<owner,repo> of the first repository link in the text; both NULL without one."""
    pieces = F.split(F.regexp_extract(text, fixed.REPO_LINK_PATTERN, 0), "/")
    owner, repo = F.get(pieces, F.lit(3)), _trim_repo(F.get(pieces, F.lit(4)), compat)
    return F.struct(owner.alias("owner"), repo.alias("repo"))


def generic_owner(owner: Column, owners: Sequence[str] = tuple(fixed.GENERIC_OWNERS)) -> Column:
    return F.lower(owner).isin(*owners)


def extract_repo_link(
    text: Column, owners: Sequence[str] = tuple(fixed.GENERIC_OWNERS), compat: bool = False
) -> Column:
    """Rebuilt URL of the first repository link. A site page as first hit gives NULL, later hits do not count.

    compat=True trims any trailing run of the characters '.', 'g', 'i', 't' off the name;
    the default takes off one '.git' and trailing dots.
    """
    parts = repo_parts(text, compat)
    usable = parts["owner"].isNotNull() & ~generic_owner(parts["owner"], owners)
    if not compat:
        usable = usable & (parts["repo"] != "")
    return F.when(usable, F.concat(F.lit(fixed.REPO_URL_PREFIX), parts["owner"], F.lit("/"), parts["repo"]))


def search_text(summary: Column, comment: Column) -> Column:
    return F.concat(F.coalesce(summary, F.lit("")), F.lit(" "), F.coalesce(comment, F.lit("")))


def arxiv_id(paper_url: Column) -> Column:
    """Last path segment without its version."""
    return strip_ws(F.substring_index(F.substring_index(paper_url, "/", -1), "v", 1))


def root_domain(url: Column) -> Column:
    """Last two labels of the host, lower-cased."""
    return F.substring_index(F.lower(F.try_parse_url(url, F.lit("HOST"))), ".", -2)


def signature(*parts: Column) -> Column:
    """SHA-256 over the parts; a separator keeps ('ab','c') apart from ('a','bc')."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def content_hash(name: Column, date: Column, url: Column) -> Column:
    return signature(F.lower(F.trim(name)), fmt_iso(date), url)


def url_title_signature(url: Column, title: Column) -> Column:
    return signature(F.lower(F.trim(url)), F.lower(F.trim(title)))


def spread_missing(key: Column, *spread_by: Column) -> Column:
    """Join key whose missing values are spread over tasks by values that match nothing."""
    return F.coalesce(non_empty(key), F.concat(F.lit("\u0000"), F.xxhash64(*spread_by).cast("string")))
