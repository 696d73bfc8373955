"""Papers to repositories to stars, as joins against snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.links import arxiv_id, extract_repo_link, repo_parts, spread_missing
from tidewire.functions.text import non_empty
from tidewire.operators.dedup import first_per_key


def first_links(links: DataFrame) -> DataFrame:
    """(arxiv_id, repository_url) of each paper's first-ranked link only, when it has a URL."""
    first = first_per_key(links, ["arxiv_id"], ["rank", "repository_url"])
    return first.where(non_empty(F.col("repository_url")).isNotNull()).select("arxiv_id", "repository_url")


def lookup_code_link(papers: DataFrame, links: DataFrame) -> DataFrame:
    """papers(arxiv_id, ...) + repository_url."""
    found = first_links(links).withColumnRenamed("arxiv_id", "k")
    keyed = papers.withColumn("k", spread_missing(F.col("arxiv_id"), *[F.col(c) for c in papers.columns]))
    return keyed.join(found, "k", "left").drop("k")


def enrich_stars(papers: DataFrame, repos: DataFrame, url: str = "github_url", compat: bool = False) -> DataFrame:
    """papers + github_stars from repos(owner, repo, stars); 0 without link or match. Owner and name ignore case."""
    stars = repos.groupBy(F.lower("owner").alias("o"), F.lower("repo").alias("r")).agg(F.max("stars").alias("found_stars"))
    parts = repo_parts(F.col(url), compat)
    keyed = papers.withColumn("parts", parts)
    keyed = keyed.withColumn("o", spread_missing(F.lower("parts.owner"), *[F.col(c) for c in papers.columns]))
    keyed = keyed.withColumn("r", F.lower("parts.repo")).drop("parts")
    joined = keyed.join(stars, ["o", "r"], "left")
    return joined.withColumn("github_stars", F.coalesce("found_stars", F.lit(0))).drop("o", "r", "found_stars")


def link_repos(
    papers: DataFrame,
    links: DataFrame,
    repos: DataFrame,
    owners: Sequence[str] = tuple(fixed.GENERIC_OWNERS),
    compat: bool = False,
) -> DataFrame:
    """papers(paper_url, search_text, ...) without search_text, + github_url, github_stars: link in the text, else the
    snapshot's.

    The text goes no further than its own task, and papers with a link in it carry a spread key through the lookup, so
    they crowd no other.
    """
    texted = papers.withColumn("text_link", extract_repo_link(F.col("search_text"), owners, compat)).drop("search_text")
    keyed = texted.withColumn("arxiv_id", F.when(F.col("text_link").isNull(), arxiv_id(F.col("paper_url"))))
    linked = lookup_code_link(keyed, links)
    resolved = linked.withColumn("github_url", F.coalesce("text_link", "repository_url"))
    return enrich_stars(resolved.drop("text_link", "repository_url", "arxiv_id"), repos, "github_url", compat)


def search_repos(repos: DataFrame, query: str, k: int = 5) -> DataFrame:
    """Repositories whose name holds the query, ignoring case; most stars first."""
    hits = repos.where(F.contains(F.lower("repo"), F.lit(query.lower())))
    full = F.concat_ws("/", "owner", "repo")
    return hits.select(full.alias("full_name"), "stars").orderBy(F.desc("stars"), "full_name").limit(k)
