"""Node and edge tables of the industry graph.

Inputs carry resolved organisation names in org:
organizations(org), products(product_url, org), papers(paper_url, title, github_url), jobs(org, date, role_family),
news(url, title).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewire.functions.links import repo_parts, signature
from tidewire.functions.text import non_empty


def node_id(label: str, key: Column) -> Column:
    """The same id for the same label and natural key in every run."""
    return signature(F.lit(label), key)


def org_key(name: Column) -> Column:
    return F.lower(F.trim(name))


def _job_key() -> Column:
    return F.concat_ws("|", org_key(F.col("org")), "date", "role_family")


def _nodes(rows: DataFrame, label: str, key: Column, name: Column) -> DataFrame:
    keyed = rows.select(key.alias("key"), name.alias("name")).where(non_empty(F.col("key")).isNotNull())
    one = keyed.groupBy("key").agg(F.min("name").alias("name"))
    return one.select(F.lit(label).alias("label"), node_id(label, F.col("key")).alias("node_id"), "key", "name")


def kg_nodes(organizations: DataFrame, products: DataFrame, papers: DataFrame, jobs: DataFrame, news: DataFrame) -> DataFrame:
    """(label, node_id, key, name), one row per label and natural key."""
    c = F.col
    tables = [
        _nodes(organizations, "Organization", org_key(c("org")), c("org")),
        _nodes(products, "Product", c("product_url"), c("product_url")),
        _nodes(papers, "Paper", c("paper_url"), c("title")),
        _nodes(papers, "Repository", F.lower("github_url"), F.lower("github_url")),
        _nodes(jobs, "JobPosting", _job_key(), c("role_family")),
        _nodes(news, "NewsArticle", c("url"), c("title")),
    ]
    return reduce(DataFrame.unionByName, tables)


def _edges(rows: DataFrame, kind: str, source: tuple[str, Column], target: tuple[str, Column]) -> DataFrame:
    ends = rows.where(non_empty(source[1]).isNotNull() & non_empty(target[1]).isNotNull())
    return ends.select(
        F.lit(kind).alias("type"), node_id(*source).alias("src_id"), node_id(*target).alias("dst_id")
    ).distinct()


def kg_edges(organizations: DataFrame, products: DataFrame, papers: DataFrame, jobs: DataFrame) -> DataFrame:
    """(type, src_id, dst_id) of BUILT, PUBLISHED, HAS_REPO and OPENED.

    No paper record names its organisation, so PUBLISHED takes the owner of the paper's repository.
    """
    known = organizations.select(org_key(F.col("org")).alias("o")).distinct()

    def of_known(rows: DataFrame, name: Column) -> DataFrame:
        return rows.withColumn("o", org_key(name)).join(known, "o", "left_semi")

    c = F.col
    owner = repo_parts(c("github_url"))["owner"]
    tables = [
        _edges(of_known(products, c("org")), "BUILT", ("Organization", c("o")), ("Product", c("product_url"))),
        _edges(of_known(papers, owner), "PUBLISHED", ("Organization", c("o")), ("Paper", c("paper_url"))),
        _edges(papers, "HAS_REPO", ("Paper", c("paper_url")), ("Repository", F.lower("github_url"))),
        _edges(of_known(jobs, c("org")), "OPENED", ("Organization", c("o")), ("JobPosting", _job_key())),
    ]
    return reduce(DataFrame.unionByName, tables)
