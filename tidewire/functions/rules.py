"""Classification rules, first hit wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tidewire import fixed_values as fixed


def _has_any(text: Column, *words: str) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def role_family(title: Column) -> Column:
    lowered = F.lower(F.coalesce(title, F.lit("")))
    return (
        F.when(_has_any(lowered, "engineer", "developer"), "Engineering")
        .when(_has_any(lowered, "research", "scientist"), "AI Research")
        .when(_has_any(lowered, "product"), "Product Management")
        .otherwise("Data & AI")
    )


def employee_tier(downloads: Column, likes: Column) -> Column:
    """Head count guessed from popularity; NULL when there is too little of it."""
    downloads, likes = F.coalesce(downloads, F.lit(0)), F.coalesce(likes, F.lit(0))
    return (
        F.when(downloads > 1_000_000, 250)
        .when((downloads > 100_000) | (likes > 500), 50)
        .when(downloads > 10_000, 15)
    )


def tags_has(tags: Column, tag: str) -> Column:
    return F.coalesce(F.array_contains(tags, tag), F.lit(False))


def pricing_tier(tags: Column, likes: Column) -> Column:
    likes = F.coalesce(likes, F.lit(0))
    return (
        F.when(tags_has(tags, "enterprise") | (likes > 2000), "ENTERPRISE")
        .when(tags_has(tags, "commercial") | (likes > 500), "FREEMIUM")
        .when(tags_has(tags, "paid"), "PAID")
        .otherwise("FREE")
    )


def hub_url(item: Column, list_url: Column) -> Column:
    """Page of a hub item; items of a spaces list live under spaces/."""
    folder = F.when(F.contains(list_url, F.lit("spaces")), F.lit("spaces/")).otherwise(F.lit(""))
    return F.concat(F.lit(fixed.HUB_URL), folder, item)
