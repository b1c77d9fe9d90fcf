"""Upsert of keyed state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column that tells the newer of two results for one key.
ORDERS = {"geocode": None, "scrape": "scraped_at", "url_check": "checked_at"}


def _policy(policy: str) -> tuple[str, Column]:
    """Key column of a cache, and which new results it stores.

    Places are stored only when found; pages also when they hold no photo; url
    checks whatever the answer was.  None stores a network failure.
    """
    if policy == "geocode":
        return "query", F.col("lat").isNotNull() & F.col("lng").isNotNull()
    if policy == "scrape":
        return "page_url", F.col("scraped_at").isNotNull()
    if policy == "url_check":
        return "slug", F.col("status").isNotNull()
    raise ValueError(f"unknown policy {policy}")


def cache_upsert(cache: DataFrame, new: DataFrame, policy: str) -> DataFrame:
    """Cache with storable new results in place of old ones, one row per key.

    ``max_by`` keeps one candidate per key and task before the shuffle.
    """
    key, stored = _policy(policy)
    order = ORDERS[policy]
    cols = cache.columns
    old = cache.withColumn("__new", F.lit(0))
    fresh = new.where(stored).select(*cols).withColumn("__new", F.lit(1))
    rank = F.struct("__new", *([order] if order else [c for c in cols if c != key]))
    rows = old.unionByName(fresh).groupBy(key).agg(F.max_by(F.struct(*cols), rank).alias("row"))
    return rows.select("row.*")
