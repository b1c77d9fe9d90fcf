"""The sales job: closed transactions to the public table and the work left over."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..config import SalesConfig
from ..operators import caches, sales
from ..sources import publish, write_sales


@dataclass(frozen=True)
class SalesRun:
    public: DataFrame
    misses: DataFrame
    funnel: DataFrame
    cache: DataFrame


def run_sales(
    closed: DataFrame, cache: DataFrame, cfg: SalesConfig,
    found: DataFrame | None = None, keep: bool = False, out: str | None = None, dry_run: bool = False,
) -> SalesRun:
    """``found`` holds places looked up since the cache was written.

    ``misses`` is the queue for the next look-ups.  With ``out`` the public table
    and, beside it, the cache are written; a dry run writes nothing.
    """
    newest = caches.cache_upsert(cache, found, "geocode") if found is not None else cache
    public = sales.sales_public(closed, newest, cfg, keep)
    _, misses = sales.geocode_lookup(sales.sales_valid(sales.sales_type(closed, cfg)), newest, cfg)
    if out and not dry_run:
        publish(closed.sparkSession, f"{out.rstrip('/')}-geocode-cache", newest.write.parquet)
        write_sales(public, out)
    return SalesRun(public, misses, sales.sales_funnel(closed, newest, cfg), newest)
