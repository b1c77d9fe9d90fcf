"""Counts.  Each is one aggregate; counts of several tables come from one union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FLAG_DUPLICATE, FLAG_JUNK, FLAG_MISSING, FLAG_NO_REGION
from ..functions import truthy
from .lifecycle import NEW, PURGE, REACTIVATED, SOFT_DELETE


def sync_summary(ledger: DataFrame, flags: DataFrame) -> DataFrame:
    """Thirteen counts of one run.

    ``total_considered`` adds the kept and soft-deleted rows, which the source
    did not send.
    """
    marks = ledger.select("fate", F.coalesce("hidden", F.lit(False)).alias("hidden"), F.lit(None).cast("string").alias("flag"))
    marks = marks.unionByName(
        flags.select(F.lit(None).cast("string").alias("fate"), F.lit(False).alias("hidden"), "flag")
    )
    fate, flag = F.col("fate"), F.col("flag")
    inside = fate.isNotNull() & (fate != PURGE)

    def n(cond: Column, name: str) -> Column:
        return F.count_if(cond).alias(name)

    return marks.agg(
        n(inside | flag.isin(FLAG_JUNK, FLAG_NO_REGION), "total_considered"),
        n(inside & ~F.col("hidden"), "live_on_site"),
        n(inside & F.col("hidden"), "hidden_on_site"),
        n(flag == FLAG_NO_REGION, "excluded_no_region"),
        n(flag == FLAG_JUNK, "excluded_junk"),
        n(flag == FLAG_MISSING, "missing_data"),
        n(flag == FLAG_DUPLICATE, "potential_duplicates"),
        n(inside, "included_in_site"),
        n(flag == FLAG_NO_REGION, "missing_region"),
        n(fate == NEW, "new_rows"),
        n(fate == SOFT_DELETE, "soft_deletes"),
        n(fate == PURGE, "purges"),
        n(fate == REACTIVATED, "reactivated"),
    )


def role_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def skip_counts(skipped: DataFrame) -> DataFrame:
    return skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def coverage_stats(directory: DataFrame) -> DataFrame:
    seen = ~F.coalesce("hidden", F.lit(False))
    placed = F.coalesce(F.size("regions") > 0, F.lit(False))
    return directory.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(seen).alias("visible"),
        F.count_if(seen & truthy(F.col("photo"))).alias("with_photo"),
        F.count_if(seen & placed).alias("with_region"),
        F.count_if(seen & ~placed).alias("without_region"),
    )


def asset_summary(events: DataFrame, source_a: str, source_b: str) -> DataFrame:
    """Photo events by source and status; every status that starts with "failed" counts as failed."""
    status, source = F.col("status"), F.col("source")
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(source == source_a).alias("acquired_a"),
        F.count_if(source == source_b).alias("acquired_b"),
        F.count_if(status.isin("kept_existing", f"kept_existing_{source_a}")).alias("kept_existing"),
        F.count_if(status.startswith("failed")).alias("failed"),
        F.count_if(status == f"{source_b}_cooldown").alias("cooldown"),
    )


def scrape_summary(events: DataFrame) -> DataFrame:
    status = F.col("status")
    return events.agg(
        F.count(F.lit(1)).alias("total_attempted"),
        F.count_if(status == "success").alias("successful"),
        F.count_if(status == "cached").alias("cached"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "no_photo_found").alias("not_found"),
        F.count_if(status == "cached_negative").alias("cached_negative"),
    )


def geocode_summary(located: DataFrame) -> DataFrame:
    """Located rows, from the cache or new this run, and rows still without a place."""
    found = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    return located.agg(
        F.count_if(found).alias("located"),
        F.count_if(found & F.col("from_cache")).alias("from_cache"),
        F.count_if(found & ~F.col("from_cache")).alias("new_lookups"),
        F.count_if(~found).alias("failed"),
    )
