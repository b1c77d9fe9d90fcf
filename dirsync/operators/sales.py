"""Closed transactions to the public sales table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SalesConfig
from ..functions import addr_query, fmt_price, strip, strip_house_no
from .lookups import lookup

FUNNEL_STEPS = ("closed", "residential", "valid", "located")


def type_kept(cfg: SalesConfig) -> Column:
    kind = F.lower(F.coalesce("transaction_type", F.lit("")))
    cond = kind == ""
    for word in cfg.keep_words:
        cond = cond | kind.contains(word)
    return cond


def sale_price() -> Column:
    """The price, else the sales volume; zero counts as missing."""
    return F.coalesce(F.nullif("price", F.lit(0.0)), F.nullif("sales_volume", F.lit(0.0)), F.lit(0.0))


def is_valid_sale() -> Column:
    return (sale_price() > 0) & (strip(F.col("address")) != "") & (strip(F.col("city")) != "")


def sales_type(sales: DataFrame, cfg: SalesConfig) -> DataFrame:
    return sales.where(type_kept(cfg))


def sales_valid(sales: DataFrame) -> DataFrame:
    return sales.where(is_valid_sale())


def _query(cfg: SalesConfig) -> Column:
    return addr_query(F.col("address"), F.col("city"), F.col("state"), F.col("zip"), cfg.default_state)


def geocode_lookup(sales: DataFrame, cache: DataFrame, cfg: SalesConfig, found: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Sales with coordinates, and the distinct queries that still have none.

    ``found`` holds places looked up since the cache was written.
    """
    known = cache.select("query", "lat", "lng", F.lit(True).alias("from_cache"))
    if found is not None:
        fresh = found.join(cache.select("query"), "query", "left_anti")
        known = known.unionByName(fresh.select("query", "lat", "lng", F.lit(False).alias("from_cache")))
    asked = sales.withColumn("query", _query(cfg))
    located = lookup(asked, known.withColumnRenamed("query", "__q"), F.col("query"), "__q", pos="id")
    located = located.withColumn("from_cache", F.coalesce("from_cache", F.lit(False)))
    misses = located.where("lat is null or lng is null").select("query").distinct()
    return located, misses


def sales_public(sales: DataFrame, cache: DataFrame, cfg: SalesConfig, keep: bool = False) -> DataFrame:
    """Valid sales in their public columns; rows without a place only if ``keep``.

    Both filters run before the cache join.  A place is missing only when it is
    null: zero is a coordinate.
    """
    located, _ = geocode_lookup(sales_valid(sales_type(sales, cfg)), cache, cfg)
    public = located.select(
        strip_house_no(strip(F.col("address"))).alias("street"),
        strip(F.col("city")).alias("city"),
        sale_price().cast("bigint").alias("price"),
        fmt_price(sale_price()).alias("price_fmt"),
        "lat",
        "lng",
        F.col("closing_date").alias("close_date"),
    )
    return public if keep else public.where("lat is not null and lng is not null")


def sales_funnel(sales: DataFrame, cache: DataFrame, cfg: SalesConfig) -> DataFrame:
    """Rows left after each step, from one aggregate."""
    located, _ = geocode_lookup(sales, cache, cfg)
    kept = type_kept(cfg)
    valid = kept & is_valid_sale()
    here = valid & F.col("lat").isNotNull() & F.col("lng").isNotNull()
    counts = located.agg(
        F.count(F.lit(1)).alias("closed"),
        F.count_if(kept).alias("residential"),
        F.count_if(valid).alias("valid"),
        F.count_if(here).alias("located"),
    )
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), F.col(s).alias("n")) for i, s in enumerate(FUNNEL_STEPS)])
    return counts.select(F.inline(steps))
