"""Photo urls out of stored profile pages, with a cache of what pages gave."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AssetConfig
from ..functions import age_seconds, html_text, is_trusted, stamp, strip, truthy
from ..functions.text import WHITESPACE
from .lookups import likely_in, lookup
from .ordering import first_rows

# An image tag with its source before or after its alternative text.
SRC_THEN_ALT = r'(?is)<img\b[^>]*?\bsrc="(https://[^"]+)"[^>]*?\balt="([^"]*)"'
ALT_THEN_SRC = r'(?is)<img\b[^>]*?\balt="([^"]*)"[^>]*?\bsrc="(https://[^"]+)"'


def _quoted(c: Column) -> Column:
    single = F.concat(F.lit("'"), c, F.lit("'"))
    return F.when(c.contains("'") & ~c.contains('"'), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(single)


def read_pages(pages: DataFrame, cfg: AssetConfig, html: str = "html") -> DataFrame:
    """Pages with ``src`` and ``alt`` of their photo, or a ``fault``; the page text is gone.

    The text is searched once for the anchor and once per attribute order; the
    groups are then taken from the short tag.  What follows, the Python decoder
    included, never carries a page.
    """
    kept = [c for c in pages.columns if c != html]
    start = F.regexp_instr(F.col(html), F.lit("(?i)" + cfg.page_anchor))
    carded = pages.withColumn("__start", start).select(
        *kept,
        F.when(F.coalesce(html, F.lit("")) == "", "empty_html")
        .when(F.col("__start") == 0, "no_agent_card_div")
        .alias("fault"),
        F.when(F.col("__start") > 0, F.substr(F.col(html), F.col("__start"))).alias("__card"),
    )
    tagged = carded.withColumn("__first", F.regexp_extract("__card", SRC_THEN_ALT, 0)).select(
        *kept,
        "fault",
        "__first",
        F.when(F.col("__first") == "", F.regexp_extract("__card", ALT_THEN_SRC, 0)).alias("__second"),
    )
    src_first = F.col("__first") != ""
    found = tagged.select(
        *kept,
        F.coalesce(
            "fault", F.when(~src_first & (F.col("__second") == ""), F.lit("no_img_in_agent_card"))
        ).alias("fault"),
        F.when(src_first, F.regexp_extract("__first", SRC_THEN_ALT, 1))
        .otherwise(F.regexp_extract("__second", ALT_THEN_SRC, 2))
        .alias("src"),
        F.when(src_first, F.regexp_extract("__first", SRC_THEN_ALT, 2))
        .otherwise(F.regexp_extract("__second", ALT_THEN_SRC, 1))
        .alias("__alt"),
    )
    return found.withColumn("alt", strip(html_text(F.col("__alt")))).drop("__alt")


def photo_fault(name: Column, cfg: AssetConfig) -> Column:
    """Why a page's image is not the person's photo, or null: host first, then name."""
    low, want = F.lower("alt"), strip(F.lower(name))
    blanks = f"[{WHITESPACE}]+"
    shares = F.arrays_overlap(F.split(low, blanks), F.split(want, blanks))
    mismatch = F.concat(
        F.lit("alt_name_mismatch:expected="), _quoted(F.coalesce(name, F.lit(""))), F.lit(",got="), _quoted(F.col("alt"))
    )
    return F.coalesce(
        "fault",
        F.when(
            ~is_trusted(F.col("src"), cfg.trusted_hosts),
            F.concat(F.lit("untrusted_host:"), F.col("src")),
        ),
        F.when((low != "") & (low != want) & ~shares, mismatch),
    )


def page_extract(pages: DataFrame, cfg: AssetConfig, name: str = "name", html: str = "html") -> DataFrame:
    """Pages with ``photo_url``, or the ``reason`` there is none."""
    judged = read_pages(pages, cfg, html).withColumn("reason", photo_fault(F.col(name), cfg))
    url = F.when(F.col("reason").isNull(), F.col("src"))
    return judged.withColumn("photo_url", url).drop("src", "alt", "fault")


def scrape_reason(cfg: AssetConfig) -> Column:
    return (
        F.when(F.coalesce("hidden", F.lit(False)), "hidden")
        .when(truthy(F.col("soft_deleted_at")), "soft_deleted")
        .when(~truthy(F.col("page_url")), "no_profile_url")
        .when(truthy(F.col("photo")), "has_photo")
        .when(F.col("source").isin(*cfg.excluded_sources), "second_account_excluded")
        .otherwise(F.lit("eligible"))
    )


def scrape_eligible(rows: DataFrame, cfg: AssetConfig) -> DataFrame:
    """Rows with the ``reason`` they are skipped, or ``eligible``."""
    judged = rows.withColumn("reason", scrape_reason(cfg))
    return judged.withColumn("eligible", F.col("reason") == "eligible")


def scrape_queue(rows: DataFrame, cfg: AssetConfig, force: str | None = None, limit: int | None = None) -> DataFrame:
    """Eligible rows, and the one forced by name; the first ``limit`` by position."""
    judged = scrape_eligible(rows, cfg)
    want = F.col("eligible")
    if force:
        want = want | F.coalesce(F.lower("name") == force.lower(), F.lit(False))
    queue = judged.where(want).drop("reason", "eligible")
    return first_rows(queue, limit) if limit else queue


def scrape_cache_lookup(rows: DataFrame, cache: DataFrame, cfg: AssetConfig, now: datetime) -> DataFrame:
    """Rows with ``cache_state`` (fresh_positive, fresh_negative, stale, absent) and the entry."""
    entry = cache.select(
        F.col("page_url").alias("__page"),
        F.col("photo_url").alias("cached_photo"),
        F.col("reason").alias("cached_reason"),
        F.col("scraped_at").alias("__at"),
        F.lit(True).alias("__known"),
    )
    found = lookup(rows, entry, F.nullif("page_url", F.lit("")), "__page")
    fresh = F.coalesce(age_seconds(F.col("__at"), now) < cfg.cache_ttl_seconds, F.lit(False))
    state = (
        F.when(F.col("__known").isNull(), "absent")
        .when(~fresh, "stale")
        .when(truthy(F.col("cached_photo")), "fresh_positive")
        .otherwise(F.lit("fresh_negative"))
    )
    return found.withColumn("cache_state", state).drop("__at", "__known")


def scrape_apply(
    queue: DataFrame, pages: DataFrame, cache: DataFrame, cfg: AssetConfig, now: datetime
) -> DataFrame:
    """One event per queued row.

    Fresh cache entries answer first.  Of the rows that ask for the same page,
    the first reads it and the others find its result in the cache.  Pages that
    nobody asks for are left out before they are parsed; the others are reduced to
    a short url and text before they move, and a page is joined once.
    """
    asked = scrape_cache_lookup(queue, cache, cfg, now)
    live = asked.where(~F.col("cache_state").startswith("fresh"))
    firsts = live.groupBy("page_url").agg(F.min("pos").alias("__first"), F.min_by("name", "pos").alias("__asker"))
    fetched = likely_in(pages.select(F.col("url").alias("page_url"), "html"), "page_url", firsts, "page_url")
    texts = read_pages(fetched, cfg)
    outcome = firsts.join(texts, "page_url").select(
        F.col("page_url").alias("__page"),
        "__first",
        F.col("src").alias("__src"),
        photo_fault(F.col("__asker"), cfg).alias("__fault"),
    )
    rows = lookup(asked, outcome, F.nullif("page_url", F.lit("")), "__page")
    state = F.col("cache_state")
    got, mine = F.col("__first").isNotNull(), F.col("__first") == F.col("pos")
    found = got & F.col("__fault").isNull()
    positive = (state == "fresh_positive") | (~state.startswith("fresh") & found & ~mine)
    negative = (state == "fresh_negative") | (~state.startswith("fresh") & got & ~found & ~mine)
    url = F.when(state == "fresh_positive", F.col("cached_photo")).otherwise(F.col("__src"))
    status = (
        F.when(positive & ~truthy(F.col("photo")), "cached")
        .when(positive, "cached_no_change")
        .when(negative, "cached_negative")
        .when(~got, "failed")
        .when(found, "success")
        .otherwise(F.lit("no_photo_found"))
    )
    events = rows.withColumns({"status": status, "__url": url})
    why = (
        F.when(F.col("status") == "failed", "fetch_failed")
        .when(state == "fresh_negative", F.coalesce("cached_reason", F.lit("cached_no_photo")))
        .when(F.col("status").isin("no_photo_found", "cached_negative"), F.col("__fault"))
    )
    return events.select(
        "name",
        "page_url",
        "id",
        F.lit(stamp(now)).alias("attempted_at"),
        "status",
        F.when(F.col("status").isin("cached", "success"), F.col("__url")).alias("photo_url"),
        why.alias("reason"),
        "pos",
    )


def scrape_results(events: DataFrame) -> DataFrame:
    """Events as new cache entries: what a page gave, found or not."""
    return events.where(F.col("status").isin("success", "no_photo_found")).select(
        "page_url", "photo_url", F.col("attempted_at").alias("scraped_at"), F.col("name").alias("agent_name"), "reason"
    )


def apply_photos(directory: DataFrame, events: DataFrame) -> DataFrame:
    """Directory with the photos a scrape found."""
    won = events.where(F.col("photo_url").isNotNull()).select("pos", F.col("photo_url").alias("__photo"))
    return directory.join(won, "pos", "left").withColumn("photo", F.coalesce("__photo", "photo")).drop("__photo")
