"""The photo jobs: queue, cascade of attempts, directory and state after a run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from ..config import AssetConfig
from ..operators import assets, caches, pages, summaries
from ..session import materialise
from ..sources import publish, publish_directory, write_reports


def _write(out: str, now: datetime, directory: DataFrame, state: tuple[str, DataFrame], reports: dict[str, tuple[str, DataFrame]]) -> None:
    """The reports, then the state, the directory last: it never tells of a run whose state is lost."""
    spark, (name, rows) = directory.sparkSession, state
    write_reports(reports, f"{out}/reports", now)
    publish(spark, f"{out}/{name}", rows.write.parquet)
    publish_directory(directory, f"{out}/directory.parquet")


@dataclass(frozen=True)
class PhotoRun:
    events: DataFrame
    directory: DataFrame
    retries: DataFrame
    skipped: DataFrame
    orphans: DataFrame
    summary: DataFrame


def run_photos(
    directory: DataFrame, stored: DataFrame, attempts_a: DataFrame, attempts_b: DataFrame,
    retries: DataFrame, run: int, now: datetime, cfg: AssetConfig,
    force: str | None = None, limit: int | None = None, out: str | None = None, dry_run: bool = False,
) -> PhotoRun:
    """Decide, apply what the fetchers brought, and bring the state up to date.

    The events are written once, because the directory, the state and the
    summary all read them.  With ``out`` the run is published: directory, retries
    (``read_state`` reads them), and reports of events, skipped rows, stored files
    without a row, and counts.  A dry run computes the same and publishes nothing.
    """
    decided = assets.asset_decision(directory, stored, cfg)
    queue = assets.force_limit(decided, force, limit)
    events = materialise(
        assets.asset_cascade(queue, attempts_a, attempts_b, retries, run, now, cfg), "photo-events"
    )
    applied = assets.rebase_url(assets.asset_apply(directory, events, cfg), stored, cfg)
    done = PhotoRun(
        events=events,
        directory=applied,
        retries=assets.retry_update(retries, events, run),
        skipped=summaries.skip_counts(assets.skipped(decided, force)),
        orphans=assets.orphan_assets(stored, directory),
        summary=summaries.asset_summary(events, cfg.source_a, cfg.source_b),
    )
    if out and not dry_run:
        reports = {
            "photo-events": ("What became of every queued row.", done.events),
            "photo-skipped": ("Rows left out, per reason.", done.skipped),
            "orphans": ("Stored files that belong to no row.", done.orphans),
            "photo-summary": ("Counts of the run.", done.summary),
        }
        _write(out, now, done.directory, ("retries", done.retries), reports)
    return done


@dataclass(frozen=True)
class ScrapeRun:
    events: DataFrame
    directory: DataFrame
    cache: DataFrame
    summary: DataFrame


def run_scrape(
    directory: DataFrame, fetched: DataFrame, cache: DataFrame, now: datetime, cfg: AssetConfig,
    force: str | None = None, limit: int | None = None, out: str | None = None, dry_run: bool = False,
    use_cache: bool = True,
) -> ScrapeRun:
    """Photo urls out of fetched pages into the directory and the cache.

    With ``out`` the run is published: directory, cache, and reports of events and
    counts; a dry run publishes nothing.  Without ``use_cache`` every page is read
    anew, and the cache is still brought up to date.
    """
    queue = pages.scrape_queue(directory, cfg, force, limit)
    events = materialise(pages.scrape_apply(queue, fetched, cache if use_cache else cache.limit(0), cfg, now), "scrape-events")
    done = ScrapeRun(
        events=events,
        directory=pages.apply_photos(directory, events),
        cache=caches.cache_upsert(cache, pages.scrape_results(events), "scrape"),
        summary=summaries.scrape_summary(events),
    )
    if out and not dry_run:
        reports = {
            "scrape-events": ("What became of every queued row.", done.events),
            "scrape-summary": ("Counts of the run.", done.summary),
        }
        _write(out, now, done.directory, ("scrape-cache", done.cache), reports)
    return done
