"""One sync run: rosters and the previous directory to the next directory.

What several steps read is written to the shared folder on the way: the previous
directory, the cleaned and judged roster, the matches and the ledger, and for
reports the flags.  Everything else is computed from those with column-pruned
scans, and each source is read once.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..operators import lifecycle, match, reports, roster, rules, summaries
from ..session import materialise
from ..sources import publish_directory, write_reports


class PublishRefused(RuntimeError):
    """The safety gate refused the run; nothing was written to the directory."""


@dataclass(frozen=True)
class SyncRun:
    """Frames of one run.  Nothing here is computed before it is read."""

    now: datetime
    gate: DataFrame
    ledger: DataFrame
    flags: DataFrame
    role_excluded: DataFrame
    suppressed: DataFrame
    region_unmatched: DataFrame

    @property
    def directory(self) -> DataFrame:
        return lifecycle.ledger_directory(self.ledger)

    @property
    def events(self) -> DataFrame:
        return lifecycle.lifecycle_events(self.ledger)

    @property
    def summary(self) -> DataFrame:
        return summaries.sync_summary(self.ledger, self.flags)


def plan_sync(raw: DataFrame, previous: DataFrame, cfg: SyncConfig, now: datetime) -> SyncRun:
    """Run the merge and hand back its frames; publishes nothing.

    Raises ``PublishRefused`` when too few rows came in.
    """
    rows = roster.merge_accounts(raw, cfg) if cfg.second_enabled else raw.where(F.col("account") == cfg.main_account)
    cleaned = materialise(rules.judge_rows(roster.classify_roster(rows, cfg), cfg), "judged")
    judged = cleaned.where(F.col("dropped").isNull()).select(*roster.PARSED_COLUMNS, "flag", "reason", "kept")
    valid = rules.valid_rows(judged)
    previous = materialise(previous, "previous")
    gate = rules.safety_gate(valid, previous, cfg)
    # One row: the driver must see it before anything is published.
    verdict = gate.first()
    if verdict["refused"]:
        raise PublishRefused(f"{verdict['refused']}: {verdict['valid_rows']} rows")
    matches = materialise(match.tiered_match(valid, previous, cfg), "matches")
    ledger = materialise(lifecycle.merge_ledger(valid, previous, cfg, now, matches), "ledger")
    return SyncRun(
        now=now,
        gate=gate,
        ledger=ledger,
        flags=rules.all_flags(judged, cfg),
        role_excluded=roster.role_excluded_rows(cleaned),
        suppressed=roster.suppressed_rows(cleaned),
        region_unmatched=match.region_unmatched(previous, matches, cfg),
    )


def sync_reports(run: SyncRun, cfg: SyncConfig) -> dict[str, tuple[str, DataFrame]]:
    """All review reports of a run, by name, with a description."""
    by_role, counts = reports.rpt_role_excluded(run.role_excluded)
    return {
        "summary": ("Counts of the run.", run.summary),
        "live": ("All rows of the directory.", reports.rpt_live(run.directory)),
        "no-region": ("Rows excluded for want of a region.", reports.rpt_no_region(run.flags)),
        "role-excluded": ("Rows excluded for their role.", by_role),
        "role-counts": ("Excluded rows per role.", counts),
        "region-unmatched": ("Rows of the second region nobody matched.", reports.rpt_region_unmatched(run.region_unmatched)),
        "no-photo": ("Visible rows without a photo.", reports.rpt_no_photo(run.directory)),
        "no-page": ("Visible rows of the main region without a page.", reports.rpt_no_page(run.directory, cfg)),
        "flagged": ("Junk, duplicate and incomplete rows.", reports.rpt_flagged(run.flags)),
        "events": ("New, soft-deleted, purged and returned rows.", reports.rpt_events(run.events)),
    }


def run_notes(run: SyncRun, cfg: SyncConfig) -> dict[str, tuple[str, DataFrame]]:
    """What a run tells beside its review reports: the events as lines, and how much the directory covers."""
    return {
        "digest": ("The events as text, by line number.", reports.event_digest(run.events, cfg.grace_days)),
        "coverage": ("Photos and regions of visible rows.", summaries.coverage_stats(run.directory)),
    }


def run_sync(
    raw: DataFrame, previous: DataFrame, cfg: SyncConfig, now: datetime,
    out: str, dry_run: bool = False, fmt: str = "parquet",
) -> SyncRun:
    """A whole run: merge, publish the directory, write the reports, the digest and the coverage.

    A dry run computes the same frames and publishes nothing.
    """
    run = plan_sync(raw, previous, cfg, now)
    if not dry_run:
        run = replace(run, flags=materialise(run.flags, "flags"))
        publish_directory(run.directory, f"{out}/directory.{fmt}", fmt)
        write_reports(sync_reports(run, cfg), f"{out}/reports", now)
        write_reports(run_notes(run, cfg), f"{out}/notes", now)
    return run
