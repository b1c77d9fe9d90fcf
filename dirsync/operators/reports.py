"""Review reports: projections of the ledger, the flags and the audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FLAG_DUPLICATE, FLAG_JUNK, FLAG_MISSING, FLAG_NO_REGION, SyncConfig
from ..functions import event_line, first_nonblank, slugify, truthy
from .lifecycle import EVENT_FATES, NEW, PURGE, REACTIVATED, SOFT_DELETE
from .match import in_second_region
from .ordering import number_rows, sort_name, sort_role
from .summaries import role_counts


# Headlines of the digest.
SECTION_HEADS = {
    NEW: "%d new agent(s) added:",
    SOFT_DELETE: "%d agent(s) soft-deleted (gone from the source, hidden on site, {days}-day grace before purge):",
    PURGE: "%d agent(s) purged (gone for {days}+ days):",
    REACTIVATED: "%d agent(s) reactivated (reappeared in the source):",
}


def rpt_live(directory: DataFrame) -> DataFrame:
    """All rows, with what each has."""
    return sort_name(directory).select(
        "name", "email", "regions",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("team", "office", "phone")],
        truthy(F.col("photo")).alias("has_photo"),
        truthy(F.col("page_url")).alias("has_profile"),
        F.coalesce("hidden", F.lit(False)).alias("hidden"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("source", "id", "second_id")],
    )


def rpt_no_region(flags: DataFrame) -> DataFrame:
    return sort_name(flags.where(F.col("flag") == FLAG_NO_REGION))


def rpt_role_excluded(audit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audit rows by role and name, and the number of rows per role."""
    return sort_role(audit), role_counts(audit)


def rpt_region_unmatched(rows: DataFrame) -> DataFrame:
    return sort_name(rows).select("name", "email", "team", "regions", "source")


def _visible() -> Column:
    return ~F.coalesce("hidden", F.lit(False))


def rpt_no_photo(directory: DataFrame) -> DataFrame:
    bare = directory.where(_visible() & ~truthy(F.col("photo")))
    return sort_name(bare).select("name", "email", "regions", "team", "source", "id", "second_id")


def rpt_no_page(directory: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Visible rows of the main region without a page url, with the url they should get."""
    main = ~in_second_region(cfg) & ~F.coalesce(F.col("source") == cfg.second_source, F.lit(False))
    bare = sort_name(directory.where(_visible() & main & ~truthy(F.col("page_url"))))
    slug = slugify(F.coalesce("name", F.lit("")))
    return bare.select(
        "name", "email", "regions", "team", "source", "id", "second_id",
        slug.alias("suggested_slug"),
        F.concat(F.lit(cfg.page_base + "/"), slug).alias("suggested_url"),
    )


def rpt_flagged(flags: DataFrame) -> DataFrame:
    return flags.where(F.col("flag").isin(FLAG_JUNK, FLAG_DUPLICATE, FLAG_MISSING))


def _section(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, F.lit(i)) for i, k in enumerate(EVENT_FATES)])


def rpt_events(events: DataFrame) -> DataFrame:
    """The four event lists in order, one row per event.

    Lists stay rows: a list in one cell would gather all its events in one task.
    """
    return events.orderBy(_section(F.col("kind")), "pos")


def event_digest(events: DataFrame, grace_days: int = 30, aborted: str | None = None) -> DataFrame:
    """The events as numbered text lines, section by section; no rows if there are none.

    Line numbers come from block-wise numbering within a kind, shifted by the
    sizes of the sections before it; there are at most four sections.
    """
    kind = F.col("kind")
    top = 1 if aborted else 0
    sizes = events.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(_section(kind)).rowsBetween(Window.unboundedPreceding, -1)
    sections = sizes.withColumn("at", F.coalesce(F.sum(F.col("n") + 2).over(before), F.lit(0)) + F.lit(top))
    head = F.coalesce(
        *[F.when(kind == k, F.format_string(t.format(days=grace_days), "n")) for k, t in SECTION_HEADS.items()]
    )
    titles = sections.select(
        F.inline(
            F.array(
                F.struct((F.col("at") + 1).alias("line_no"), F.lit("").alias("line")),
                F.struct((F.col("at") + 2).alias("line_no"), head.alias("line")),
            )
        )
    )
    name, email = F.col("name"), F.col("email")
    team = first_nonblank(F.col("team"), F.lit("Solo agent"))
    regions = first_nonblank(F.array_join("regions", ", "), F.lit("No region"))
    photo = F.when(F.col("has_photo"), "").otherwise(F.lit(" [no photo yet]"))
    line = (
        F.when(kind == NEW, F.concat(event_line("+", name, email, team, regions), photo))
        .when(kind == SOFT_DELETE, event_line("-", name, email, team, regions))
        .when(
            kind == PURGE,
            F.concat(
                event_line("✗", name, email),
                F.lit(" (soft-deleted "), F.coalesce("soft_deleted_at", F.lit("")), F.lit(")"),
            ),
        )
        .otherwise(event_line("↻", name, email))
    )
    numbered = number_rows(events, "kind", "pos", "__n").withColumn("line", line).select("kind", "__n", "line")
    # One row per kind, four at most.
    items = numbered.join(F.broadcast(sections.select("kind", "at")), "kind").select(
        (F.col("at") + 2 + F.col("__n")).alias("line_no"), "line"
    )
    lines = titles.unionByName(items)
    if aborted:
        first = events.sparkSession.range(1).select(
            F.lit(1).cast("bigint").alias("line_no"), F.lit(f"ABORTED: {aborted}").alias("line")
        )
        lines = first.unionByName(lines)
    return lines
