"""Merge of a roster into the directory, and the life of a row that disappears.

The merge builds one table, the ledger: every row of the new directory and every
purged row, with its ``fate``.  The directory, the events and all reports are
plain projections of the ledger, so the joins run once.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import first_nonblank, parse_iso, stamp, truthy
from ..functions.times import moment
from ..schemas import DIRECTORY_COLUMNS, TEMPORARY_COLUMNS
from .lookups import lookup_row, settled
from .match import in_second_region, page_url_assign, tiered_match, unmatched

# Fates of a ledger row.
NEW, UPDATED, REACTIVATED = "new", "updated", "reactivated"
KEPT, JOINT, GRACE, SOFT_DELETE, PURGE = "kept", "joint", "grace", "soft_delete", "purge"
EVENT_FATES = (NEW, SOFT_DELETE, PURGE, REACTIVATED)

LEDGER_COLUMNS = [*DIRECTORY_COLUMNS, *TEMPORARY_COLUMNS, "seq", "pos", "fate", "was_deleted_at"]

NO_EXTRAS = "map<string,string>"


def attach_previous(valid: DataFrame, directory: DataFrame, matches: DataFrame) -> DataFrame:
    """Incoming rows with their previous row's columns as ``p_…`` and the match tier."""
    found = valid.join(matches.withColumnRenamed("in_pos", "pos"), "pos", "left")
    prev = directory.select(
        F.col("pos").alias("p_row"), *[F.col(c).alias(f"p_{c}") for c in DIRECTORY_COLUMNS]
    )
    return lookup_row(found, prev, "row_id", "p_row")


# Field rules.  Each reads an incoming row with its previous row attached.


def matched() -> Column:
    return F.col("p_row").isNotNull()


def photo_seed() -> Column:
    """Previous photo; else the incoming one if it is real; else blank."""
    incoming = F.when(F.col("incoming_photo_real"), F.coalesce("incoming_photo", F.lit("")))
    return first_nonblank(F.col("p_photo"), incoming)


def is_pinned(cfg: SyncConfig) -> Column:
    """Second-account row whose previous row owns its team, office, title and regions."""
    owner = F.col("p_source").isin(cfg.sheet_source, cfg.second_source, cfg.both_source)
    listed = F.array_contains("p_regions", cfg.second_region)
    return (
        matched()
        & (F.col("source") == cfg.second_source)
        & (F.coalesce(owner, F.lit(False)) | F.coalesce(listed, F.lit(False)))
    )


def region_pin(attached: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Previous team, logo, office, title, regions and unmodelled fields of pinned rows."""
    pin = is_pinned(cfg)

    def owned(c: str) -> Column:
        return F.when(pin, F.coalesce(f"p_{c}", c)).otherwise(F.col(c)).alias(c)

    regions = F.when(F.size("p_regions") > 0, F.col("p_regions")).otherwise(F.array(F.lit(cfg.second_region)))
    pinned = {
        **{c: owned(c) for c in ("team", "team_logo", "office", "title")},
        "regions": F.when(pin, regions).otherwise(F.col("regions")).alias("regions"),
        "extras": F.when(pin, F.col("p_extras")).otherwise(F.lit(None).cast(NO_EXTRAS)).alias("extras"),
    }
    rest = [c for c in attached.columns if c not in pinned]
    return attached.select(*rest, *pinned.values())


def logo_rule() -> Column:
    """Previous logo wins when a team is shown; without a team there is no logo."""
    return (
        F.when(~matched(), F.col("team_logo"))
        .when(~truthy(F.col("team")), F.lit(""))
        .when(truthy(F.col("p_team_logo")), F.col("p_team_logo"))
        .otherwise(F.col("team_logo"))
    )


def is_reactivated() -> Column:
    return matched() & truthy(F.col("p_soft_deleted_at"))


def visibility() -> Column:
    """Hidden as before; new rows and rows back from soft-delete are shown.

    A row hidden by hand before it was soft-deleted comes back visible too.
    """
    return F.when(is_reactivated(), F.lit(False)).otherwise(F.coalesce("p_hidden", F.lit(False)))


def source_rule(cfg: SyncConfig) -> Column:
    """The "both" tag stays, except on rows of the second account."""
    both = F.coalesce(F.col("p_source") == cfg.both_source, F.lit(False))
    return F.when(both & (F.col("source") != cfg.second_source), F.lit(cfg.both_source)).otherwise(F.col("source"))


def field_merge(attached: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Incoming rows as ledger rows, every field from the side that owns it.

    The pin comes first, because the logo rule reads the pinned team.
    """
    pinned = region_pin(attached, cfg)
    old = {c: F.coalesce(f"p_{c}", F.lit("")) for c in ("page_url", "second_id", "photo_source", "photo_hash")}
    return pinned.select(
        "email", "name", "phone", "title", "team",
        logo_rule().alias("team_logo"),
        "regions", "office",
        photo_seed().alias("photo"),
        old["page_url"].alias("page_url"),
        "id",
        old["second_id"].alias("second_id"),
        source_rule(cfg).alias("source"),
        old["photo_source"].alias("photo_source"),
        old["photo_hash"].alias("photo_hash"),
        visibility().alias("hidden"),
        F.lit(None).cast("string").alias("soft_deleted_at"),
        "extras", "incoming_photo", "incoming_photo_real",
        F.lit(0).alias("seq"),
        "pos",
        F.when(~matched(), NEW).when(is_reactivated(), REACTIVATED).otherwise(F.lit(UPDATED)).alias("fate"),
        F.nullif("p_soft_deleted_at", F.lit("")).alias("was_deleted_at"),
    )


def fate_of_unmatched(cfg: SyncConfig, now: datetime) -> Column:
    """What becomes of a previous row nobody matched.

    A deletion time that cannot be parsed counts as none: the row is stamped anew.
    """
    since = parse_iso(F.col("soft_deleted_at"))
    cutoff = moment(now - timedelta(days=cfg.grace_days))
    carry_region = not (cfg.second_enabled and cfg.soft_delete_second_region)
    joint = F.lower("email").isin(*cfg.joint_emails) if cfg.joint_emails else F.lit(False)
    return (
        F.when(in_second_region(cfg) & F.lit(carry_region), KEPT)
        .when(joint & (F.col("source") == cfg.joint_source), JOINT)
        .when(since < cutoff, PURGE)
        .when(since.isNotNull(), GRACE)
        .otherwise(F.lit(SOFT_DELETE))
    )


def carry_unmatched(gone: DataFrame, cfg: SyncConfig, now: datetime) -> DataFrame:
    """Unmatched previous rows as ledger rows."""
    fated = gone.withColumn("fate", fate_of_unmatched(cfg, now))
    stamped = F.col("fate") == SOFT_DELETE
    types = {"incoming_photo": "string", "incoming_photo_real": "boolean"}
    out = fated.withColumns(
        {
            "was_deleted_at": F.nullif("soft_deleted_at", F.lit("")),
            "hidden": F.when(stamped, F.lit(True)).otherwise(F.col("hidden")),
            "soft_deleted_at": F.when(stamped, F.lit(stamp(now))).otherwise(F.col("soft_deleted_at")),
            "seq": F.lit(1),
            **{c: F.lit(None).cast(types[c]) for c in TEMPORARY_COLUMNS},
        }
    )
    return out.select(*LEDGER_COLUMNS)


def merge_ledger(
    valid: DataFrame, directory: DataFrame, cfg: SyncConfig, now: datetime, matches: DataFrame | None = None
) -> DataFrame:
    """Valid incoming rows and the previous directory to the ledger of this run.

    Two left joins (to the match of a row, to the matched row) and one anti-join
    on row numbers.  A previous row that very many incoming rows match makes
    only the left side of a join uneven, which adaptive execution splits.
    """
    if matches is None:
        matches = tiered_match(valid, directory, cfg)
    incoming = settled(page_url_assign(field_merge(attach_previous(valid, directory, matches), cfg), cfg))
    carried = carry_unmatched(unmatched(directory, matches), cfg, now)
    return incoming.select(*LEDGER_COLUMNS).unionByName(carried)


def ledger_directory(ledger: DataFrame) -> DataFrame:
    """The new directory: all ledger rows but the purged ones."""
    return ledger.where(F.col("fate") != PURGE).drop("fate", "was_deleted_at")


def directory_merge(valid: DataFrame, directory: DataFrame, cfg: SyncConfig, now: datetime) -> DataFrame:
    """The directory after this snapshot."""
    return ledger_directory(merge_ledger(valid, directory, cfg, now))


def lifecycle_events(ledger: DataFrame) -> DataFrame:
    """One row per new, soft-deleted, purged or returned person."""
    is_new = F.col("fate") == NEW
    shown = F.col("fate").isin(NEW, SOFT_DELETE)
    return ledger.where(F.col("fate").isin(*EVENT_FATES)).select(
        F.col("fate").alias("kind"),
        "name",
        "email",
        F.when(shown, F.col("regions")).alias("regions"),
        F.when(shown, F.col("team")).alias("team"),
        F.when(is_new, F.col("office")).alias("office"),
        F.when(is_new, F.col("id")).alias("id"),
        F.when(is_new, truthy(F.col("photo"))).alias("has_photo"),
        F.when(F.col("fate").isin(PURGE, REACTIVATED), F.col("was_deleted_at")).alias("soft_deleted_at"),
        "pos",
    )


def new_rows(ledger: DataFrame) -> DataFrame:
    return lifecycle_events(ledger.where(F.col("fate") == NEW))


def reactivated(ledger: DataFrame) -> DataFrame:
    return lifecycle_events(ledger.where(F.col("fate") == REACTIVATED))


def _fate(name: str):
    def pick(gone: DataFrame, cfg: SyncConfig, now: datetime) -> DataFrame:
        return carry_unmatched(gone, cfg, now).where(F.col("fate") == name)

    pick.__name__ = name
    return pick


# Unmatched previous rows of one fate each, as they go on.
soft_delete = _fate(SOFT_DELETE)
grace_keep = _fate(GRACE)
purge = _fate(PURGE)
joint_keep = _fate(JOINT)
region_keep = _fate(KEPT)
