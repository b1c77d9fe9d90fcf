"""Cleaning of raw roster rows, and the two-account join before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import (
    clean_title,
    first_nonblank,
    fmt_phone,
    in_list_ci,
    infer_region,
    joined_name,
    null_if_blank,
    split_list,
    strip,
    strip_prefix,
    valid_url,
)
from .lookups import lookup, lookup_default, mark_members, settled

PARSED_COLUMNS = [
    "email", "name", "phone", "title", "team", "team_logo", "regions", "office", "photo",
    "page_url", "id", "incoming_photo", "incoming_photo_real", "second_id", "source", "pos",
]


def _email(c: str | Column = "email") -> Column:
    return strip(F.lower(F.col(c) if isinstance(c, str) else c))


def _raw_name() -> Column:
    return strip(F.concat_ws(" ", F.coalesce("first_name", F.lit("")), F.coalesce("last_name", F.lit(""))))


def cross_account_tag(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Secondary rows with ``cause``: id or email when the primary has them, else null.

    One join per key.  A join on "id or email" would be a nested loop.
    """
    ids = primary.select(F.nullif("id", F.lit("")).alias("k")).where("k is not null").distinct()
    mails = primary.select(F.nullif(_email(), F.lit("")).alias("k")).where("k is not null").distinct()
    by_id = lookup(secondary, ids.withColumn("__by_id", F.lit(True)), F.nullif("id", F.lit("")), "k")
    by_mail = lookup(by_id, mails.withColumn("__by_mail", F.lit(True)), F.nullif(_email(), F.lit("")), "k")
    cause = F.when(F.col("__by_id"), "id").when(F.col("__by_mail"), "email")
    return by_mail.withColumn("cause", cause).drop("__by_id", "__by_mail")


def cross_account_dedup(primary: DataFrame, secondary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Secondary rows the primary account lacks, and the number dropped by cause."""
    tagged = cross_account_tag(primary, secondary)
    kept = tagged.where(F.col("cause").isNull()).drop("cause")
    counts = tagged.where(F.col("cause").isNotNull()).groupBy("cause").agg(F.count(F.lit(1)).alias("dropped"))
    return kept, counts


def merge_accounts(raw: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Rows of the main account, and those of the second that the main one lacks."""
    main = raw.where(F.col("account") == cfg.main_account)
    second = raw.where(F.col("account") != cfg.main_account)
    return main.unionByName(cross_account_dedup(main, second)[0])


def hide_team(team: Column, id_: Column, cfg: SyncConfig) -> Column:
    """Blank the team when its name, or the person's id, is listed."""
    hidden = in_list_ci(team, cfg.hide_team_names)
    if cfg.hide_team_ids:
        hidden = hidden | F.coalesce(id_.isin(*sorted(cfg.hide_team_ids)), F.lit(False))
    return F.when(hidden, F.lit("")).otherwise(team)


def assign_region(regions: Column, office: Column, second: Column, cfg: SyncConfig) -> Column:
    """Declared regions, else the office's; the second account's region in front."""
    guess = infer_region(office, cfg.office_regions)
    filled = F.when((F.size(regions) == 0) & guess.isNotNull(), F.array(guess)).otherwise(regions)
    own = F.lit(cfg.second_region)
    return F.when(second & ~F.array_contains(filled, own), F.array_prepend(filled, own)).otherwise(filled)


def classify_roster(raw: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Every raw row cleaned, with ``dropped``: why it is not in the directory, or null.

    One pass serves the kept rows and both audits.  The reasons are tried in
    order: blank e-mail, suppressed id, inactive, blank name, role.

    The cleaning is laid out in steps: a column that the next step reads more
    than once stays a column of its own, which keeps generated methods small
    enough to be compiled.
    """
    col = F.col
    base = raw.select(
        _email().alias("email"),
        *[strip_prefix(col(c)).alias(c) for c in ("first_name", "last_name", "preferred_name")],
        strip(col("name")).alias("full_name"),
        _raw_name().alias("raw_name"),
        first_nonblank(col("phone"), col("phone_number")).alias("phone"),
        F.coalesce("title", F.lit("")).alias("title"),
        first_nonblank(col("team"), col("team_alt"), col("team_name")).alias("team"),
        split_list(first_nonblank(col("region"), col("region_alt"))).alias("regions"),
        first_nonblank(col("office"), col("office_name")).alias("office"),
        F.nullif("id", F.lit("")).alias("id"),
        first_nonblank(
            col("profile_picture_url"), col("photo_url"), col("avatar_url"), col("image_url")
        ).alias("incoming_photo"),
        F.coalesce("avatar_added", F.lit(False)).alias("incoming_photo_real"),
        (col("account") == cfg.second_account).alias("second"),
        strip(col("role")).alias("role"),
        "active",
        "pos",
    )
    cleaned = base.select(
        "email",
        joined_name(col("first_name"), col("last_name"), col("preferred_name"), col("full_name")).alias("name"),
        "raw_name",
        fmt_phone(col("phone")).alias("phone"),
        clean_title(col("title"), cfg.default_title, cfg.generic_titles, cfg.title_suffix).alias("title"),
        hide_team(col("team"), col("id"), cfg).alias("team"),
        assign_region(col("regions"), col("office"), col("second"), cfg).alias("regions"),
        "office",
        F.lit("").alias("photo"),
        F.lit("").alias("page_url"),
        "id",
        valid_url(col("incoming_photo")).alias("incoming_photo"),
        "incoming_photo_real",
        F.lit("").alias("second_id"),
        F.when(col("second"), cfg.second_source).otherwise(F.lit(cfg.main_source)).alias("source"),
        "role",
        "active",
        "pos",
    )
    marked = mark_members(settled(cleaned), "id", cfg.suppressed_ids, "__suppressed")
    dropped = (
        F.when(col("email") == "", "blank_email")
        .when(col("__suppressed"), "suppressed")
        .when(col("active").eqNullSafe(False), "inactive")
        .when(col("name").isNull(), "blank_name")
        .when((col("role") != "") & ~in_list_ci(col("role"), cfg.allowed_roles), "role")
    )
    tagged = marked.withColumn("dropped", dropped).drop("__suppressed", "active")
    return lookup_default(tagged, "team", cfg.team_logos, "team_logo")


def parsed_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("dropped").isNull()).select(*PARSED_COLUMNS)


def suppressed_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("dropped") == "suppressed").select(
        F.col("raw_name").alias("name"), "email", "id", F.lit("partner in a joint listing").alias("reason"), "pos"
    )


def role_excluded_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("dropped") == "role").select("name", "email", "role", "id", "pos")


def parse_roster(raw: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Raw rows to directory rows."""
    return parsed_rows(classify_roster(raw, cfg))


def suppress_ids(raw: DataFrame, ids) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is not listed, and an audit of those whose id is."""
    marked = mark_members(raw.where(null_if_blank(F.col("email")).isNotNull()), "id", ids, "__hit")
    audit = marked.where("__hit").select(
        _raw_name().alias("name"), _email().alias("email"), "id", F.lit("partner in a joint listing").alias("reason"), "pos"
    )
    return marked.where("not __hit").drop("__hit"), audit


def drop_inactive(raw: DataFrame) -> DataFrame:
    """Drop a row only when ``active`` is false; a missing value passes."""
    return raw.where(~F.col("active").eqNullSafe(False))


def role_gate(rows: DataFrame, cfg: SyncConfig) -> tuple[DataFrame, DataFrame]:
    """Rows with an allowed or blank role, and an audit of the others."""
    role = strip(F.col("role"))
    allowed = (role == "") | in_list_ci(role, cfg.allowed_roles)
    audit = rows.where(~allowed).select("name", "email", role.alias("role"), "id", "pos")
    return rows.where(allowed), audit
