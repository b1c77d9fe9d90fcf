"""Rules that keep rows out of the directory, and flags for review."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FLAG_DUPLICATE, FLAG_JUNK, FLAG_MISSING, FLAG_NO_REGION, SyncConfig
from ..functions import name_key
from .lookups import lookup

# Texts of the review reports.
ACTIONS = {
    FLAG_JUNK: "Excluded from the directory. Review in the source system.",
    FLAG_NO_REGION: "Excluded from site. Assign a region in the source system to make visible.",
    FLAG_MISSING: "Shown on site. Update the profile in the source system.",
    FLAG_DUPLICATE: "Verify these are different people or merge/deactivate in the source system.",
}
NO_REGION_REASON = "No region assigned in the source system"
EMAIL_REASON = "email matches junk pattern: "
NAME_REASON = "name matches junk pattern: "
STAFF_REASON = "staff/internal account: "
NUMBERED_REASON = "numbered prefix account with no brokerage email"
NUMBERED = r"^0[0-9][0-9] - "
DUPLICATE_REASON = "Same name found with %d different emails: all rows of name key %s"


def junk_reason(email: Column, name: Column, cfg: SyncConfig) -> Column:
    """Reason of the first junk rule that hits, or null.

    One alternation over all patterns of a list is tried first, so that a clean
    row costs one match per list and not one per pattern.
    """
    mail, low = F.lower(email), F.lower(name)
    lists = [
        (mail, cfg.junk_email_patterns, EMAIL_REASON),
        (low, cfg.junk_name_patterns, NAME_REASON),
        (mail, cfg.staff_email_patterns, STAFF_REASON),
    ]
    found = []
    for text, patterns, label in lists:
        if patterns:
            any_of = "|".join(f"(?:{p})" for p in patterns)
            first = reduce(
                lambda chain, p: chain.when(text.rlike(p), F.lit(label + p)),
                patterns[1:],
                F.when(text.rlike(patterns[0]), F.lit(label + patterns[0])),
            )
            found.append(F.when(text.rlike(any_of), first))
    numbered = name.rlike(NUMBERED) & ~email.endswith(cfg.house_domain)
    return F.coalesce(*found, F.when(numbered, F.lit(NUMBERED_REASON)))


def missing_fields(cfg: SyncConfig) -> Column:
    """Comma list of missing fields; team and office are not asked of the second region."""
    col = F.col
    second = (col("source") == cfg.second_source) | F.array_contains("regions", cfg.second_region)
    issues = F.array_compact(
        F.array(
            F.when((col("office") == "") & ~second, F.lit("no_office")),
            F.when(col("phone") == "", F.lit("no_phone")),
            F.when((col("team") == "") & ~second, F.lit("no_team")),
        )
    )
    return F.nullif(F.array_join(issues, ", "), F.lit(""))


def judge_rows(parsed: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Every parsed row with its ``flag`` and ``reason``, and whether it is kept.

    A row gets at most one of the three row flags (junk, then no region, then
    missing data), so one pass gives both the valid rows and these flags.
    """
    judged = parsed.withColumn("__junk", junk_reason(F.col("email"), F.col("name"), cfg)).withColumn(
        "__missing", missing_fields(cfg)
    )
    bare = F.size("regions") == 0
    return judged.select(
        *parsed.columns,
        F.when(F.col("__junk").isNotNull(), FLAG_JUNK)
        .when(bare, FLAG_NO_REGION)
        .when(F.col("__missing").isNotNull(), FLAG_MISSING)
        .alias("flag"),
        F.when(F.col("__junk").isNotNull(), F.col("__junk"))
        .when(bare, NO_REGION_REASON)
        .otherwise(F.col("__missing"))
        .alias("reason"),
        (F.col("__junk").isNull() & ~bare).alias("kept"),
    )


def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.where("kept").drop("flag", "reason", "kept")


def _action() -> Column:
    return F.coalesce(*[F.when(F.col("flag") == f, F.lit(text)) for f, text in ACTIONS.items()])


def row_flags(judged: DataFrame) -> DataFrame:
    """One flag row per junk, no-region or missing-data row."""
    placed = F.col("flag") != FLAG_JUNK
    return judged.where(F.col("flag").isNotNull()).select(
        "name",
        "email",
        "id",
        F.when(placed, F.col("office")).alias("office"),
        F.when(placed, F.col("team")).alias("team"),
        F.when(F.col("flag") == FLAG_MISSING, F.col("regions")).alias("regions"),
        "flag",
        "reason",
        _action().alias("action"),
        "pos",
    )


def junk_rules(rows: DataFrame, cfg: SyncConfig) -> tuple[DataFrame, DataFrame]:
    """Rows no junk rule hits, and the hits with their reason."""
    judged = rows.withColumn("reason", junk_reason(F.col("email"), F.col("name"), cfg))
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def no_region(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    bare = F.size("regions") == 0
    flags = rows.where(bare).select(
        "name", "email", "id", "office", "team", F.lit(FLAG_NO_REGION).alias("flag"),
        F.lit(NO_REGION_REASON).alias("reason"), F.lit(ACTIONS[FLAG_NO_REGION]).alias("action"), "pos",
    )
    return rows.where(~bare), flags


def missing_data(rows: DataFrame, cfg: SyncConfig) -> DataFrame:
    """A flag for every row that lacks a phone, an office or a team."""
    return (
        rows.withColumn("reason", missing_fields(cfg))
        .where("reason is not null")
        .select(
            "name", "email", "id", "office", "regions", "team", F.lit(FLAG_MISSING).alias("flag"), "reason",
            F.lit(ACTIONS[FLAG_MISSING]).alias("action"), "pos",
        )
    )


def dup_members(valid: DataFrame) -> DataFrame:
    """Every row whose name key is shared, with the size of its group.

    The count per key combines before the shuffle, so no group is ever gathered
    in one place.
    """
    keyed = valid.select("pos", "email", "name", name_key(F.col("name")).alias("name_key")).where("name_key <> ''")
    shared = keyed.groupBy("name_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = lookup(keyed, shared.withColumnRenamed("name_key", "__shared"), F.col("name_key"), "__shared")
    return found.where("n is not null")


def dup_names(valid: DataFrame, cfg: SyncConfig) -> DataFrame:
    """One flag for every row that shares its name key with another row.

    The reason has the size of the group and its key, whatever the size; the
    group's e-mails are the rows of ``dup_members`` with that key.  A flag shows
    the name of the first row with that e-mail.
    """
    names = valid.groupBy(F.col("email").alias("__email")).agg(F.min_by("name", "pos").alias("__name"))
    return lookup(dup_members(valid), names, F.col("email"), "__email").where("email is not null").select(
        F.col("__name").alias("name"),
        "email",
        F.lit(FLAG_DUPLICATE).alias("flag"),
        F.format_string(DUPLICATE_REASON, "n", "name_key").alias("reason"),
        F.lit(ACTIONS[FLAG_DUPLICATE]).alias("action"),
        "pos",
    )


def flag_union(*flags: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), flags)


def all_flags(judged: DataFrame, cfg: SyncConfig) -> DataFrame:
    """All flags of a run as one table."""
    return flag_union(row_flags(judged), dup_names(valid_rows(judged), cfg))


def safety_gate(valid: DataFrame, previous: DataFrame, cfg: SyncConfig) -> DataFrame:
    """One row that says whether the new rows may be published.

    The share compares all valid rows with the previous rows outside the second
    region.  Both counts come from one aggregate over a union.
    """
    second = F.array_contains("regions", cfg.second_region) | (F.col("source") == cfg.sheet_source)
    counted = previous.select(
        F.lit(0).alias("v"), F.lit(1).alias("p"), F.when(F.coalesce(second, F.lit(False)), 0).otherwise(1).alias("m")
    ).unionAll(valid.select(F.lit(1), F.lit(0), F.lit(0)))
    totals = counted.agg(
        F.coalesce(F.sum("v"), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("previous_rows"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("previous_main_rows"),
    )
    share = F.try_divide(F.col("valid_rows").cast("double"), F.col("previous_main_rows").cast("double"))
    reason = (
        F.when(F.col("valid_rows") == 0, "no valid rows after filtering")
        .when(F.col("valid_rows") < cfg.min_rows, "fewer valid rows than the minimum")
        .when(share < cfg.min_share, "too few valid rows against the previous directory")
    )
    return totals.select("*", share.alias("share"), reason.alias("refused")).withColumn(
        "publish", F.col("refused").isNull()
    )
