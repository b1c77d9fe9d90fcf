"""Which photos need work, what came of the attempts, and what to remember.

``assets`` is the list of stored photo files, one row per ``key``.  Attempts are
tables a fetcher left behind: (key, ok, reason, source_url), one row per key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AssetConfig
from ..functions import entity_key, is_self_hosted, is_trusted, stamp, strip, truthy, url_hash
from .lookups import lookup, settled
from .ordering import first_rows

ACQUIRE_REASONS = (
    "second_account_source_a", "upgrade_to_source_a", "source_a_changed", "no_photo_at_all",
)


def with_asset(rows: DataFrame, assets: DataFrame) -> DataFrame:
    """Add the entity ``key`` and whether its file is stored."""
    keyed = rows.withColumn("key", entity_key(F.col("id"), F.col("email")))
    stored = assets.select(F.col("key").alias("__asset")).distinct().withColumn("__stored", F.lit(True))
    return (
        lookup(keyed, stored, F.col("key"), "__asset")
        .withColumn("stored", F.coalesce("__stored", F.lit(False)))
        .drop("__stored")
    )


def _incoming() -> Column:
    return strip(F.col("incoming_photo"))


def _real_incoming() -> Column:
    return F.coalesce("incoming_photo_real", F.lit(False)) & (_incoming() != "")


def _facts(rows: DataFrame, cfg: AssetConfig) -> DataFrame:
    """What the decision asks of a row, each as a flag."""
    photo = strip(F.col("photo"))
    return settled(
        rows.withColumns(
            {
                "__hosted": is_self_hosted(photo, cfg.self_host_marks),
                "__trusted": is_trusted(photo, cfg.trusted_hosts),
                "__blank": photo == "",
                "__real": _real_incoming(),
                "__owner_a": strip(F.col("photo_source")) == cfg.source_a,
                "__same": strip(F.col("photo_hash")) == url_hash(_incoming()),
                "__second": strip(F.col("source")).isin(*cfg.excluded_sources),
                "__deleted": truthy(F.col("soft_deleted_at")),
            }
        )
    )


def decision_reason() -> Column:
    """Why a row does or does not need photo work; the first rule that holds."""
    col = F.col
    current = col("__hosted") & col("stored")
    # The second account has source A only.
    second = (
        F.when(~col("__real"), "second_account_no_photo")
        .when(col("__owner_a") & col("__same") & current, "fresh")
        .otherwise(F.lit("second_account_source_a"))
    )
    # A real photo at source A wins over whatever is there.
    source_a = (
        F.when(~col("__owner_a"), "upgrade_to_source_a")
        .when(col("__same") & current, "fresh")
        .otherwise(F.lit("source_a_changed"))
    )
    return (
        F.when(F.coalesce("hidden", F.lit(False)), "hidden")
        .when(col("__deleted"), "soft_deleted")
        .when(col("key").isNull(), "no_key")
        .when(col("__second"), second)
        .when(col("__real"), source_a)
        .when(col("__trusted"), "external_working_photo")
        .when(current, "fresh")
        .when(col("__hosted") | col("__blank"), "no_photo_at_all")
        .otherwise(F.lit("unknown_external_url"))
    )


def asset_decision(rows: DataFrame, assets: DataFrame, cfg: AssetConfig) -> DataFrame:
    """Rows with their key, stored flag, ``reason`` and whether work ``needs`` doing."""
    known = with_asset(rows, assets)
    judged = _facts(known, cfg).select(*known.columns, decision_reason().alias("reason"))
    return judged.withColumn("needs", F.col("reason").isin(*ACQUIRE_REASONS))


def _forced(name: str | None) -> Column:
    return F.lower("name") == name.lower() if name else F.lit(False)


def force_limit(decided: DataFrame, force: str | None = None, limit: int | None = None) -> DataFrame:
    """Work queue: rows that need work or are forced by name, the first ``limit`` by position.

    The last position of the queue is found by counting, so no task holds the
    queue, whatever the limit.
    """
    forced = F.coalesce(_forced(force), F.lit(False))
    queue = decided.where((F.col("needs") | forced) & F.col("key").isNotNull()).withColumn(
        "reason", F.when(forced, "forced").otherwise(F.col("reason"))
    )
    return first_rows(queue, limit) if limit else queue


def skipped(decided: DataFrame, force: str | None = None) -> DataFrame:
    """Rows left out of the queue, with the reason."""
    forced = F.coalesce(_forced(force), F.lit(False))
    taken = (F.col("needs") | forced) & F.col("key").isNotNull()
    reason = F.when(F.col("needs") | forced, "no_key").otherwise(F.col("reason"))
    return decided.where(~taken).withColumn("reason", reason)


def asset_pending(rows: DataFrame, cache: DataFrame, assets: DataFrame, cfg: AssetConfig, bulk: bool = False) -> DataFrame:
    """Rows with ``pending``: is the photo from the known uploader and not yet re-encoded?

    Done means cached under the same id with the file stored; ``bulk`` redoes all.
    """
    known = F.coalesce(F.col("photo").startswith(cfg.optimise_prefix), F.lit(False))
    if bulk:
        return rows.withColumn("pending", known)
    cached = cache.select(F.col("source_url").alias("__url"), F.coalesce("id", F.lit("")).alias("__cached_id"))
    stored = assets.select(F.col("key").alias("__asset")).distinct().withColumn("__stored", F.lit(True))
    found = lookup(rows, cached, F.when(known, F.col("photo")), "__url")
    found = lookup(found, stored, F.when(known, F.nullif("id", F.lit(""))), "__asset")
    done = (F.col("__cached_id") == F.coalesce("id", F.lit(""))) & F.col("__stored")
    return found.withColumn("pending", known & ~F.coalesce(done, F.lit(False))).drop("__cached_id", "__stored")


def _waits(last: Column, run: int) -> Column:
    """On every other run after a failed attempt."""
    diff = F.lit(run) - last
    return F.coalesce((diff > 0) & (F.pmod(diff, F.lit(2)) == 1), F.lit(False))


def retry_cooldown(rows: DataFrame, retries: DataFrame, run: int) -> DataFrame:
    """Add ``cooldown``: true on every other run after a failed attempt."""
    last = retries.select(F.col("key").alias("__k"), F.col("last_run").alias("__last"))
    found = lookup(rows, last, F.col("key"), "__k")
    return found.withColumn("cooldown", _waits(F.col("__last"), run)).drop("__last")


def _known_of_keys(attempts_a: DataFrame, attempts_b: DataFrame, retries: DataFrame) -> DataFrame:
    """What three tables say of a key, as one row per key.

    Of a key that a table of attempts has more than once, one row is taken whole,
    one that succeeded before others.  The queue is then joined, and its rows
    shuffled, once instead of three times.
    """

    def attempt(table: DataFrame, side: str) -> DataFrame:
        said = F.struct(F.coalesce("ok", F.lit(False)).alias("ok"), F.col("reason"), F.col("source_url").alias("url"))
        return table.select(F.col("key").alias("__k"), said.alias(side))

    last = retries.select(F.col("key").alias("__k"), F.col("last_run").alias("__last"))
    rows = attempt(attempts_a, "a")
    for other in (attempt(attempts_b, "b"), last):
        rows = rows.unionByName(other, allowMissingColumns=True)
    known = rows.groupBy("__k").agg(*[F.max(c).alias(c) for c in rows.columns if c != "__k"])
    fields = [F.col(f"{side}.{f}").alias(f"{side}_{f}") for side in ("a", "b") for f in ("ok", "reason", "url")]
    return known.select("__k", "__last", *fields)


def asset_cascade(
    queue: DataFrame, attempts_a: DataFrame, attempts_b: DataFrame, retries: DataFrame,
    run: int, now: datetime, cfg: AssetConfig,
) -> DataFrame:
    """What became of each queued row: an event, and whether a retry is recorded.

    Success at A; no fallback for the second account; A's photo is kept; on
    cooldown; success at B; the stored photo, or any photo, is kept; nothing.
    """
    rows = lookup(queue, _known_of_keys(attempts_a, attempts_b, retries), F.col("key"), "__k")
    rows = rows.withColumn("cooldown", _waits(F.col("__last"), run))
    # Reasons the row itself gives come before what the fetcher reports.
    fail_a = (
        F.when(~F.coalesce("incoming_photo_real", F.lit(False)), "not_flagged_real")
        .when(_incoming() == "", "no_url")
        .when(~_incoming().startswith("http"), "invalid_url")
        .when(~F.coalesce("a_ok", F.lit(False)), F.coalesce("a_reason", F.lit("not_attempted")))
    )
    fail_b = F.when(strip(F.col("page_url")) == "", "no_page_url").when(
        ~F.coalesce("b_ok", F.lit(False)), F.coalesce("b_reason", F.lit("page_fetch_failed"))
    )
    rows = rows.withColumns({"fail_a": fail_a, "fail_b": fail_b})
    photo = F.coalesce("photo", F.lit(""))
    status = (
        F.when(F.col("fail_a").isNull(), "success_a")
        .when(strip(F.col("source")).isin(*cfg.excluded_sources), "second_account_source_a_failed")
        .when(F.col("photo_source") == cfg.source_a, f"kept_existing_{cfg.source_a}")
        .when(F.col("cooldown"), f"{cfg.source_b}_cooldown")
        .when(F.col("fail_b").isNull(), "success_b")
        .when(is_self_hosted(photo, cfg.self_host_marks) & F.col("stored"), "kept_existing")
        .when(photo != "", "failed_kept_existing")
        .otherwise(F.lit("failed_no_photo"))
    )
    rows = settled(rows.withColumn("__status", status))
    won_a, won_b = F.col("__status") == "success_a", F.col("__status") == "success_b"
    tried_b = F.col("__status").isin("kept_existing", "failed_kept_existing", "failed_no_photo")
    alone = F.col("__status") == "second_account_source_a_failed"
    return rows.select(
        "name",
        "key",
        "reason",
        F.lit(stamp(now)).alias("attempted_at"),
        F.when(won_a | won_b, "success").otherwise(F.col("__status")).alias("status"),
        F.when(won_a, cfg.source_a).when(won_b, cfg.source_b).alias("source"),
        F.when(won_a, _incoming()).when(won_b, F.col("b_url")).alias("source_url"),
        F.when(~won_a, F.col("fail_a")).alias("failure_a"),
        F.when(tried_b, F.col("fail_b")).alias("failure_b"),
        F.when(won_a | won_b, True).when(alone | tried_b, False).alias("recorded"),
        F.when(alone, F.concat(F.lit("A:"), F.col("fail_a")))
        .when(tried_b, F.concat(F.lit("A:"), F.col("fail_a"), F.lit(",B:"), F.col("fail_b")))
        .alias("retry_reason"),
        "pos",
    )


def asset_apply(directory: DataFrame, events: DataFrame, cfg: AssetConfig) -> DataFrame:
    """Directory with the photo, its source and hash set where an attempt succeeded."""
    won = events.where(F.col("status") == "success").select(
        "pos",
        F.concat(F.lit(cfg.public_base + "/"), F.col("key"), F.lit(cfg.asset_suffix)).alias("__photo"),
        F.col("source").alias("__source"),
        url_hash(F.col("source_url")).alias("__hash"),
    )
    new = {"photo": "__photo", "photo_source": "__source", "photo_hash": "__hash"}
    return directory.join(won, "pos", "left").withColumns(
        {c: F.coalesce(n, c) for c, n in new.items()}
    ).drop(*new.values())


def retry_update(state: DataFrame, events: DataFrame, run: int) -> DataFrame:
    """Retry state after a run.

    A success forgets a key; a failure adds one to its count.  When a key comes
    up more than once in a run, its events count in order of position: only the
    failures after its last success are left.
    """
    won = events.where("recorded").groupBy(F.col("key").alias("__won")).agg(F.max("pos").alias("__last_ok"))
    lost = lookup(events.where("not recorded"), won, F.col("key"), "__won")
    failed = (
        lost.where("__last_ok is null or pos > __last_ok")
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.max_by("retry_reason", "pos").alias("__reason"),
            F.max("attempted_at").alias("__at"),
        )
    )
    kept = state.join(won, state["key"] == won["__won"], "left_anti")
    both = kept.join(failed, "key", "full_outer")
    again = F.col("__n").isNotNull()
    return both.select(
        "key",
        F.when(again, F.lit(run).cast("bigint")).otherwise(F.col("last_run")).alias("last_run"),
        F.when(again, F.col("__at")).otherwise(F.col("last_at")).alias("last_at"),
        F.when(again, F.col("__reason")).otherwise(F.col("last_reason")).alias("last_reason"),
        (F.coalesce("failure_count", F.lit(0)) + F.coalesce("__n", F.lit(0))).alias("failure_count"),
    )


def orphan_assets(assets: DataFrame, directory: DataFrame) -> DataFrame:
    """Stored files whose key belongs to no directory row."""
    keys = directory.select(entity_key(F.col("id"), F.col("email")).alias("key")).where("key is not null").distinct()
    return assets.join(keys, "key", "left_anti")


def rebase_url(rows: DataFrame, assets: DataFrame, cfg: AssetConfig) -> DataFrame:
    """Point self-hosted photo urls at the current base, where the file is stored."""
    pattern = cfg.asset_dir + r"([^/]+)\." + cfg.asset_suffix.lstrip(".")
    key = F.nullif(F.regexp_extract(F.coalesce("photo", F.lit("")), pattern, 1), F.lit(""))
    stored = assets.select(F.col("key").alias("__asset")).distinct().withColumn("__stored", F.col("__asset"))
    found = lookup(rows, stored, key, "__asset")
    based = F.concat(F.lit(cfg.public_base + "/"), F.col("__stored"), F.lit(cfg.asset_suffix))
    return found.withColumn("photo", F.coalesce(based, F.col("photo"))).drop("__stored")
