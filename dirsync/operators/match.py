"""Matching of incoming rows to rows of the previous directory."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SyncConfig
from ..functions import age_seconds, name_key, slugify, truthy
from .lookups import lookup, map_lookup

# Tiers, most reliable first.
TIERS = ("manual", "id", "email", "name")
MANUAL, ID, EMAIL, NAME = range(4)


class MatchIndex(NamedTuple):
    email: DataFrame
    id: DataFrame
    name: DataFrame


def _typed(kind: Column, value: Column) -> Column:
    return F.concat(kind, F.lit(":"), value)


def _key(kind: str, c: Column) -> Column:
    """Typed key text, null when the value is blank, so blanks never meet."""
    return _typed(F.lit(kind), F.nullif(c, F.lit("")))


def previous_keys(directory: DataFrame) -> DataFrame:
    """Usable keys of the previous directory: one row per key.

    E-mail and id point to the last row that has them; a name key is usable
    only if exactly one row has it.  One scan, one aggregate that combines
    before the shuffle.  The typed key is built after the grouping, so that a
    join on it gets an exchange that adaptive execution can split.
    """
    values = {"email": F.lower("email"), "id": F.col("id"), "name": name_key(F.col("name"))}
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in values.items()])
    usable = (
        directory.select(F.col("pos").alias("row_id"), F.explode(keys).alias("k"))
        .select("row_id", "k.*")
        .where("value <> ''")
        .groupBy("kind", "value")
        .agg(F.max("row_id").alias("row_id"), F.count(F.lit(1)).alias("n"))
        .where("kind <> 'name' OR n = 1")
    )
    return usable.select("kind", "value", _typed(F.col("kind"), F.col("value")).alias("key"), "row_id")


def match_index(directory: DataFrame) -> MatchIndex:
    """The three indexes as tables of (key, row_id)."""
    keys = previous_keys(directory)

    def part(kind: str) -> DataFrame:
        return keys.where(F.col("kind") == kind).select(F.col("value").alias("key"), "row_id")

    return MatchIndex(part("email"), part("id"), part("name"))


def _pair_keys(cfg: SyncConfig) -> dict[str, str]:
    return {i: re.sub(r"[^a-z]", "", n.lower()) for i, n in cfg.manual_pairs.items()}


def tiered_match(incoming: DataFrame, directory: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Best previous row of every incoming row that has one: (in_pos, row_id, tier).

    Each incoming row offers up to four keys, each with its tier; one equi-join
    against the previous keys finds the candidates and the lowest tier wins.
    Only positions and keys are shuffled.
    """
    paired = map_lookup(incoming.select("pos", "id", "email", "name"), "id", _pair_keys(cfg), "__target")
    offers = F.array(
        F.struct(F.lit(MANUAL).alias("tier"), _key("name", F.col("__target")).alias("key")),
        F.struct(F.lit(ID).alias("tier"), _key("id", F.col("id")).alias("key")),
        F.struct(F.lit(EMAIL).alias("tier"), _key("email", F.lower("email")).alias("key")),
        F.struct(F.lit(NAME).alias("tier"), _key("name", name_key(F.col("name"))).alias("key")),
    )
    wanted = paired.select(F.col("pos").alias("in_pos"), F.explode(offers).alias("o")).select("in_pos", "o.*")
    hits = wanted.where("key is not null").join(previous_keys(directory).select("key", "row_id"), "key")
    return hits.groupBy("in_pos").agg(F.min_by("row_id", "tier").alias("row_id"), F.min("tier").alias("tier"))


def manual_pairs(incoming: DataFrame, directory: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Incoming rows a configured pair leads to one previous row; others fall through."""
    paired = map_lookup(incoming.select("pos", "id"), "id", _pair_keys(cfg), "__target")
    names = match_index(directory).name
    wanted = paired.where("__target is not null").select(F.col("pos").alias("in_pos"), "id", F.col("__target").alias("key"))
    return wanted.join(names, "key").select("in_pos", "id", "row_id")


def unmatched(directory: DataFrame, matches: DataFrame) -> DataFrame:
    """Previous rows no incoming row was matched to."""
    taken = matches.select(F.col("row_id").alias("pos")).distinct()
    return directory.join(taken, "pos", "left_anti")


def in_second_region(cfg: SyncConfig) -> Column:
    """Is a previous row one of the second region's?"""
    listed = F.coalesce(F.array_contains("regions", cfg.second_region), F.lit(False))
    return listed | F.coalesce(F.col("source") == cfg.sheet_source, F.lit(False))


def region_unmatched(directory: DataFrame, matches: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Review list: unmatched rows of the second region."""
    return unmatched(directory.where(in_second_region(cfg)), matches).select(
        "name", "email", "team", "regions", "source", "pos"
    )


def url_check_lookup(candidates: DataFrame, checks: DataFrame, cfg: SyncConfig, now) -> DataFrame:
    """State of each candidate slug: live, cooldown or recheck, and the url if live.

    A live answer (2xx, or 218) is trusted for ever; any other answer for the
    recheck time only.
    """
    status = F.coalesce("status", F.lit(0))
    live = status.between(200, 299) | (status == 218)
    recent = age_seconds(F.col("checked_at"), now) < cfg.url_recheck_seconds
    found = lookup(candidates, checks, F.nullif("slug_wanted", F.lit("")), "slug")
    return found.select(
        *candidates.columns,
        F.when(live, "live").when(recent, "cooldown").otherwise("recheck").alias("check"),
        F.when(live, F.coalesce("url", F.lit(""))).otherwise(F.lit("")).alias("checked_url"),
    )


def page_candidates(rows: DataFrame, cfg: SyncConfig) -> Column:
    """Should the row get a page url from its name?"""
    second = F.array_contains("regions", cfg.second_region) | F.col("source").isin(
        cfg.sheet_source, cfg.second_source
    )
    return (
        ~truthy(F.col("page_url"))
        & ~F.coalesce("hidden", F.lit(False))
        & ~F.coalesce(second, F.lit(False))
        & (slugify(F.col("name")) != "")
    )


def page_url_assign(rows: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Visible rows of the main region without a page url get base + slug.

    The url is set whatever a check says; checks are only counted.
    """
    return rows.withColumn(
        "page_url",
        F.when(page_candidates(rows, cfg), F.concat(F.lit(cfg.page_base + "/"), slugify(F.col("name")))).otherwise(
            F.col("page_url")
        ),
    )


def page_url_checks(before: DataFrame, checks: DataFrame, cfg: SyncConfig, now) -> DataFrame:
    """How many page urls a run sets, how many of them are not confirmed live."""
    wanted = before.where(page_candidates(before, cfg)).select("pos", slugify(F.col("name")).alias("slug_wanted"))
    state = url_check_lookup(wanted, checks, cfg, now)
    return state.agg(
        F.count(F.lit(1)).alias("assigned"),
        F.count_if(F.col("check") != "live").alias("unconfirmed"),
    )
