"""The registered queries: one per operator, over the inputs of ``fixtures``.

Every query takes (spark, sf_dir) and returns a frame.  Lists and maps are
written as text at the very end, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dirsync import functions as fn
from dirsync.operators import assets as A
from dirsync.operators import lifecycle as L
from dirsync.operators import match as M
from dirsync.operators import ordering as O
from dirsync.operators import pages as P
from dirsync.operators import reports as R
from dirsync.operators import roster as RO
from dirsync.operators import rules as RU
from dirsync.operators import sales as S
from dirsync.operators import summaries as SU
from dirsync.operators.caches import cache_upsert as upsert
from dirsync.operators.entities import decode_entities
from dirsync.operators.lookups import lookup_default
from dirsync.plans.sync import plan_sync, sync_reports
from dirsync.schemas import GEOCODE_CACHE, TEMPORARY_COLUMNS
from dirsync.session import scratch_path
from dirsync.sources import load_directory, load_rosters, load_sales, load_state
from dirsync.sources import current, publish_directory, read_state, write_reports, write_sales, write_state
from dirsync.streaming.events import event_counts, stream_event_counts, write_event_counts
from dirsync.streaming.snapshots import announce_snapshot, latest_directory, stream_snapshots

from . import fixtures as fx
from .settings import ASSET, NOW, RUN, SALES, SYNC, YEAR

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def flat(df: DataFrame) -> DataFrame:
    """Lists and maps as text; wide and narrow integers alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, T.MapType):
            c = F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def counted(kept: DataFrame, dropped: DataFrame) -> DataFrame:
    """A kept frame and its audit as one table of positions."""
    return kept.select("pos", F.lit("kept").alias("side")).unionByName(
        dropped.select("pos", F.lit("audit").alias("side"))
    )


# Inputs shared by several queries.


def roster(spark, d):
    return fx.load(spark, d, "fx_roster_a")


def classified(spark, d):
    """The cleaned roster, which a sync run writes before it goes on."""
    return fx.land(spark, d, "cleaned", lambda: RO.classify_roster(roster(spark, d), SYNC))


def parsed(spark, d):
    return RO.parsed_rows(classified(spark, d))


def judged(spark, d):
    return RU.judge_rows(parsed(spark, d), SYNC)


def valid(spark, d):
    return RU.valid_rows(judged(spark, d))


def previous(spark, d):
    return fx.directory(spark, d)


def ledger(spark, d):
    return L.merge_ledger(valid(spark, d), previous(spark, d), SYNC, NOW)


def events(spark, d):
    return L.lifecycle_events(ledger(spark, d))


def merged(spark, d):
    return L.ledger_directory(ledger(spark, d))


def flags(spark, d):
    return RU.all_flags(judged(spark, d), SYNC)


def matches(spark, d):
    return M.tiered_match(valid(spark, d), previous(spark, d), SYNC)


def attached(spark, d):
    return L.attach_previous(valid(spark, d), previous(spark, d), matches(spark, d))


def gone(spark, d):
    return M.unmatched(previous(spark, d), matches(spark, d))


# 2.1 Sources and sinks.


@query
def src_roster(spark, d):
    """Both accounts' rosters written as JSON lines and read back."""
    raw = roster(spark, d)
    names = {"preferred_name": "Preferred Name", "region_alt": "Region", "team_alt": "Team"}
    root = scratch_path(spark, "rosters")
    paths = {}
    for account in ("main", "second"):
        rows = raw.where(F.col("account") == account).drop("pos", "account")
        packed = F.to_json(F.struct(*[F.col(c).alias(names.get(c, c)) for c in rows.columns]))
        paths[account] = f"{root}/{account}.jsonl"
        rows.select(packed.alias("value")).write.text(paths[account])
    return load_rosters(spark, paths).drop("pos")


def _directory_with_repeats(spark, d):
    prev = previous(spark, d)
    again = prev.where(F.col("pos") % 7 == 0).withColumns(
        {"pos": F.col("pos") + 1_000_000_000, "phone": F.lit("repeat"), "name": F.upper("name")}
    )
    return prev.unionByName(again)


@query
def src_directory(spark, d):
    path = scratch_path(spark, "directory") + ".parquet"
    _directory_with_repeats(spark, d).write.parquet(path)
    return flat(load_directory(spark, path))


@query
def src_transactions(spark, d):
    path = scratch_path(spark, "sales") + ".parquet"
    fx.load(spark, d, "fx_sales").write.parquet(path)
    return load_sales(spark, path, YEAR)


@query
def src_state(spark, d):
    """A state table that exists, and one that does not."""
    path = scratch_path(spark, "geocode")
    fx.load(spark, d, "fx_geocache").write.parquet(path)
    there = load_state(spark, path, GEOCODE_CACHE)
    return there.unionByName(load_state(spark, path + "-missing", GEOCODE_CACHE))


@query
def sink_directory(spark, d):
    path = scratch_path(spark, "published") + ".parquet"
    publish_directory(merged(spark, d), path)
    return flat(spark.read.parquet(current(spark, path)).drop("pos"))


@query
def sink_state(spark, d):
    """A keyed table through three writes: all places, some looked up again, some removed."""
    path = scratch_path(spark, "geocode-state")
    cache = fx.load(spark, d, "fx_geocache")
    write_state(cache, path, "query")
    moved = cache.where(F.length("query") % 3 == 0).withColumn("lat", F.col("lat") + 1.0)
    older = moved.withColumn("lat", F.lit(0.0))
    write_state(moved.withColumn("n", F.lit(2)).unionByName(older.withColumn("n", F.lit(1))), path, "query", order="n")
    write_state(cache.withColumn("gone", F.lit(True)).where(F.length("query") % 5 == 0), path, "query", gone="gone")
    return read_state(spark, path, "query", GEOCODE_CACHE)


@query
def sink_reports(spark, d):
    """All reports of one run, from one ledger."""
    run = plan_sync(roster(spark, d), previous(spark, d), SYNC, NOW)
    return write_reports(sync_reports(run, SYNC), scratch_path(spark, "reports"), NOW)


@query
def sink_sales(spark, d):
    path = scratch_path(spark, "sold")
    write_sales(_public(spark, d), path)
    schema = "street string, city string, price bigint, price_fmt string, lat double, lng double, close_date string"
    return spark.read.schema(schema).json(path)


# 2.2 Scalar functions.


@query
def fmt_phone(spark, d):
    return roster(spark, d).select("pos", "phone", fn.fmt_phone(F.col("phone")).alias("pretty"))


@query
def clean_title(spark, d):
    title = fn.clean_title(F.col("title"), SYNC.default_title, SYNC.generic_titles, SYNC.title_suffix)
    return roster(spark, d).select("pos", "title", title.alias("cleaned"))


@query
def infer_region(spark, d):
    return roster(spark, d).select("pos", "office", fn.infer_region(F.col("office"), SYNC.office_regions).alias("inferred"))


@query
def name_key(spark, d):
    return previous(spark, d).select("pos", fn.name_key(F.col("name")).alias("key"))


@query
def slugify(spark, d):
    odd = F.concat_ws(" ", F.lit(" O'"), "name", F.lit("d’Été--"), "email")
    return previous(spark, d).select("pos", fn.slugify(odd).alias("slug"))


@query
def strip_prefix(spark, d):
    return roster(spark, d).select("pos", fn.strip_prefix(F.col("first_name")).alias("given"))


@query
def display_name(spark, d):
    name = fn.display_name(*[F.col(c) for c in ("first_name", "last_name", "preferred_name", "name")])
    return roster(spark, d).select("pos", name.alias("shown"))


@query
def first_nonblank(spark, d):
    c = F.col
    return roster(spark, d).select(
        "pos",
        fn.first_nonblank(c("team"), c("team_alt"), c("team_name")).alias("team"),
        fn.first_nonblank(c("office"), c("office_name")).alias("office"),
        fn.first_nonblank(c("phone"), c("phone_number")).alias("phone"),
    )


@query
def split_list(spark, d):
    return flat(roster(spark, d).select("pos", fn.split_list(F.col("region")).alias("regions")))


@query
def parse_iso(spark, d):
    at = fn.parse_iso(F.col("soft_deleted_at"))
    return previous(spark, d).select("pos", "soft_deleted_at", F.unix_micros(at).alias("micros"))


@query
def url_hash(spark, d):
    return previous(spark, d).select("pos", "photo", fn.url_hash(F.col("photo")).alias("hash"))


@query
def entity_key(spark, d):
    return fx.load(spark, d, "fx_asset_rows").select("pos", fn.entity_key(F.col("id"), F.col("email")).alias("key"))


@query
def valid_url(spark, d):
    c = F.col
    photo = fn.first_nonblank(c("profile_picture_url"), c("photo_url"), c("avatar_url"), c("image_url"))
    return roster(spark, d).select("pos", fn.valid_url(photo).alias("photo"))


@query
def strip_house_no(spark, d):
    return fx.load(spark, d, "fx_sales").select("id", fn.strip_house_no(F.col("address")).alias("street"))


@query
def fmt_price(spark, d):
    return fx.load(spark, d, "fx_sales").select("id", fn.fmt_price(S.sale_price()).alias("price_fmt"))


@query
def addr_query(spark, d):
    c = F.col
    q = fn.addr_query(c("address"), c("city"), c("state"), c("zip"), SALES.default_state)
    return fx.load(spark, d, "fx_sales").select("id", q.alias("query"))


@query
def host_class(spark, d):
    kind = fn.host_class(F.col("photo"), ASSET.self_host_marks, ASSET.trusted_hosts)
    return previous(spark, d).select("pos", kind.alias("kind"))


@query
def rebase_url(spark, d):
    rows = fx.load(spark, d, "fx_asset_rows").select("pos", "photo")
    return A.rebase_url(rows, fx.load(spark, d, "fx_assets"), ASSET)


@query
def lookup_default_(spark, d):
    return lookup_default(roster(spark, d).select("pos", "team"), "team", SYNC.team_logos, "team_logo")


QUERIES["lookup_default"] = QUERIES.pop("lookup_default_")


@query
def in_list_ci(spark, d):
    return roster(spark, d).select(
        "pos",
        fn.in_list_ci(F.col("role"), SYNC.allowed_roles).alias("allowed"),
        fn.in_list_ci(F.col("team"), SYNC.hide_team_names).alias("hidden_team"),
    )


@query
def assign_region(spark, d):
    c = F.col
    regions = fn.split_list(fn.first_nonblank(c("region"), c("region_alt")))
    office = fn.first_nonblank(c("office"), c("office_name"))
    out = RO.assign_region(regions, office, c("account") == "second", SYNC)
    return flat(roster(spark, d).select("pos", out.alias("regions")))


# 2.3 Filters, rules and audit outputs.


@query
def parse_roster(spark, d):
    return flat(RO.parse_roster(roster(spark, d), SYNC))


@query
def suppress_ids(spark, d):
    return counted(*RO.suppress_ids(roster(spark, d), SYNC.suppressed_ids))


@query
def drop_inactive(spark, d):
    return RO.drop_inactive(roster(spark, d)).select("pos", "active")


@query
def role_gate(spark, d):
    kept, audit = RO.role_gate(roster(spark, d), SYNC)
    return kept.select("pos", F.lit("").alias("role")).unionByName(audit.select("pos", "role"))


@query
def hide_team(spark, d):
    rows = roster(spark, d)
    return rows.select("pos", RO.hide_team(F.col("team"), F.col("id"), SYNC).alias("team"))


@query
def junk_rules(spark, d):
    raw = roster(spark, d).select(
        "pos", fn.strip(F.lower("email")).alias("email"), F.concat_ws(" ", "first_name", "last_name").alias("name")
    )
    kept, hits = RU.junk_rules(raw, SYNC)
    return kept.withColumn("reason", F.lit("")).unionByName(hits)


@query
def no_region(spark, d):
    kept, hits = RU.no_region(parsed(spark, d))
    return counted(kept, hits)


@query
def missing_data(spark, d):
    return flat(RU.missing_data(valid(spark, d), SYNC))


@query
def dup_members(spark, d):
    return RU.dup_members(valid(spark, d)).select("pos", "email", "name_key", "n")


@query
def dup_names(spark, d):
    return RU.dup_names(valid(spark, d), SYNC)


@query
def flag_union(spark, d):
    return flat(flags(spark, d))


@query
def safety_gate(spark, d):
    gate = RU.safety_gate(valid(spark, d), previous(spark, d), SYNC)
    return gate.withColumn("refused", F.coalesce("refused", F.lit("")))


@query
def sales_type(spark, d):
    return S.sales_type(fx.load(spark, d, "fx_sales"), SALES)


@query
def sales_valid(spark, d):
    return S.sales_valid(fx.load(spark, d, "fx_sales"))


@query
def scrape_eligible(spark, d):
    return P.scrape_eligible(previous(spark, d), ASSET).select("pos", "reason", "eligible")


def _decided(spark, d):
    return A.asset_decision(fx.load(spark, d, "fx_asset_rows"), fx.load(spark, d, "fx_assets"), ASSET)


@query
def asset_decision(spark, d):
    return _decided(spark, d).select("pos", "key", "stored", "reason", "needs")


@query
def asset_pending(spark, d):
    rows, cache = fx.load(spark, d, "fx_asset_rows"), fx.load(spark, d, "fx_asset_cache")
    stored = fx.load(spark, d, "fx_assets")
    one = A.asset_pending(rows, cache, stored, ASSET).select("pos", "pending")
    bulk = A.asset_pending(rows, cache, stored, ASSET, bulk=True).select("pos", F.col("pending").alias("bulk"))
    return one.join(bulk, "pos")


@query
def force_limit(spark, d):
    """The feature is the limit: the first 40 of the queue, one row forced by name."""
    decided = _decided(spark, d).withColumn("name", F.when(F.col("pos") == 13, "Forced One").otherwise(F.col("name")))
    return A.force_limit(decided, force="forced one", limit=40).select("pos", "key", "reason")


# 2.4 Joins.


@query
def cross_account_dedup(spark, d):
    main = roster(spark, d).select("pos", "id", "email", "name")
    second = fx.load(spark, d, "fx_roster_b")
    return RO.cross_account_tag(main, second).select("pos", F.coalesce("cause", F.lit("kept")).alias("cause"))


@query
def match_index(spark, d):
    idx = M.match_index(previous(spark, d))
    parts = [getattr(idx, k).withColumn("kind", F.lit(k)) for k in ("email", "id", "name")]
    return reduce(DataFrame.unionByName, parts)


@query
def manual_pairs(spark, d):
    return M.manual_pairs(valid(spark, d), previous(spark, d), SYNC)


@query
def tiered_match(spark, d):
    return flat(matches(spark, d))


@query
def unmatched(spark, d):
    return gone(spark, d).select("pos", "email", "name")


@query
def region_unmatched(spark, d):
    return flat(M.region_unmatched(previous(spark, d), matches(spark, d), SYNC))


@query
def url_check_lookup(spark, d):
    rows = previous(spark, d).select("pos", fn.slugify(F.col("name")).alias("slug_wanted"))
    return M.url_check_lookup(rows, fx.load(spark, d, "fx_url_checks"), SYNC, NOW)


@query
def scrape_cache_lookup(spark, d):
    rows = fx.load(spark, d, "fx_asset_rows").select("pos", "page_url")
    return P.scrape_cache_lookup(rows, fx.load(spark, d, "fx_scrape_cache"), ASSET, NOW)


def _located(spark, d):
    sales = S.sales_valid(S.sales_type(fx.load(spark, d, "fx_sales"), SALES))
    return S.geocode_lookup(sales, fx.load(spark, d, "fx_geocache"), SALES, fx.load(spark, d, "fx_geofound"))


@query
def geocode_lookup(spark, d):
    return _located(spark, d)[0].select("id", "query", "lat", "lng", "from_cache")


@query
def geocode_misses(spark, d):
    return _located(spark, d)[1]


@query
def retry_cooldown(spark, d):
    rows = fx.load(spark, d, "fx_asset_rows").withColumn("key", fn.entity_key(F.col("id"), F.col("email")))
    return A.retry_cooldown(rows, fx.load(spark, d, "fx_retries"), RUN).select("pos", "key", "cooldown")


@query
def orphan_assets(spark, d):
    return A.orphan_assets(fx.load(spark, d, "fx_assets"), fx.load(spark, d, "fx_asset_rows"))


# 2.5 Merge and lifecycle.


@query
def field_merge(spark, d):
    return flat(L.field_merge(attached(spark, d), SYNC).drop(*TEMPORARY_COLUMNS))


@query
def region_pin(spark, d):
    pinned = L.region_pin(attached(spark, d), SYNC)
    return flat(pinned.select("pos", "team", "team_logo", "office", "title", "regions", "extras"))


@query
def photo_seed(spark, d):
    return attached(spark, d).select("pos", L.photo_seed().alias("photo"))


@query
def logo_rule(spark, d):
    return L.region_pin(attached(spark, d), SYNC).select("pos", "team", L.logo_rule().alias("team_logo"))


@query
def visibility(spark, d):
    return attached(spark, d).select("pos", L.visibility().alias("hidden"))


@query
def source_rule(spark, d):
    return attached(spark, d).select("pos", L.source_rule(SYNC).alias("source"))


@query
def new_rows(spark, d):
    return flat(L.new_rows(ledger(spark, d)))


@query
def reactivated(spark, d):
    return flat(L.reactivated(ledger(spark, d)))


def _carried(df):
    return flat(df.drop(*TEMPORARY_COLUMNS))


@query
def soft_delete(spark, d):
    return _carried(L.soft_delete(gone(spark, d), SYNC, NOW))


@query
def grace_keep(spark, d):
    return _carried(L.grace_keep(gone(spark, d), SYNC, NOW))


@query
def purge(spark, d):
    return _carried(L.purge(gone(spark, d), SYNC, NOW))


@query
def joint_keep(spark, d):
    return _carried(L.joint_keep(gone(spark, d), SYNC, NOW))


@query
def region_keep(spark, d):
    return _carried(L.region_keep(gone(spark, d), replace(SYNC, soft_delete_second_region=False), NOW))


@query
def page_url_assign(spark, d):
    rows = L.field_merge(attached(spark, d), SYNC)
    return M.page_url_assign(rows, SYNC).select("pos", "name", "page_url")


@query
def page_url_checks(spark, d):
    rows = L.field_merge(attached(spark, d), SYNC)
    return M.page_url_checks(rows, fx.load(spark, d, "fx_url_checks"), SYNC, NOW)


@query
def directory_merge(spark, d):
    return flat(L.directory_merge(valid(spark, d), previous(spark, d), SYNC, NOW))


def _cascade(spark, d):
    queue = A.force_limit(_decided(spark, d))
    return A.asset_cascade(
        queue,
        fx.load(spark, d, "fx_attempts_a"),
        fx.load(spark, d, "fx_attempts_b"),
        fx.load(spark, d, "fx_retries"),
        RUN,
        NOW,
        ASSET,
    )


@query
def asset_cascade(spark, d):
    return _cascade(spark, d)


@query
def asset_apply(spark, d):
    rows = fx.load(spark, d, "fx_asset_rows")
    return A.asset_apply(rows, _cascade(spark, d), ASSET).select("pos", "photo", "photo_source", "photo_hash")


@query
def retry_update(spark, d):
    return A.retry_update(fx.load(spark, d, "fx_retries"), _cascade(spark, d), RUN)


@query
def cache_upsert_(spark, d):
    return upsert(fx.load(spark, d, "fx_geocache"), fx.load(spark, d, "fx_geofound"), "geocode")


QUERIES["cache_upsert"] = QUERIES.pop("cache_upsert_")


@query
def cache_upsert_scrape(spark, d):
    return upsert(fx.load(spark, d, "fx_scrape_cache"), P.scrape_results(_scraped(spark, d)), "scrape")


@query
def cache_upsert_url_check(spark, d):
    old = fx.load(spark, d, "fx_url_checks")
    # The newest answers: some pages came up, some could not be reached.
    new = old.where(F.col("status") > 400).withColumns(
        {
            "status": F.when(F.col("status") == 404, F.lit(200)),
            "url": F.concat(F.lit("https://pages.example.com/"), "slug"),
            "checked_at": F.lit(fn.stamp(NOW)),
        }
    )
    return flat(upsert(old, new, "url_check"))


def _public(spark, d):
    closed = fx.load(spark, d, "fx_sales").where("status = 'closed'")
    return S.sales_public(closed, fx.load(spark, d, "fx_geocache"), SALES)


@query
def sales_public(spark, d):
    return _public(spark, d)


# 2.6 Aggregations.


@query
def sync_summary(spark, d):
    return SU.sync_summary(ledger(spark, d), flags(spark, d))


@query
def role_counts(spark, d):
    return SU.role_counts(RO.role_excluded_rows(classified(spark, d)))


@query
def skip_counts(spark, d):
    return SU.skip_counts(A.skipped(_decided(spark, d)))


@query
def asset_summary(spark, d):
    return SU.asset_summary(_cascade(spark, d), ASSET.source_a, ASSET.source_b)


@query
def scrape_summary(spark, d):
    return SU.scrape_summary(_scraped(spark, d))


@query
def geocode_summary(spark, d):
    return SU.geocode_summary(_located(spark, d)[0])


@query
def coverage_stats(spark, d):
    return SU.coverage_stats(merged(spark, d))


@query
def sales_funnel(spark, d):
    closed = fx.load(spark, d, "fx_sales").where("status = 'closed'")
    return flat(S.sales_funnel(closed, fx.load(spark, d, "fx_geocache"), SALES))


# 2.7 Windows, sorts, top-k.


@query
def sort_name(spark, d):
    return O.sort_name(merged(spark, d)).select("name", "email", "pos")


@query
def sort_name_photo_first(spark, d):
    return O.sort_name(merged(spark, d), photo_first=True).select("name", "photo", "pos")


@query
def sort_role(spark, d):
    return O.sort_role(RO.role_excluded_rows(classified(spark, d)))


@query
def retain_n(spark, d):
    return flat(O.retain_n(fx.load(spark, d, "fx_snapshots"), 30).drop("ts"))


@query
def first_of_day(spark, d):
    return O.first_of_day(fx.load(spark, d, "fx_runs")).select("run_id", "first_of_day")


@query
def change_reason(spark, d):
    return _changes(O.change_reason(fx.load(spark, d, "fx_runs")))


@query
def change_reason_threshold(spark, d):
    return _changes(O.change_reason(fx.load(spark, d, "fx_runs"), threshold=0.05))


def _changes(df):
    return df.select("run_id", "count", F.coalesce("previous", F.lit(-1)).alias("previous"), "reason", "keep_copy")


@query
def preview_k(spark, d):
    """The feature is the limit: the first 10 rows, and how many remain."""
    bare = flags(spark, d).where("flag = 'NO_REGION'")
    rows = O.preview_k(bare, 10, "pos")
    blank, none = F.lit(""), F.lit(-1)
    return rows.select(
        F.col("rank").cast("bigint").alias("rank"),
        F.coalesce("name", blank).alias("name"),
        F.coalesce("email", blank).alias("email"),
        F.coalesce("remaining", none).alias("remaining"),
    )


@query
def distinct_reasons(spark, d):
    return O.distinct_reasons(RU.dup_names(valid(spark, d), SYNC))


# 2.8 Review reports.


@query
def rpt_live(spark, d):
    return flat(R.rpt_live(merged(spark, d)))


@query
def rpt_no_region(spark, d):
    return flat(R.rpt_no_region(flags(spark, d)))


@query
def rpt_role_excluded(spark, d):
    return R.rpt_role_excluded(RO.role_excluded_rows(classified(spark, d)))[0]


@query
def rpt_region_unmatched(spark, d):
    rows = M.region_unmatched(previous(spark, d), matches(spark, d), SYNC)
    return flat(R.rpt_region_unmatched(rows))


@query
def rpt_no_photo(spark, d):
    return flat(R.rpt_no_photo(merged(spark, d)))


@query
def rpt_no_page(spark, d):
    """Over the previous directory: after a merge hardly a row is left without a page."""
    return flat(R.rpt_no_page(previous(spark, d), SYNC))


@query
def rpt_no_page_merged(spark, d):
    return flat(R.rpt_no_page(merged(spark, d), SYNC))


@query
def rpt_flagged(spark, d):
    return flat(R.rpt_flagged(flags(spark, d)))


@query
def rpt_events(spark, d):
    return flat(R.rpt_events(events(spark, d)))


@query
def event_digest(spark, d):
    return R.event_digest(events(spark, d))


# 2.9 Page extraction.


@query
def page_extract(spark, d):
    return P.page_extract(fx.load(spark, d, "fx_pages"), ASSET).drop("url")


@query
def page_extract_profiles(spark, d):
    pages = fx.load(spark, d, "fx_profile_pages")
    named = pages.join(
        fx.load(spark, d, "fx_base").select(
            F.concat(F.lit("https://pages.example.com/p/"), "ks").alias("url"),
            F.concat_ws(" ", "p_name", "lk").alias("name"),
        ),
        "url",
    )
    return P.page_extract(named, ASSET)


@query
def html_text(spark, d):
    """Every whole page with its entities decoded, by length and hash."""
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "html")
    decoded = decode_entities(pages, "html", "text")
    return decoded.select("page_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def _scraped(spark, d):
    rows = fx.load(spark, d, "fx_asset_rows").withColumn(
        "photo", F.when(F.col("pos") % 5 == 1, F.col("photo")).otherwise(F.lit(""))
    )
    return P.scrape_apply(
        P.scrape_queue(rows, ASSET, force="large rod ca"),
        fx.load(spark, d, "fx_profile_pages"),
        fx.load(spark, d, "fx_scrape_cache"),
        ASSET,
        NOW,
    )


@query
def scrape_apply(spark, d):
    return _scraped(spark, d)


# 2.10 Streams.


@query
def stream_snapshots_(spark, d):
    """Three snapshots arrive, each without one fiftieth of the people."""
    root = scratch_path(spark, "stream")
    raw = roster(spark, d)
    state, landing = f"{root}/state", f"{root}/landing"
    start = f"{root}/start.parquet"
    previous(spark, d).write.parquet(start)
    for n in range(3):
        paths = {a: f"{root}/snapshots/{n}/{a}.parquet" for a in ("main", "second")}
        for account, path in paths.items():
            raw.where((F.col("account") == account) & (F.col("pos") % 50 != n)).write.parquet(path)
        announce_snapshot(spark, landing, n, paths, NOW + timedelta(days=20 * n))
    stream_snapshots(spark, landing, state, f"{root}/checkpoint", SYNC, start)
    return flat(latest_directory(spark, state).drop("pos"))


QUERIES["stream_snapshots"] = QUERIES.pop("stream_snapshots_")


@query
def stream_event_counts_(spark, d):
    """Every day of the log, from a stream that hands on the counts that changed."""
    root = scratch_path(spark, "events")
    fx.load(spark, d, "fx_lifecycle").select("kind", F.col("ts").cast("timestamp").alias("ts")).write.parquet(f"{root}/in")
    source = spark.readStream.schema("kind string, ts timestamp").parquet(f"{root}/in")
    write_event_counts(stream_event_counts(source), f"{root}/out", f"{root}/checkpoint")
    return flat(event_counts(spark, f"{root}/out"))


QUERIES["stream_event_counts"] = QUERIES.pop("stream_event_counts_")
