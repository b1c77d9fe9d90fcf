"""Photo and page rules, one row per branch."""

from datetime import datetime, timezone

from dirsync import AssetConfig, SyncConfig
from dirsync.functions import url_hash
from dirsync.operators import assets as A
from dirsync.operators import pages as P
from dirsync.operators import match as M
from dirsync.operators.caches import cache_upsert
from dirsync.plans import run_photos, run_sales, run_scrape
from dirsync.config import SalesConfig
from dirsync.schemas import ASSET_RETRIES, GEOCODE_CACHE, SCRAPE_CACHE, TRANSACTIONS, URL_CHECKS
from dirsync.sources import load_directory, read_state
from pyspark.sql import functions as F

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
CFG = AssetConfig()
ROW = (
    "pos long, name string, id string, email string, source string, photo string, photo_source string, photo_hash string, "
    "page_url string, incoming_photo string, incoming_photo_real boolean, hidden boolean, soft_deleted_at string"
)
HOSTED = "https://h/directory-data/photos/{}.jpg"
REAL = dict(incoming_photo="http://up/1", incoming_photo_real=True)


def rows(spark, *given):
    base = dict(name="N", email="", source="main", photo="", photo_source="", photo_hash="", page_url="http://p",
                incoming_photo="", incoming_photo_real=False, hidden=False, soft_deleted_at=None)
    full = [{**base, "pos": i, "id": str(i), **g} for i, g in enumerate(given)]
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in ROW.split(", ")) for r in full], ROW)


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def digest(spark, url):
    return spark.range(1).select(url_hash(F.lit(url))).first()[0]


def test_decision(spark):
    same = digest(spark, "http://up/1")
    cases = [
        (dict(hidden=True, soft_deleted_at="x"), "hidden"),
        (dict(soft_deleted_at="soon"), "soft_deleted"),
        (dict(id=" ", email=" "), "no_key"),
        (dict(source="second", incoming_photo="http://up/1"), "second_account_no_photo"),
        (dict(source="second", photo_source="source_a", photo_hash=same, photo=HOSTED.format(4), **REAL), "fresh"),
        (dict(source="second_sheet", **REAL), "second_account_source_a"),
        (dict(photo_source="source_b", **REAL), "upgrade_to_source_a"),
        (dict(photo_source="source_a", photo_hash="other", **REAL), "source_a_changed"),
        (dict(photo_source="source_a", photo_hash=same, photo=HOSTED.format(4), **REAL), "fresh"),
        (dict(photo_source="source_a", photo_hash=same, photo="x", **REAL), "source_a_changed"),
        (dict(photo="https://cdn.trusted.example/directory-data/photos/1.jpg"), "external_working_photo"),
        (dict(photo=HOSTED.format(11)), "fresh"),
        (dict(photo=HOSTED.format(12)), "no_photo_at_all"),
        (dict(photo="  "), "no_photo_at_all"),
        (dict(photo="https://strange"), "unknown_external_url"),
    ]
    got = A.asset_decision(rows(spark, *[c for c, _ in cases]), keys(spark, "4", "8", "11"), CFG).orderBy("pos").collect()
    assert [r.reason for r in got] == [want for _, want in cases]
    assert [r.pos for r in got if r.needs] == [5, 6, 7, 9, 12, 13]


def test_cascade_and_state(spark):
    cases = [
        (REAL, "success"), (dict(source="second", **REAL), "second_account_source_a_failed"),
        (dict(photo_source="source_a", **REAL), "kept_existing_source_a"), ({}, "source_b_cooldown"), ({}, "success"),
        (dict(photo=HOSTED.format(5)), "kept_existing"), (dict(photo="http://x"), "failed_kept_existing"),
        (dict(page_url=""), "failed_no_photo"), (dict(incoming_photo="ftp://x", incoming_photo_real=True), "failed_no_photo"),
    ]
    attempt = "key string, ok boolean, reason string, source_url string"
    a = spark.createDataFrame([("0", True, "", "http://up/1"), ("1", False, "too_small", "u")], attempt)
    b = spark.createDataFrame([("4", True, "", "http://b/4"), ("5", False, "parse:x", "u")], attempt)
    old = [("3", 9, "t", "r", 2), ("4", 8, "t", "r", 1), ("5", 8, "t", "r", 4), ("7", 10, "t", "r", 3), ("z", 1, "t", "r", 7)]
    retries = spark.createDataFrame(old, ASSET_RETRIES)
    queue = A.with_asset(rows(spark, *[c for c, _ in cases]), keys(spark, "5")).withColumn("reason", F.lit("r"))
    events = A.asset_cascade(queue, a, b, retries, 10, NOW, CFG).orderBy("pos").collect()
    assert [r.status for r in events] == [want for _, want in cases]
    assert [r.failure_a for r in events] == [None, "too_small", "not_attempted", "not_flagged_real", "not_flagged_real",
                                             "not_flagged_real", "not_flagged_real", "not_flagged_real", "invalid_url"]
    assert events[5].failure_b == "parse:x" and events[7].failure_b == "no_page_url" and events[6].failure_b == "page_fetch_failed"
    state = A.retry_update(retries, A.asset_cascade(queue, a, b, retries, 10, NOW, CFG), 10)
    got = {r.key: (r.last_run, r.failure_count, r.last_reason) for r in state.collect()}
    assert got == {
        "1": (10, 1, "A:too_small"), "3": (9, 2, "r"), "5": (10, 5, "A:not_flagged_real,B:parse:x"),
        "6": (10, 1, "A:not_flagged_real,B:page_fetch_failed"), "7": (10, 4, "A:not_flagged_real,B:no_page_url"),
        "8": (10, 1, "A:invalid_url,B:page_fetch_failed"), "z": (1, 7, "r"),
    }


def test_retry_of_a_key_met_more_than_once(spark):
    schema = "key string, recorded boolean, retry_reason string, attempted_at string, pos long"
    events = spark.createDataFrame(
        [("a", False, "r1", "t", 1), ("a", True, None, "t", 2), ("a", False, "r3", "t", 3), ("b", False, "r4", "t", 4),
         ("b", False, "r5", "t", 5), ("c", False, "r6", "t", 6), ("c", True, None, "t", 7), ("d", None, None, "t", 8)], schema)
    state = spark.createDataFrame([(k, 1, "o", "o", 5) for k in "abcd"], ASSET_RETRIES)
    got = {r.key: (r.failure_count, r.last_reason) for r in A.retry_update(state, events, 2).collect()}
    assert got == {"a": (1, "r3"), "b": (7, "r5"), "d": (5, "o")}


def test_queue_force_and_limit(spark):
    decided = A.asset_decision(rows(spark, {}, dict(hidden=True, name="Me"), {}, dict(id="", email=""), {}), keys(spark), CFG)
    assert [(r.pos, r.reason) for r in A.force_limit(decided, "ME", 2).orderBy("pos").collect()] == [(0, "no_photo_at_all"), (1, "forced")]
    assert {r.reason for r in A.skipped(decided, "me").collect()} == {"no_key"}


def test_photo_run(spark):
    attempt = "key string, ok boolean, reason string, source_url string"
    a = spark.createDataFrame([("0", True, "", "http://up/1")], attempt)
    given = rows(spark, REAL, dict(photo="https://old/directory-data/photos/1.jpg"), dict(photo="https://old/directory-data/photos/9.jpg"))
    run = run_photos(given, keys(spark, "1", "ghost"), a, a.where("false"), spark.createDataFrame([], ASSET_RETRIES), 1, NOW, CFG)
    got = {r.pos: r for r in run.directory.collect()}
    assert got[0].photo == CFG.public_base + "/0.jpg" and got[0].photo_source == "source_a"
    assert got[0].photo_hash == digest(spark, "http://up/1")
    assert got[1].photo == CFG.public_base + "/1.jpg" and got[2].photo.startswith("https://old/")
    assert [r.key for r in run.orphans.collect()] == ["ghost"]
    assert run.summary.first().acquired_a == 1 and run.retries.collect()[0].key == "2"


def test_photo_runs_in_a_row(spark, tmp_path):
    """A run publishes directory and retries for the next one; a dry run publishes nothing."""
    attempt = "key string, ok boolean, reason string, source_url string"
    none, out = spark.createDataFrame([], attempt), str(tmp_path / "out")
    given = rows(spark, REAL, dict(photo="")).withColumn("pos", F.col("pos"))
    failed = spark.createDataFrame([("0", False, "download", None), ("1", False, "download", None)], attempt)
    start = spark.createDataFrame([], ASSET_RETRIES)
    run_photos(given, keys(spark), failed, none, start, 1, NOW, CFG, out=out, dry_run=True)
    assert not (tmp_path / "out").exists() and read_state(spark, f"{out}/retries", "key", ASSET_RETRIES).count() == 0
    run_photos(given, keys(spark), failed, none, start, 1, NOW, CFG, out=out)
    state = read_state(spark, f"{out}/retries", "key", ASSET_RETRIES)
    assert {r.key: r.failure_count for r in state.collect()} == {"0": 1, "1": 1}
    won = spark.createDataFrame([("0", True, "", "http://up/1")], attempt)
    run_photos(given, keys(spark), won, none, state, 3, NOW, CFG, out=out)
    state = read_state(spark, f"{out}/retries", "key", ASSET_RETRIES)
    assert {r.key: r.failure_count for r in state.collect()} == {"1": 2}
    photos = {r.id: r.photo for r in load_directory(spark, f"{out}/directory.parquet").collect()}
    assert photos["0"] and not photos["1"]
    heads = {r.report: r["count"] for r in spark.read.json(f"{out}/reports/envelopes/*").collect()}
    assert set(heads) == {"photo-events", "photo-skipped", "orphans", "photo-summary"}


CARD = '<b><img src="https://cdn.trusted.example/logo" alt="z"><DIV  class="agent-card"><p>'
PAGES = [
    ("", "Ann Lee", None, "empty_html"),
    ("<p>none</p>", "Ann Lee", None, "no_agent_card_div"),
    (CARD + '<img src="/rel" alt="x">', "Ann Lee", None, "no_img_in_agent_card"),
    (CARD + '<img class=a src="https://cdn.trusted.example/1" x\nalt="ANN LEE">', "Ann Lee", "https://cdn.trusted.example/1", None),
    (CARD + '<img alt="Annie Lee" src="https://cdn.legacy.example/2">', "Ann Lee", "https://cdn.legacy.example/2", None),
    (CARD + '<img src="https://cdn.trusted.example/3" alt="">', "Ann Lee", "https://cdn.trusted.example/3", None),
    (CARD + '<img src="https://evil.example/' + "x" * 80 + '" alt="No">', "Ann Lee", None, "untrusted_host:https://evil.example/" + "x" * 80),
    (CARD + '<img src="https://cdn.trusted.example/4" alt="B &amp; C">', "Ann Lee", None, "alt_name_mismatch:expected='Ann Lee',got='B & C'"),
    (CARD + '<img src="https://cdn.trusted.example/5" alt="O&#39;Neil">', "Pat", None, "alt_name_mismatch:expected='Pat',got=\"O'Neil\""),
    # Source first wins over an earlier tag in the other order.
    (CARD + '<img alt="Ann" src="https://cdn.trusted.example/a"><img src="https://cdn.trusted.example/b" alt="Lee">', "Ann Lee", "https://cdn.trusted.example/b", None),
]


def test_page_extract(spark):
    df = spark.createDataFrame([(i, h, n) for i, (h, n, *_) in enumerate(PAGES)], "i int, html string, name string")
    got = P.page_extract(df, CFG).orderBy("i").collect()
    assert [(r.photo_url, r.reason) for r in got] == [(u, why) for *_, u, why in PAGES]


def test_long_page_is_searched_whole(spark):
    text = "lorem ipsum " * 200_000 + CARD + "dolor " * 200_000 + '<img src="https://cdn.trusted.example/far" alt="Ann">'
    df = spark.createDataFrame([(text, "Ann")], "html string, name string")
    assert P.page_extract(df, CFG).first().photo_url == "https://cdn.trusted.example/far"


def test_scrape_run(spark):
    page = lambda who: CARD + f'<img src="https://cdn.trusted.example/{who}" alt="{who}">'
    given = rows(
        spark, dict(page_url="a", name="ann"), dict(page_url="a", name="bo"), dict(page_url="gone"), dict(page_url="n", name="x"),
        dict(page_url="n", name="y"), dict(page_url="fp"), dict(page_url="fn"), dict(page_url="st", name="st"), dict(page_url="", name="q"),
        dict(page_url="a", photo="has", name="Forced"), dict(page_url="a", hidden=True), dict(page_url="a", source="second"),
    )
    pages = spark.createDataFrame([("a", page("ann")), ("n", page("zzz")), ("st", page("st"))], "url string, html string")
    cache = spark.createDataFrame(
        [("fp", "http://c", "2024-01-25T00:00:00Z", "n", None), ("fn", None, "2024-01-25T00:00:00Z", "n", None),
         ("st", "http://c", "2024-01-24T00:00:00Z", "n", None)], SCRAPE_CACHE)
    fresh = run_scrape(given, pages, cache, NOW, CFG, use_cache=False)
    assert {r.pos: r.status for r in fresh.events.collect()}[5] == "failed"
    run = run_scrape(given, pages, cache, NOW, CFG, force="FORCED")
    got = {r.pos: (r.status, r.photo_url, r.reason) for r in run.events.collect()}
    miss = "alt_name_mismatch:expected='x',got='zzz'"
    ann = "https://cdn.trusted.example/ann"
    assert got == {
        0: ("success", ann, None), 1: ("cached", ann, None), 2: ("failed", None, "fetch_failed"), 3: ("no_photo_found", None, miss),
        4: ("cached_negative", None, miss), 5: ("cached", "http://c", None), 6: ("cached_negative", None, "cached_no_photo"),
        7: ("success", "https://cdn.trusted.example/st", None), 9: ("cached_no_change", None, None),
    }
    entries = {r.page_url: (r.photo_url, r.agent_name) for r in run.cache.collect()}
    assert entries == {"a": (ann, "ann"), "n": (None, "x"), "st": ("https://cdn.trusted.example/st", "st"), "fp": ("http://c", "n"), "fn": (None, "n")}
    assert {r.pos: r.photo for r in run.directory.collect()}[9] == "has"


def test_url_checks(spark):
    checks = spark.createDataFrame(
        [("live", 204, "u", "x"), ("edge", 218, "e", None), ("new", 404, "", "2024-01-30T23:30:00Z"), ("old", 404, "", "2024-01-30T23:00:00Z")], URL_CHECKS)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["live", "edge", "new", "old", "none", ""])], "pos long, slug_wanted string")
    got = M.url_check_lookup(df, checks, SyncConfig(), NOW).orderBy("pos").collect()
    assert [(r.check, r.checked_url) for r in got] == [("live", "u"), ("live", "e"), ("cooldown", ""), ("recheck", ""), ("recheck", ""), ("recheck", "")]
    newer = spark.createDataFrame([("new", 200, "n", "2024-01-31T00:00:00Z"), ("old", None, "", "2024-01-31T00:00:00Z")], URL_CHECKS)
    assert {r.slug: r.status for r in cache_upsert(checks, newer, "url_check").collect()} == {"live": 204, "edge": 218, "new": 200, "old": 404}


def test_sales_run(spark):
    t = lambda i, kind, price, vol, addr, city="Town": (i, "closed", kind, price, vol, addr, city, None, "1", "2024-01-01")
    sales = spark.createDataFrame(
        [t(1, "Residential", 100.9, None, "1 Elm"), t(2, None, 0.0, 2500.0, "2 Elm"), t(3, "Land", 5.0, None, "3 Elm"),
         t(4, "SINGLE family", None, None, "4 Elm"), t(5, "traditional", 7.0, None, " "), t(6, "", 9.0, None, "6 Elm")], TRANSACTIONS)
    cache = spark.createDataFrame([("1 Elm, Town, OH 1", 0.0, 0.0)], GEOCODE_CACHE)
    found = spark.createDataFrame([("2 Elm, Town, OH 1", 1.0, 2.0), ("6 Elm, Town, OH 1", None, None)], GEOCODE_CACHE)
    run = run_sales(sales, cache, SalesConfig(), found)
    got = {(r.street, r.price, r.price_fmt, r.lat) for r in run.public.collect()}
    assert got == {("Elm", 100, "$100", 0.0), ("Elm", 2500, "$2,500", 1.0)}
    assert [r.query for r in run.misses.collect()] == ["6 Elm, Town, OH 1"]
    assert [r.n for r in run.funnel.orderBy("step_no").collect()] == [6, 5, 3, 2]
    assert run_sales(sales, cache, SalesConfig(), keep=True).public.count() == 3
