"""The merge against a plain model, and the invariants of the lifecycle."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from catalog import queries as Q
from catalog.settings import NOW as FIXTURE_NOW
from catalog.settings import SYNC
from dirsync import SyncConfig
from dirsync.operators import lifecycle as L
from dirsync.operators import match as M
from dirsync.operators import rules as RU
from dirsync.plans import PublishRefused, plan_sync, run_sync
from dirsync.schemas import DIRECTORY
from dirsync.sources import load_directory

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
CFG = SyncConfig(second_region="S", manual_pairs={"m1": "Old Name"}, joint_emails=("j@x",), min_rows=1)
VALID = (
    "email string, name string, phone string, title string, team string, team_logo string, regions array<string>, "
    "office string, photo string, page_url string, id string, incoming_photo string, incoming_photo_real boolean, "
    "second_id string, source string, pos bigint"
)


def incoming(spark, rows):
    base = dict(phone="", title="t", team="T", team_logo="own", regions=["N"], office="o", photo="", page_url="",
                incoming_photo="", incoming_photo_real=False, second_id="", source="main", id=None)
    full = [{**base, **r, "pos": i} for i, r in enumerate(rows)]
    names = [p.split()[0] for p in VALID.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], VALID)


def directory(spark, rows):
    base = {f.name: None for f in DIRECTORY.fields} | dict(regions=["N"], source="main", team="Old", team_logo="")
    return spark.createDataFrame([tuple({**base, **r, "pos": i}[f] for f in DIRECTORY.fieldNames()) for i, r in enumerate(rows)], DIRECTORY)


def key(n):
    return re.sub("[^a-z]", "", (n or "").lower())


def model_match(rows, old, pairs):
    """One incoming row after the other, tier by tier."""
    names = {}
    for o in old:
        names.setdefault(key(o["name"]), []).append(o["pos"])
    unique = {k: v[0] for k, v in names.items() if k and len(v) == 1}
    ids = {o["id"]: o["pos"] for o in old if o["id"]}
    mails = {o["email"].lower(): o["pos"] for o in old if o["email"]}
    out = {}
    for r in rows:
        tries = [unique.get(key(pairs.get(r["id"]))) if r["id"] in pairs else None, ids.get(r["id"]), mails.get(r["email"]), unique.get(key(r["name"]))]
        hit = next(((t, p) for t, p in enumerate(tries) if p is not None), None)
        if hit:
            out[r["pos"]] = hit
    return out


@pytest.mark.parametrize("seed", range(3))
def test_match_equals_model(spark, seed):
    rnd = random.Random(seed)
    pick = lambda n: str(rnd.randrange(n))
    name = lambda: rnd.choice(["Ann", "Bo", "cy", "Di 1", "", "99"]) + rnd.choice([" Lee", "", " Day"])
    old = [dict(id=rnd.choice(["", pick(40)]), email=rnd.choice(["", f"E{pick(40)}@x"]), name=name() + rnd.choice(["", "abc"[rnd.randrange(3)]])) for _ in range(60)]
    new = [dict(id=rnd.choice([None, pick(60)]), email=f"e{pick(80)}@x", name=name()) for _ in range(80)]
    pairs = {str(i): rnd.choice(old)["name"] for i in range(0, 60, 3)}
    cfg = SyncConfig(manual_pairs=pairs)
    got = {r.in_pos: (r.tier, r.row_id) for r in M.tiered_match(incoming(spark, new), directory(spark, old), cfg).collect()}
    assert got == model_match([{**r, "pos": i} for i, r in enumerate(new)], [{**o, "pos": i} for i, o in enumerate(old)], pairs)


def test_many_pairs_go_through_a_table(spark):
    pairs = {str(i): "nobody" for i in range(500)} | {"7": "Right One"}
    new, old = [dict(id="7", email="a@x", name="Wrong")], [dict(name="Right One", email="b@x"), dict(name="Wrong", email="a@x")]
    row = M.tiered_match(incoming(spark, new), directory(spark, old), SyncConfig(manual_pairs=pairs)).first()
    assert (row.row_id, row.tier) == (0, 0)


def test_two_rows_may_match_one(spark):
    new = [dict(id="1", email="a@x", name="A"), dict(id="2", email="old@x", name="B")]
    old = [dict(id="1", email="old@x", name="A")]
    ledger = L.merge_ledger(incoming(spark, new), directory(spark, old), CFG, NOW).collect()
    assert [r.fate for r in ledger] == ["updated", "updated"]


def fates(spark, new, old, cfg=CFG):
    rows = L.merge_ledger(incoming(spark, new), directory(spark, old), cfg, NOW).collect()
    return {r.email: r for r in rows}


def test_fields_by_owner(spark):
    new = [
        dict(id="1", email="a@x", name="Ann O'Lee", incoming_photo="http://in", incoming_photo_real=True),
        dict(id="2", email="b@x", name="Bo", team="", source="main"),
        dict(id="3", email="c@x", name="Cy", source="second", regions=["S"]),
        dict(id="4", email="d@x", name="Di", source="second", regions=["S"]),
        dict(id="5", email="e@x", name="Ed", incoming_photo="http://in", incoming_photo_real=False),
        dict(id="6", email="f@x", name="Fay", incoming_photo="http://in", incoming_photo_real=True),
    ]
    old = [
        dict(id="1", name="x", hidden=True, team_logo="keep", photo="old", photo_source="p", photo_hash="h", second_id="L1", source="both"),
        dict(id="2", name="y", team_logo="old logo", soft_deleted_at="2024-01-20T00:00:00Z", hidden=True),
        dict(id="3", name="z", source="both", team="Pinned", team_logo="", office=None, title="Old", regions=[], extras={"k": "v"}),
        dict(id="4", name="q", source="main", regions=["N"], team="Other", extras={"k": "v"}),
    ]
    got = fates(spark, new, old)
    a, b, c, d = (got[f"{x}@x"] for x in "abcd")
    assert (a.photo, a.photo_source, a.photo_hash, a.second_id) == ("old", "p", "h", "L1")
    assert a.hidden and a.team == "T" and a.team_logo == "keep" and a.source == "both" and a.page_url == ""
    assert b.fate == "reactivated" and b.hidden is False and b.soft_deleted_at is None and b.team_logo == ""
    assert b.was_deleted_at == "2024-01-20T00:00:00Z" and b.page_url == "https://pages.example.com/bo"
    assert (c.team, c.title, c.office, c.regions, c.extras, c.source) == ("Pinned", "Old", "o", ["S"], {"k": "v"}, "second")
    assert c.team_logo == "" and c.page_url == ""
    assert d.team == "T" and d.extras is None and d.source == "second"
    assert got["e@x"].fate == "new" and got["e@x"].photo == "" and got["f@x"].photo == "http://in" and got["f@x"].hidden is False


def test_lifecycle_of_unmatched(spark):
    cut = NOW - timedelta(days=30)
    old = [
        dict(email="purge@x", name="a", soft_deleted_at=(cut - timedelta(seconds=1)).isoformat()),
        dict(email="edge@x", name="b", soft_deleted_at=cut.isoformat(), hidden=True),
        dict(email="naive@x", name="c", soft_deleted_at="2024-01-15T00:00:00", hidden=True),
        dict(email="bad@x", name="d", soft_deleted_at="soon"),
        dict(email="fresh@x", name="e"),
        dict(email="J@x", name="f", source="joint"),
        dict(email="j@x", name="g", source="main"),
        dict(email="region@x", name="h", regions=["S"]),
        dict(email="sheet@x", name="i", source="sheet"),
    ]
    got = fates(spark, [], old)
    fate = {k: v.fate for k, v in got.items()}
    assert fate == {
        "purge@x": "purge", "edge@x": "grace", "naive@x": "grace", "bad@x": "soft_delete", "fresh@x": "soft_delete",
        "J@x": "joint", "j@x": "soft_delete", "region@x": "soft_delete", "sheet@x": "soft_delete",
    }
    assert got["fresh@x"].hidden and got["fresh@x"].soft_deleted_at == "2024-01-31T00:00:00+00:00"
    off = fates(spark, [], old, SyncConfig(second_region="S", second_enabled=False))
    assert off["region@x"].fate == off["sheet@x"].fate == "kept" and off["region@x"].soft_deleted_at is None
    assert off["fresh@x"].fate == "soft_delete"


def test_every_row_ends_once(spark, sf_dir):
    """Each previous row is matched or has one fate; each incoming row appears once."""
    valid, prev = Q.valid(spark, sf_dir), Q.previous(spark, sf_dir)
    ledger = L.merge_ledger(valid, prev, SYNC, FIXTURE_NOW)
    matched = {r.row_id for r in M.tiered_match(valid, prev, SYNC).collect()}
    rows = ledger.collect()
    carried = Counter(r.pos for r in rows if r.seq == 1)
    assert max(carried.values()) == 1 and not matched & set(carried)
    assert matched | set(carried) == {r.pos for r in prev.select("pos").collect()}
    assert sorted(r.pos for r in rows if r.seq == 0) == sorted(r.pos for r in valid.select("pos").collect())


def test_second_run_has_no_events(spark, sf_dir, tmp_path):
    raw = Q.roster(spark, sf_dir)
    run_sync(raw, Q.previous(spark, sf_dir), SYNC, FIXTURE_NOW, str(tmp_path))
    after = load_directory(spark, str(tmp_path / "directory.parquet"))
    again = plan_sync(raw, after, SYNC, FIXTURE_NOW)
    assert again.events.count() == 0
    assert after.where("regions is not null").count() == after.count()
    envelopes = spark.read.json(str(tmp_path / "reports" / "envelopes"))
    assert envelopes.count() == 10 and envelopes.where("report = 'live'").first()["count"] == after.count()


def test_a_run_writes_its_digest_and_coverage(spark, sf_dir, tmp_path):
    run = run_sync(Q.roster(spark, sf_dir), Q.previous(spark, sf_dir), SYNC, FIXTURE_NOW, str(tmp_path))
    lines = spark.read.json(str(tmp_path / "notes" / "rows" / "report=digest")).orderBy("line_no").collect()
    kinds = {r.kind: r["count"] for r in run.events.groupBy("kind").count().collect()}
    assert kinds and [r.line_no for r in lines] == list(range(1, sum(kinds.values()) + 2 * len(kinds) + 1))
    assert sorted(int(r.line.split()[0]) for r in lines if r.line.endswith(":")) == sorted(kinds.values())
    assert sum(r.line == "" for r in lines) == len(kinds)
    seen = spark.read.json(str(tmp_path / "notes" / "rows" / "report=coverage")).first()
    rows = run.directory.select("hidden", "photo", "regions").collect()
    shown = [r for r in rows if not r.hidden]
    assert (seen.total, seen.visible, seen.with_photo) == (len(rows), len(shown), sum(bool(r.photo and r.photo.strip()) for r in shown))
    assert seen.with_region + seen.without_region == seen.visible and seen.with_region == sum(bool(r.regions) for r in shown)


def test_dry_run_and_refusal_write_nothing(spark, sf_dir, tmp_path):
    raw, prev = Q.roster(spark, sf_dir), Q.previous(spark, sf_dir)
    run = run_sync(raw, prev, SYNC, FIXTURE_NOW, str(tmp_path / "dry"), dry_run=True)
    assert run.directory.count() > 0 and not (tmp_path / "dry").exists()
    with pytest.raises(PublishRefused, match="fewer valid rows"):
        run_sync(raw.where("pos < 40"), prev, SYNC, FIXTURE_NOW, str(tmp_path / "no"))
    assert not (tmp_path / "no").exists()


def test_gate(spark):
    old = [dict(name=str(i)) for i in range(10)] + [dict(name="s", regions=["S"])] * 5
    few = [dict(email=f"{i}@x", name="n") for i in range(4)]
    gate = RU.safety_gate(incoming(spark, few), directory(spark, old), CFG).first()
    assert (gate.valid_rows, gate.previous_rows, gate.previous_main_rows, gate.publish) == (4, 15, 10, False)
    first = RU.safety_gate(incoming(spark, few), directory(spark, []), CFG).first()
    assert first.publish and first.share is None
    assert RU.safety_gate(incoming(spark, []), directory(spark, old), CFG).first().refused == "no valid rows after filtering"


def test_duplicate_groups_have_one_form_at_every_size(spark):
    new = [dict(email=f"{i}@x", name="Same Name") for i in range(3000)] + [dict(email=f"p{i}@x", name="A Pair") for i in range(2)]
    new += [dict(email="1@x", name="123"), dict(email="2@x", name="456")]
    flags = RU.dup_names(incoming(spark, new), CFG)
    assert "collect_list" not in flags._jdf.queryExecution().optimizedPlan().toString()
    flags = flags.collect()
    assert len(flags) == 3002
    assert {r.reason for r in flags} == {
        "Same name found with 3000 different emails: all rows of name key samename",
        "Same name found with 2 different emails: all rows of name key apair",
    }
    assert RU.dup_members(incoming(spark, new)).where(F.col("n") == 3000).count() == 3000


def test_junk_rules_in_order(spark):
    cfg = SyncConfig(junk_email_patterns=("test", r"\btest\b"), junk_name_patterns=("^testing\\b",), staff_email_patterns=("admin@",))
    rows = [("contest@x", "Ann"), ("a@x", "Testing Me"), ("admin@x", "B"), ("a@x", "001 - Z"), ("a@house.example.com", "001 - Z"), ("ok@x", "Ok")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos long, email string, name string")
    kept, hits = RU.junk_rules(df, cfg)
    assert sorted(r.pos for r in kept.collect()) == [4, 5]
    assert {r.pos: r.reason for r in hits.collect()} == {
        0: "email matches junk pattern: test",
        1: "name matches junk pattern: ^testing\\b",
        2: "staff/internal account: admin@",
        3: "numbered prefix account with no brokerage email",
    }
