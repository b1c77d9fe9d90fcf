import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from dirsync.operators.roster import merge_accounts, parse_roster
from dirsync import SyncConfig
from dirsync.schemas import DIRECTORY, GEOCODE_CACHE
from dirsync.schemas import DIRECTORY_FIELDS
from dirsync.sources import load_directory, load_rosters, load_sales, load_state, publish_directory, read_state, versions, write_directory, write_reports, write_state

RAW = [
    {"id": 7, "email": "A@x ", "first_name": "Ann", "last_name": "Lee", "Region": "North", "active": None, "odd": [1]},
    {"id": "8", "email": "b@x", "first_name": "Bo", "last_name": "Day", "Preferred Name": "Bob", "Team": "T", "active": False},
]


def lines(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


@pytest.mark.parametrize("fmt", ["jsonl", "json"])
def test_rosters_of_two_accounts(spark, tmp_path, fmt):
    def put(name, rows):
        path = tmp_path / f"{name}.{fmt}"
        return lines(path, rows) if fmt == "jsonl" else (path.write_text(json.dumps(rows)), str(path))[1]

    second = [{"id": "7", "email": "n@x"}, {"id": "9", "email": " B@X"}, {"id": "10", "email": "c@x", "name": "Cy"}]
    raw = load_rosters(spark, {"main": put("a", RAW), "second": put("b", second)})
    rows = raw.orderBy("pos").collect()
    assert [(r.id, r.account) for r in rows] == [("7", "main"), ("8", "main"), ("7", "second"), ("9", "second"), ("10", "second")]
    assert rows[0].region_alt == "North" and rows[0].active is None and rows[1].active is False
    assert rows[1].preferred_name == "Bob" and rows[1].team_alt == "T"
    # Same id, then same e-mail as the main account.
    kept = merge_accounts(raw, SyncConfig()).collect()
    assert sorted(r.id for r in kept) == ["10", "7", "8"]
    only = load_rosters(spark, {"main": put("a", RAW), "second": put("b", second)}, enabled=("main",))
    assert only.count() == 2
    parsed = parse_roster(raw, SyncConfig(second_region="Second")).orderBy("pos").collect()
    assert [(r.name, r.regions) for r in parsed][0] == ("Ann Lee", ["North"])
    assert parsed[-1].source == "second" and parsed[-1].regions == ["Second"]


def test_directory_round_trip_keeps_unknown_fields(spark, tmp_path):
    rows = [
        {"name": "zed", "email": "z@x", "id": 3, "regions": ["N", "S"], "hidden": True, "status": "s1", "loud": 5},
        {"name": "Amy", "email": "a@x", "id": "4", "source": "main"},
        {"name": "amy ", "email": "later@x", "id": "4", "source": "main"},
    ]
    first = load_directory(spark, lines(tmp_path / "d.jsonl", rows))
    got = {r.id: r for r in first.collect()}
    assert set(got) == {"3", "4"} and got["4"].email == "a@x" and got["4"].regions == []
    assert got["3"].extras == {"status": "s1", "loud": "5"} and got["3"].hidden is True and got["4"].hidden is None
    write_directory(first, str(tmp_path / "out.jsonl"), "jsonl")
    again = load_directory(spark, str(tmp_path / "out.jsonl"))
    seen = {r.id: r for r in again.collect()}
    for key in got:
        assert {**seen[key].asDict(), "pos": 0} == {**got[key].asDict(), "pos": 0}
    # Published in name order.
    assert [r.id for r in again.orderBy("pos").collect()] == ["4", "3"]
    write_directory(first, str(tmp_path / "out.parquet"))
    assert [r.id for r in load_directory(spark, str(tmp_path / "out.parquet")).orderBy("pos").collect()] == ["4", "3"]


def test_unreadable_directory_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        load_directory(spark, str(tmp_path / "none.jsonl")).collect()


def test_state_missing_or_there(spark, tmp_path):
    path = str(tmp_path / "geo")
    assert load_state(spark, path, GEOCODE_CACHE).count() == 0
    spark.createDataFrame([("q", 1.0, 2.0)], GEOCODE_CACHE).write.parquet(path)
    assert load_state(spark, path, GEOCODE_CACHE).collect() == [("q", 1.0, 2.0)]


def test_sales_of_a_year(spark, tmp_path):
    rows = [("closed", d) for d in ("2023-12-31", "2024-01-01", "2024-06-01", "2024-12-31")] + [("open", "2024-02-02")]
    path = lines(tmp_path / "s.jsonl", [{"id": i, "status": s, "closing_date": d} for i, (s, d) in enumerate(rows)])
    assert sorted(r.id for r in load_sales(spark, path, 2024).collect()) == [1, 2, 3]
    assert sorted(r.id for r in load_sales(spark, path, 2024, today=date(2024, 6, 1)).collect()) == [1, 2]


def test_reports_have_an_envelope(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",)], "name string")
    now = datetime(2024, 1, 31, tzinfo=timezone.utc)
    reports = {"two": ("Two rows.", rows), "none": ("No rows.", rows.where("false"))}
    heads = {r.report: r["count"] for r in write_reports(reports, str(tmp_path), now).collect()}
    assert heads == {"two": 2, "none": 0}
    back = spark.read.json(str(tmp_path / "rows"))
    assert sorted(r.name for r in back.where("report = 'two'").collect()) == ["a", "b"]
    dry = write_reports(reports, str(tmp_path / "dry"), now, dry_run=True)
    assert dry.where("dry_run").count() == 2 and not (tmp_path / "dry").exists()
    assert DIRECTORY.fieldNames()[-1] == "pos"


def test_positions_are_the_files_or_the_order(spark, tmp_path):
    """Positions of a file count only if every row has one; repeated ones are an error."""

    def lines(name, rows):
        path = tmp_path / f"{name}.jsonl"
        path.write_text("\n".join(rows))
        return str(path)

    rows = ['{"id": "1"}', '{"id": "2", "pos": 0}', '{"id": "3"}']
    mixed = load_rosters(spark, {"main": lines("mixed", rows)}).orderBy("pos").collect()
    assert [r.id for r in mixed] == ["1", "2", "3"] and len({r.pos for r in mixed}) == 3
    assert len({r.pos for r in load_directory(spark, lines("directory", rows)).collect()}) == 3
    given = load_rosters(spark, {"main": lines("given", ['{"id": "1", "pos": 7}', '{"id": "2", "pos": 4}'])})
    assert [(r.id, r.pos) for r in given.orderBy("pos").collect()] == [("2", 4), ("1", 7)]
    with pytest.raises(ValueError, match="share a position"):
        load_rosters(spark, {"main": lines("twice", ['{"id": "1", "pos": 4}', '{"id": "2", "pos": 4}'])})


def test_directory_positions_are_checked(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text('{"name": "a", "pos": 4}\n{"name": "b", "pos": 4}')
    with pytest.raises(ValueError, match="share a position"):
        load_directory(spark, str(path))


def test_state_keeps_the_newest_row_of_each_key(spark, tmp_path):
    path, schema = str(tmp_path / "state"), "k string, v long"
    table = lambda rows: spark.createDataFrame(rows, schema)
    read = lambda: dict(read_state(spark, path, "k", table([]).schema).collect())
    assert read() == {}
    with pytest.raises(ValueError, match="repeated"):
        write_state(table([("a", 1), ("a", 2)]), path, "k")
    with pytest.raises(ValueError, match="without k"):
        write_state(table([(None, 1)]), path, "k")
    write_state(spark.createDataFrame([("a", 1, 1), ("a", 2, 3), ("a", 3, 2), ("b", 4, 1)], "k string, v long, at long"), path, "k", order="at")
    assert read() == {"a": 2, "b": 4}
    want = {"a": 2, "b": 4}
    for n in range(12):  # over two compactions
        if n % 5 == 3:
            write_state(spark.createDataFrame([("b", None, True), ("never", 1, True)], "k string, v long, gone boolean"), path, "k", gone="gone")
            want.pop("b", None)
        else:
            write_state(table([("b", n), (f"k{n}", n)]), path, "k")
            want |= {"b": n, f"k{n}": n}
        assert read() == want
    kinds = [e["kind"] for e in versions.entries(spark, path)]
    assert kinds.count("base") == 2 and kinds.count("changes") == 12


def test_a_failed_write_leaves_the_old_directory(spark, tmp_path):
    path = str(tmp_path / "directory.parquet")
    first = load_directory(spark, _one(tmp_path, "1"))
    publish_directory(first, path)
    bad = first.withColumn("email", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        publish_directory(bad, path)
    assert [r.id for r in load_directory(spark, path).collect()] == ["1"]
    publish_directory(load_directory(spark, _one(tmp_path, "2")), path)
    assert [r.id for r in load_directory(spark, path).collect()] == ["2"]
    folder = versions.current(spark, path)
    with pytest.raises(Exception, match="(?i)already exists"):
        versions._commit(spark, path, versions.entries(spark, path)[-1]["version"], "base", folder)


def _one(tmp_path, n):
    lines = tmp_path / f"one{n}.jsonl"
    lines.write_text(f'{{"name": "n", "{DIRECTORY_FIELDS["id"]}": "{n}"}}')
    return str(lines)
