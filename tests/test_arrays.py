import json
import random

import pytest

from dirsync.schemas import GEOCODE_CACHE
from dirsync.sources import load_sales, load_state
from dirsync.sources.arrays import json_elements

PARTS = ["a", "}", "{", "]", "[", '"', "\\", ",", "\n", "é", "}{", '"}', "\\\"", " ", ""]


def record(rng):
    def text():
        return "".join(rng.choices(PARTS, k=rng.randrange(9)))

    inner = {text(): [text(), {text(): None}], "n": rng.randrange(9)}
    return rng.choice([{}, {"k": text()}, {"k": inner, "z": text()}, {"k" + text(): [inner, [], {}]}])


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97b", "spark.sql.files.openCostInBytes": "1b"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_of_any_text_over_many_splits(spark, tmp_path, small_splits, indent):
    rng = random.Random(5)
    files = [[record(rng) for _ in range(n)] for n in (40, 0, 1, 25)]
    for i, rows in enumerate(files):
        (tmp_path / f"{i}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False) + "\n" * (i % 2))
    found = json_elements(spark, str(tmp_path)).orderBy("at").collect()
    assert [r.at for r in found] == list(range(66)) and {r.key for r in found} == {None}
    assert [json.loads(r.text) for r in found] == [r for rows in files for r in rows]


@pytest.mark.parametrize("tail", ["", "\n"])
def test_keyed_objects(spark, tmp_path, small_splits, tail):
    rng = random.Random(7)
    rows = {f"{i}{''.join(rng.choices(PARTS, k=4))}": record(rng) for i in range(40)}
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"version": 1} | rows) + tail)
    found = json_elements(spark, str(path)).orderBy("at").collect()
    assert [(r.key, json.loads(r.text)) for r in found] == list(rows.items())


def test_state_under_its_keys(spark, tmp_path):
    path = tmp_path / "cache.json"
    path.write_text(json.dumps({"1 a st": {"lat": 1, "lng": 2.5}, "2 b st": {"lat": None, "other": {"x": 1}}}))
    names = GEOCODE_CACHE.fieldNames()
    found = load_state(spark, str(path), GEOCODE_CACHE, fmt="keyed", key=names[0])
    assert sorted(map(tuple, found.collect())) == [("1 a st", 1.0, 2.5), ("2 b st", None, None)]
    assert load_state(spark, str(tmp_path / "none.json"), GEOCODE_CACHE, fmt="keyed", key=names[0]).count() == 0
    with pytest.raises(ValueError, match="key="):
        load_state(spark, str(path), GEOCODE_CACHE, fmt="keyed")


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1},', '[{"a": 1}, {"b"', '[{"a": "x', '{"k": {"a": 1}', '[{"a": "}'])
def test_files_cut_off_are_refused(spark, tmp_path, text):
    path = tmp_path / "cut.json"
    path.write_text(text)
    with pytest.raises(ValueError, match="not one whole"):
        json_elements(spark, str(path)).collect()


@pytest.mark.parametrize("text", ["", "[]", "{}", " \n[ ]\n", "[1, 2]", "[[], {}]"])
def test_files_without_rows(spark, tmp_path, text):
    path = tmp_path / "none.json"
    path.write_text(text)
    assert [r.text for r in json_elements(spark, str(path)).collect()] == (["{}"] if text == "[[], {}]" else [])


def test_sales_of_an_array(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps([{"id": 1, "status": "closed", "closing_date": "2024-02-01", "note": {"a": [1]}}, {"id": 2, "status": "open"}], indent=1))
    assert [r.id for r in load_sales(spark, str(path), 2024).collect()] == [1]
