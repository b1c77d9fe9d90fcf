"""Worked examples of every column function."""

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from dirsync import functions as fn
from dirsync.config import DEFAULT_TITLE, GENERIC_TITLES, TITLE_SUFFIX

C = F.col
OFFICES = (("north", "North"), ("orth", "Other"), ("south", "South"))
MARKS, HOSTS = ("data", "/photos/"), ("cdn.a.example", "cdn.b.example")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


CASES = [
    (lambda: fn.fmt_phone(C("a")), [("1-555-123-4567", "(555) 123-4567"), ("5551234567", "(555) 123-4567"),
                                    ("25551234567", "25551234567"), ("12 34", "12 34"), ("", ""), (None, "")]),
    (lambda: fn.clean_title(C("a"), DEFAULT_TITLE, GENERIC_TITLES, TITLE_SUFFIX),
     [("agent", DEFAULT_TITLE), ("", DEFAULT_TITLE), (None, DEFAULT_TITLE), ("Broker / Agent", "Broker"),
      (" / Agent", DEFAULT_TITLE), ("Lead ", "Lead")]),
    (lambda: fn.infer_region(C("a"), OFFICES), [("NORTH wing", "North"), ("worthy", "Other"), ("x", None), (None, None)]),
    (lambda: fn.name_key(C("a")), [("O'Neil, J. 2", "oneilj"), ("123", ""), (None, "")]),
    (lambda: fn.slugify(C("a")), [("Ann O'Dell", "ann-odell"), ("Al-Said Bo", "al-said-bo"), (" --A  b!! ", "a-b"),
                                  ("René", "ren"), ("Zoé B", "zo-b"), ("!", "")]),
    (lambda: fn.strip_prefix(C("a")), [("006 - Laura", "Laura"), (" 0123 -  x", "x"), ("106 - x", "106 - x"), (None, ""),
                                       ("06-x", "06-x")]),
    (lambda: fn.split_list(C("a")), [("a, b ,,c ", ["a", "b", "c"]), ("", []), (None, [])]),
    (lambda: fn.url_hash(C("a")), [("http://x", sha("http://x")), ("", ""), (None, "")]),
    (lambda: fn.valid_url(C("a")), [("http://x", "http://x"), ("https://x", "https://x"), ("/x", ""), (None, ""), ("ftp://x", "")]),
    (lambda: fn.strip_house_no(C("a")), [("307 Elm St", "Elm St"), ("12B N Oak Blvd", "N Oak Blvd"), ("12-14 Market St", "Market St"),
                                         ("12–14b Market St", "Market St"), ("Birch Pl", "Birch Pl"), ("#5 A", "A"),
                                         ("5th Ave", "5th Ave"), ("", ""), (None, "")]),
    (lambda: fn.in_list_ci(C("a"), ["Agent ", "broker"]), [(" AGENT", True), ("Brokers", False), (None, False)]),
    (lambda: fn.host_class(C("a"), MARKS, HOSTS),
     [("", "blank"), (None, "blank"), ("https://h/data/photos/1.jpg", "self_hosted"), ("https://cdn.b.example/x", "trusted"),
      ("https://h/photos/1.jpg", "unknown")]),
    (lambda: fn.html_text(C("a")), [("A &amp; B", "A & B"), ("O&#39;Neil", "O'Neil"), ("plain", "plain"), (None, None),
                                    ("caf&eacute; &bogus;", "café &bogus;")]),
    (lambda: F.unix_seconds(fn.parse_iso(C("a"))),
     [("2024-01-10T00:00:00Z", 1704844800), ("2024-01-10T02:00:00+02:00", 1704844800), ("2024-01-10T00:00:00", 1704844800),
      ("2024-01-10", 1704844800), ("2024", None), ("soon", None), ("2024-13-01", None), ("", None), (None, None)]),
]


@pytest.mark.parametrize("make,rows", CASES)
def test_one_argument(spark, make, rows):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, a string")
    got = {r.i: r.out for r in df.select("i", make().alias("out")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


def test_naive_times_are_utc_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["2024-01-10", "2024-01-10T00:00", "2024-01-10 00:00:00", "2024-01-10T00:00:00.000000", "2024-01-10T00:00:00,5",
                 "2024-01-10T00:00:00Z", "2024-01-10T01:00:00+0100"]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, a string")
        got = [r.s for r in df.select("i", F.unix_seconds(fn.parse_iso(C("a"))).alias("s")).orderBy("i").collect()]
        assert got == [1704844800] * len(texts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_display_name(spark):
    rows = [
        (("Mohan", "Zed", "Mo", "x"), "Mo Zed"),
        (("006 - Laura", "Long", None, None), "Laura Long"),
        (("Ann", "Lee", "012 - Annie", None), "Annie Lee"),
        (("", " ", None, "009 - Full Name"), "Full Name"),
        ((None, None, None, None), None),
        ((None, "Solo", "", ""), "Solo"),
    ]
    df = spark.createDataFrame([(i, *a) for i, (a, _) in enumerate(rows)], "i int, f string, l string, p string, n string")
    got = df.select("i", fn.display_name(C("f"), C("l"), C("p"), C("n")).alias("out")).orderBy("i").collect()
    assert [r.out for r in got] == [want for _, want in rows]


def test_keys_prices_and_queries(spark):
    row = spark.range(1).select(
        fn.entity_key(F.lit(" 7 "), F.lit("a@b")).alias("by_id"),
        fn.entity_key(F.lit(" "), F.lit(" A@B ")).alias("by_mail"),
        fn.entity_key(F.lit(None).cast("string"), F.lit("")).alias("none"),
        fn.fmt_price(F.lit(1234567.99)).alias("price"),
        fn.addr_query(F.lit(" 1 Elm "), F.lit("Town"), F.lit(None).cast("string"), F.lit("01234"), "OH").alias("q"),
        fn.first_nonblank(F.lit(""), F.lit(None).cast("string"), F.lit(" ")).alias("first"),
        fn.age_seconds(F.lit("2024-01-30T23:00:00Z"), datetime(2024, 1, 31, tzinfo=timezone.utc)).alias("age"),
    ).first()
    assert row.by_id == "7" and row.by_mail == "email-" + sha("a@b") and row.none is None
    assert row.price == "$1,234,567" and row.q == "1 Elm, Town, OH 01234" and row.first == " " and row.age == 3600
