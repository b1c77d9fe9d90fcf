"""Entities in whole texts against the standard library."""

import html
import random

from pyspark.sql import functions as F

from dirsync.operators.entities import decode_entities


def test_texts_equal_the_library(spark):
    rnd = random.Random(1)
    names = list(html.entities.html5)
    bits = ["&", "&#", "&#x", ";", "a", "amp", "Ω", " ", "<", "notin", "lt", "&amp", "&notit;", "&#x110000;", "&#xD800;", "&#0;", "&#13;", "&#128;", "&#x9f", "&#129;", "&#65", "&#x41;G",
            "&#1;", "&#65534;", "&#x1F600;", "&#99999999999999999999;", "&#000000000065;", "&#x", "\n", "&#xFDD0;", "&#X4a;", "&#11", "&#xe9 ", "é"]
    texts = ["".join(rnd.choice(bits) if rnd.random() < 0.7 else "&" + rnd.choice(names) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    texts += [f"&{n}x &{n.rstrip(';')}" for n in names[::7]] + ["", None, "no reference", "&" * 5000, "x&amp;" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw string").withColumn("name", F.lit("clash")).repartition(5)
    got = {r.n: r.out for r in decode_entities(df, "raw", "out").collect()}
    assert got == {i: html.unescape(t) if t is not None else None for i, t in enumerate(texts)}


def test_rows_stay_and_nothing_runs_in_python(spark):
    df = spark.createDataFrame([(1, "a&lt;b", {"k": "v"})] * 3 + [(None, None, None)], "id int, raw string, extras map<string,string>")
    out = decode_entities(df, "raw", "raw_text")
    assert sorted((r.id or 0, r.raw_text or "") for r in out.collect()) == [(0, ""), (1, "a<b"), (1, "a<b"), (1, "a<b")]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and decode_entities(df.limit(0), "raw", "t").collect() == []
