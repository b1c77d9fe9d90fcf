"""Token counts, resampling and spelling variants against the library and brute force, and on awkward tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from dirsync.llm import importance, queries, transducer, variants

WORD = queries.tokenizer_path(queries.WORD_TOKENIZER)
SCHEMA = "doc_id bigint, text string, lang string, word string, n bigint, tie string, bucket int, rank string, shard string, h string, score string"
BITS = [" ", "\n", "\x1c", "\x85", "\xa0", " ", "a", "aa", "ing", "'s", "'", "'r", "'re", "'l", "'v", "e", "9", "٣", "é", "Σ", "İ", "<|startoftext|>",
        "<|endoftext|>", "<|", "</w>", "?!", "中", "é", "Ᲊ", "ö̲̈", "’", "œ", "the", "International", "𝔘", "²"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    texts = [None, "", " \n\t ", "a", "12 34", "one two three " * 9, "Straße élève ÀÉÎ×÷ " * 12, "x" * 30_000, "lorem ipsum dolor " * 20_000, "e'e " * 40]
    texts += ["abcdefgh abcdefgx abcdefg " * 9, "abcdefgh abcdefghi zbcdefgh " * 2, "word " * 20]
    rows = [(i, t, "en", *["q", 7, "q", 7, "q", "q", "q", "q"]) for i, t in enumerate(texts)]
    rows += [rows[-1], rows[-1], (5, "other text of an id that is not its own", *[None] * 9), (None, texts[6], *[None] * 9), (None, "word " * 30, *[None] * 9)]
    rows += [(-4, "minus four " * 15, *[None] * 9)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def sizes(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("chunk,few", [(128, 12), (4, 0), (1, 3)])
def test_counts_equal_the_library(library, monkeypatch, chunk, few):
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    monkeypatch.setattr(transducer, "FEW", few)
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(BITS, k=rnd.randint(0, 25))) for _ in range(2000)]
    texts += ["", "don't you'll 're''s ''''re x'", "abcdefghij" * 90, "".join(rnd.choices("etaoinshr", k=700)), "x " * 300, "'" * 300, "中" * 200]
    assert transducer.Transducer(WORD).count_texts([t.encode() for t in texts]).tolist() == sizes(library, texts)


def test_counts_with_few_states(library, monkeypatch):
    """Batches that ask for more states than they may are cut, down to single words."""
    monkeypatch.setattr(transducer, "ADDED_STATES", 60)
    monkeypatch.setattr(transducer, "KEPT_STATES", 30)
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choices("etaoinshrdlu'9é", k=rnd.randint(1, 12))) for _ in range(40)) for _ in range(12)]
    texts += ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=400))]
    compiler = transducer.Transducer(WORD)
    assert compiler.count_texts([t.encode() for t in texts]).tolist() == sizes(library, texts) and len(compiler.keys) <= 91


def test_seams_are_checked_by_merging():
    compiler = transducer.Transducer(WORD)
    merges = compiler.merges
    rng = np.random.default_rng(5)
    inner, last = list(merges.inner.items()), list(merges.last.items())
    for x, y in zip(rng.integers(0, len(inner), 3000).tolist(), rng.integers(0, len(last), 3000).tolist()):
        (s, a), (t, b) = inner[x], last[y]
        assert compiler.compatible(a, b) == (merges.merge(s + t) == [a, b])


def test_counts_of_documents(spark, odd, empty, library):
    rows = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in transducer.count_tokens(odd, WORD).collect())
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    want = Counter((i, len(t.encode()), n, n > 2048) for (i, t), n in zip(texts, sizes(library, [t for _, t in texts]), strict=True))
    assert rows == want
    assert transducer.count_tokens(empty, WORD).collect() == []


def test_crc_of_spans():
    rnd = random.Random(1)
    data = bytes(rnd.randrange(256) for _ in range(200_000))
    lengths = np.array([rnd.choice([1, 2, 5, 63, 64, 65, 127, 128, 129, 1000, 70_000]) for _ in range(200)])
    starts = np.array([rnd.randrange(len(data) - n) for n in lengths.tolist()])
    got = importance.span_crc32(np.frombuffer(data, np.uint8), starts, lengths)
    assert got.tolist() == [zlib.crc32(data[s : s + n]) for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
    assert importance.span_crc32(np.zeros(0, np.uint8), lengths[:0], lengths[:0]).tolist() == []


def features(text, most):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [zlib.crc32(" ".join(words[i : i + k]).encode()) % importance.BUCKETS for k in range(1, most + 1) for i in range(len(words) - k + 1)]


@pytest.mark.parametrize("most", [1, 3])
def test_resampling_equals_brute_force(spark, odd, empty, sf_dir, most):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 100 AS doc_id", "text").unionByName(odd.select("doc_id", "text"))
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, wanted = [tuple(r) for r in docs.collect()], [r.text for r in target.collect()]
    s, t = (Counter(b for x in texts for b in features(x, most)[1]) for texts in ([x for _, x in rows], wanted))
    whole_s, whole_t, n = sum(s.values()), sum(t.values()), importance.BUCKETS
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (whole_s + n) / ((s[b] + 1.0) * (whole_t + n)))) for b in s}
    want, ranked = [], []
    for i, text in rows:
        words, codes = features(text, most)
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in codes)
        want.append((i, len(codes), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        if len(words) >= 20:
            ranked.append(want[-1])
    ranked.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = defaultdict(list)
    for k, r in enumerate(ranked[: 10 * len(ranked) // 100], 1):
        ranks[r].append(k)
    got = importance.resample(docs, target, most=most).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(want)
    found = defaultdict(list)
    for r in got:
        if r["rank"]:
            found[tuple(r)[:4]].append(r["rank"])
    assert {k: sorted(v) for k, v in found.items()} == ranks
    assert importance.resample(empty, target).collect() == [] and importance.resample(docs, target.limit(0)).count() == len(rows)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("shards,block", [(1, 200_000), (7, 50)])
def test_near_words_equal_brute_force(monkeypatch, shards, block):
    monkeypatch.setattr(variants, "BLOCK", block)
    monkeypatch.setattr(variants, "LETTERS", block * 20)
    rnd = random.Random(1)
    words = {"".join(rnd.choices("entiarsohlduqxzéß", k=rnd.randint(7, 11))) for _ in range(200)} | {"q" * 500, "q" * 499, "x" + "q" * 499}
    for w in list(words):
        for _ in range(4):
            i, kind = rnd.randrange(len(w)), rnd.choice("dri")
            words.add(w[:i] + w[i + 1 :] if kind == "d" else w[:i] + rnd.choice("entiarqz") + w[i + (kind == "r") :])
    words = sorted(words)
    own = variants.Words([w.encode("latin-1") for w in words], np.arange(len(words)))
    dealt = defaultdict(lambda: ([], []))
    for shard, kind, who in variants.visits(own, shards):
        dealt[shard][kind].append(own.take(who).press())
    got = []
    for held, visitors in dealt.values():
        trie = variants.Trie(variants.Words.unpressed(held))
        for asked in (trie.words, variants.Words.unpressed(visitors)):
            for i, j in trie.near(asked):
                got += [tuple(sorted((asked.words[a].decode("latin-1"), trie.words.words[b].decode("latin-1")))) for a, b in zip(i, j, strict=True)]
    want = {(a, b) for a in words for b in words if a < b and abs(len(a) - len(b)) < 2 and near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_variants_equal_brute_force(spark, odd, empty):
    docs = [(i, "colour's Colourful colourfull " * k + "colourfil naïveté naïvetés naïvetè ÀÀÀÀÀÀÀ àÀÀÀÀÀÀ") for i, k in enumerate([1, 2, 3, 11, 40] * 8)]
    docs += [(100 + i, "colourful " * 300 + "xolourful xolourfulx") for i in range(6)]
    docs += [(200 + i, "chainword " * 180 + "chainwork " * 14 + "chainworkk") for i in range(10)]
    rows = docs + [(r.doc_id, r.text) for r in odd.collect()]
    n = Counter()
    for i, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    close = {w: [x for x in n if x != w and abs(len(x) - len(w)) < 2 and near(w, x)] for w in n}
    best = {w: min(close[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: x if x and n[x] >= 10 * n[w] else None for w, x in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    want = {(w, form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n}
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = [tuple(r) for r in variants.spelling_variants(df).collect()]
    assert len(got) == len(want) and set(got) == want and any(form[w] and form[form[w]] for w in n)
    assert variants.spelling_variants(odd).count() > 0 and variants.spelling_variants(empty).collect() == []
