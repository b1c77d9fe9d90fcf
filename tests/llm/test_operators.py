"""Operators against brute force, the library, or held-out labels, and on awkward tables."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from dirsync.llm import bpe, components, encoding, hnsw, hostrules, language, nearcopies, packing, planes, quality, queries, repeats, simhash, urlfilter
from dirsync.llm.common import held_out
from pyspark.sql import functions as F

BYTE = queries.tokenizer_path(queries.BYTE_TOKENIZER)
WORD = queries.tokenizer_path(queries.WORD_TOKENIZER)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, fp string, row string, shard string, i string, t string, label double"
LONG = "lorem ipsum dolor " * 120_000  # over two pieces of the repeat search
COPY = "A passage that is longer than fifty bytes and stands in several documents. "


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    texts = [None, "", " \n\t ", "a", "12 34", COPY, COPY + "tail", "head " + COPY, LONG, "é" * 70, "é" * 70 + "x", "x y z\n" * 40, COPY]
    rows = [(i, t, "en", "s", 1, *["q"] * 6, 0.5) for i, t in enumerate(texts)]
    rows += [(5, COPY, "en", "s", 1, *["q"] * 6, 0.5), (7, "other text of id seven, no copy", None, None, None, *[None] * 6, None)]
    rows += [(None, COPY, None, None, None, *[None] * 6, None), (-3, "minus three " + COPY, "de", "s", 1, *["q"] * 6, 0.5)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_repeats(rows):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for s in range(len(t) - 49):
            first.setdefault(t[s : s + 50], i)
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 49):
            if first[t[s : s + 50]] < i:
                gone[s : s + 50] = True
        out.append((i, len(t), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest(), int(gone.sum())))
    return Counter(out)


def test_repeats_equal_brute_force(spark):
    rnd = random.Random(4)
    words = [rnd.choice(["ab", "the ", "oñ", "x", "longer word ", "aaaa"]) * rnd.randint(1, 3) for _ in range(30)]
    parts = ["".join(rnd.choices(words, k=rnd.randint(3, 30))) for _ in range(12)]
    rows = [(i, "".join(rnd.choices(parts, k=rnd.randint(0, 4))) + rnd.choice(["", "a", "zz"])) for i in range(-20, 80)]
    rows += [(3, rows[50][1]), (3, rows[51][1])]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = Counter((r.doc_id, r.n_bytes, r.sha256, r.n_removed) for r in repeats.remove_repeats(df).collect())
    assert got == brute_repeats([(i, t.encode()) for i, t in rows])


def test_repeats_on_awkward_rows(odd, empty):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.select("doc_id", "text").collect() if r.text != LONG]
    found = repeats.remove_repeats(odd.where(F.coalesce("text", F.lit("")) != LONG))
    got = Counter((r.doc_id, r.n_bytes, r.sha256, r.n_removed) for r in found.collect() if r.doc_id is not None)
    assert got == brute_repeats([r for r in rows if r[0] is not None])
    assert {r.n_removed for r in found.collect() if r.doc_id is None} == {0}
    assert [f.name for f in found.schema["row"].dataType][:1] == ["lang"]
    assert repeats.remove_repeats(empty).collect() == []


def test_repeats_in_texts_over_several_pieces(spark):
    rnd = random.Random(1)
    text = "".join(rnd.choices("abcdefgh ", k=2_300_000))
    cut = text[990_000:1_010_000]
    df = spark.createDataFrame([(1, text), (2, "x" + cut + "y"), (3, text)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeats(df).collect()}
    assert got == {1: 0, 2: len(cut), 3: len(text)}


def test_family_keeps_few_levels():
    family, rng = repeats.Family(), np.random.default_rng(0)
    for i in range(64):
        key, cls = (rng.integers(0, 2**60, 50).astype(np.uint64) for _ in range(2))
        family.add(key, cls, np.full(50, i, np.uint64))
    assert len(family.levels) <= 7 and sum(map(len, family.levels)) == 64 * 50


@pytest.mark.parametrize("batch", [7, 40, 1000])
def test_windows_are_told_apart_by_bytes(batch):
    """Windows that differ in one byte, zeros at the end among them, in any order of documents."""
    rng = np.random.default_rng(batch)
    strings = rng.integers(0, 2, (60, 3), dtype=np.uint8)[rng.integers(0, 60, 1000)]
    data = np.concatenate([np.full((1000, 47), 7, np.uint8), strings], axis=1)
    doc, number = rng.integers(0, 300, 1000).astype(np.uint64), np.arange(1000, dtype=np.uint64)
    family, late = repeats.WindowFamily(), []
    for a in range(0, 1000, batch):
        rows = np.arange(a, min(a + batch, 1000))
        late += family.add(repeats.Windows.cut(data, rows, np.zeros(len(rows), int), doc[rows], number[rows], np.zeros(len(rows), np.uint8)))
    told = {int(i) for w in late for i in w.cls}
    first = {}
    for i in range(1000):
        first[data[i].tobytes()] = min(first.get(data[i].tobytes(), 10**9), int(doc[i]))
    assert told == {i for i in range(1000) if first[data[i].tobytes()] < doc[i]}
    assert all((w.string[1:] >= w.string[:-1]).all() for w in family.levels) and len(family.levels) <= 11


def test_open_windows_travel_small():
    """Of an anchor's context only open windows go along, in one compressed run for each shard; nothing of them is lost."""
    rnd, rng = random.Random(8), np.random.default_rng(8)
    words = [f"word{i} " for i in range(300)]
    texts = ["".join(rnd.choices(words, k=40)).encode() for _ in range(40)]
    rows, size = [], 0
    for _, _, _, s in repeats.pieces(texts):
        at = np.flatnonzero((s.left == 30) & (s.right == 50))
        bits = np.uint64(1) << rng.integers(0, 31, len(at)).astype(np.uint64)
        rows.append((s.unit[at], s.at[at], s.key[at], s.cls[at], s.unit[at].astype(np.uint64), s.left[at], bits, repeats._context(s, at)))
    anchors = repeats.Open(rows).once()[0]

    def told(anchors):
        w = anchors.windows()
        return sorted(zip(*(x.tolist() for x in (w.string, w.doc, w.cls, w.place)), strict=True))

    back = []
    for _, blob in anchors.blobs(8):
        size += len(blob)
        back += told(repeats.Open.read(blob))
    assert sorted(back) == told(anchors) and len(back) == len(anchors.doc) > 300
    assert size < 0.75 * len(anchors.doc) * (repeats.REACH + 8)
    gone = np.arange(len(texts[0])) < 200
    sent = repeats._blanked(texts[0], gone, b"")
    assert zstandard.decompress(sent) == b"\0" * 200 + texts[0][200:] and repeats._blanked(texts[0], gone & False, b"as it is") == b"as it is"
    few, many = [rng.integers(0, 99, n).astype(np.uint64) for n in (20, 5000)]
    for columns in ([few, few], [many, many]):
        assert all((a == b).all() for a, b in zip(repeats._unsqueeze(repeats._squeeze(*columns)), columns, strict=True))
    assert len(repeats._squeeze(few, few)) < 120


def test_plain_segments_are_told_many_at_once():
    """Each segment is looked at alone only where its neighbours are not all plain."""
    encoder, looked = encoding.LibraryEncoder(BYTE), []
    class Counting:
        def search(self, text):
            looked.append(text)
            return "<|endoftext|>" in text
    encoder.special = Counting()
    segments = [f" w{i}" for i in range(2000)]
    segments[700], segments[1500] = " \u4e2d", " <|endoftext|>"
    assert encoder._plain(segments) == [i for i in range(2000) if i not in (700, 1500)]
    assert len(looked) < 800


def test_texts_are_cut_on_their_bytes():
    """Many texts at once give the segments of each alone, every distinct one once."""
    rnd = random.Random(8)
    bits = [" ", "\n", "a", "b's", "'re", "'", "''", "12", "é", "×", "<|endoftext|>", "!!", "中", ".", "the", " the", "'a'b'", "\t", "\x00", "\x7f"]
    texts = ["", "'", "a", "'a", "a'", " 'a", "'", "a", "", "\n"] + ["".join(rnd.choices(bits, k=rnd.randint(0, 9))) for _ in range(20_000)]
    encoder = encoding.LibraryEncoder(BYTE)
    want = [encoder.cut(t) for t in texts]
    assert sum(map(encoding._evenly_spaced, texts)) > 3000
    segments, which, counts = encoding.distinct_before_space(texts, encoder.special)
    assert len(segments) == len(set(segments)) and counts.tolist() == list(map(len, want))
    assert [segments[k] for k in which.tolist()] == [s for w in want for s in w]
    for none in ([], ["", ""]):
        assert encoder.encode(none)[1].tolist() == [0] * len(none)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_segments_give_the_ids_of_whole_texts(path):
    rnd = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "\x1c", "\xa0", "a", "b's", "'re", "12", "é", "Σ", "İ", "<|endoftext|>", "</w>", "!!", "中", "e\u0301", ".", "the", "\r\n"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 25))) for _ in range(3000)]
    encoder = encoding.LibraryEncoder(path, kept=500)
    ids, sizes = encoder.encode(texts)
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_bpe_equals_the_library(odd, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    rnd = random.Random(3)
    bits = [" ", "\n", "\x1c", "a", "aa", "ing", "'s", "9", "é", "Σ", "İ", "<|startoftext|>", "</w>", "?!", "中", "e\u0301", "\u1c89", "ö̲̈"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 20))) for _ in range(3000)]
    encoder = bpe.SpeculativeEncoder(WORD)
    ids, sizes = encoder.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    assert [encoder.decode(w) for w in want] == [library.decode(w, skip_special_tokens=False) for w in want]
    rows = bpe.encode_and_decode(odd, WORD).collect()
    assert len(rows) == odd.count() and {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert bpe.encode_and_decode(empty, WORD).collect() == []


def test_neighbours_are_checked_by_merging():
    merges = bpe.SpeculativeEncoder(WORD).merges
    rng = np.random.default_rng(5)
    inner = np.array(sorted(merges.inner.values()))
    a, b = rng.choice(inner, 4000), rng.choice(np.array(sorted(merges.last.values())), 4000)
    text = {i: t for t, i in merges.inner.items()}
    last = {i: t for t, i in merges.last.items()}
    want = [merges.merge(text[x] + last[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert merges.compatible(a, b).tolist() == want


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes_round_trip(kind):
    for n in (0, 1, 7, 65_536):
        ids = np.random.default_rng(n).integers(0, 2**32 if n == 7 else 50_257, n).astype(np.uint32)
        assert (planes.from_planes(planes.to_planes(ids, kind), n, kind) == ids).all()


def test_token_table_reads_back(spark, odd, empty, tmp_path):
    path = str(tmp_path / "ids")
    planes.write_token_table(odd, path, BYTE)
    rows = planes.with_starts(planes.read_token_table(spark, path), path).orderBy("start").collect()
    assert len(rows) == odd.count()
    at, encoder = 0, encoding.LibraryEncoder(BYTE)
    texts = Counter((r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect())
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.start == at and len(ids) == r.n_tokens and ids[-1] == 0
        at += r.n_tokens
        texts[r.doc_id, encoder.tokenizer.decode(ids[:-1].tolist(), skip_special_tokens=False)] -= 1
    assert not any(texts.values())
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known)
    planes.write_token_table(empty, path + "-none", BYTE)
    assert planes.read_token_table(spark, path + "-none").collect() == []


def test_packing_contract(spark, odd, empty, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = docs.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(odd.select("doc_id", "text"))
    rows = packing.pack(both, WORD).collect()
    encoder, sequences, total = encoding.LibraryEncoder(WORD), {}, 0
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
        n = sum(r.length for r in own)
        assert n <= packing.WINDOW and {r.padding for r in own} == {0 if n & (n - 1) == 0 else packing.WINDOW - n}
        total += n
    padded = sum(own[0].padding for own in sequences.values())
    assert padded < 0.02 * total + 2 * packing.WINDOW * both.rdd.getNumPartitions()
    unique = {r.doc_id: r.text for r in docs.collect()}
    for i, text in list(unique.items())[:60]:
        own = sorted((r for r in rows if r.doc_id == i + 1000), key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own])
        assert ids.tolist() == [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert {r.doc_tokens for r in own} == {len(ids)}
    assert packing.pack(empty, WORD).collect() == []


def test_differencing_is_near_equal():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 513, 400)
    part = packing.differencing(sizes, 50)
    loads = np.bincount(part, sizes, 50)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() < 40
    assert np.bincount(packing.spread(np.array([1500] * 9)), minlength=9).tolist() == [1] * 9
    assert packing.differencing(np.zeros(0, int), 3).tolist() == []


def slow_simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups_equal_brute_force(spark, odd, empty, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(odd.select(F.col("doc_id") + 10_000, "text"))
    rows = docs.collect()
    prints = [slow_simhash(r.text or "") for r in rows]
    label = [r.doc_id for r in rows]
    groups = list(range(len(rows)))
    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 4 and groups[i] != groups[j]:
                a, b = groups[i], groups[j]
                groups = [b if g == a else g for g in groups]
    least = {g: min(n for n, k in zip(label, groups, strict=True) if k == g and n is not None) for g in set(groups)}
    want = Counter((n, f"{p:016x}", least[g]) for n, p, g in zip(label, prints, groups, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect())) == want
    assert simhash.near_duplicates(empty).collect() == []


def words_of(text):
    return (text or "").encode().lower().split()


def brute_components(close):
    """The smallest number each row reaches."""
    least = np.arange(len(close))
    while True:
        after = np.minimum(least, np.where(close, least, len(close)).min(axis=1))
        if (after == least).all():
            return least.tolist()
        least = after


def brute_near_copies(texts):
    """Group number of each text, by all pairs."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in map(words_of, texts)]
    groups = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            close = len(x & sets[j]) >= 0.8 * len(x | sets[j]) if x or sets[j] else True
            if close and groups[i] != groups[j]:
                a, b = groups[i], groups[j]
                groups = [b if g == a else g for g in groups]
    return groups


def test_near_copies_equal_brute_force(spark, odd, empty, sf_dir):
    rnd = random.Random(6)
    edited = []
    for _ in range(40):  # copies on both sides of the bound, most of them more than 4 bits away
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([5, 9, 40, 150, 400]))]
        edited.append(base)
        for _ in range(5):
            copy = list(base)
            for _ in range(rnd.randint(1, max(1, len(base) // 30))):
                copy[rnd.randrange(len(copy))] = "changed"
            edited.append(copy + [f"tail{k}" for k in range(rnd.randint(0, len(base) // 8))])
    rows = [(20_000 + i, " ".join(w)) for i, w in enumerate(edited)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    rows = sorted(docs.collect())
    groups = brute_near_copies([r.text for r in rows])
    first = {}
    for r, g in zip(rows, groups, strict=True):
        first.setdefault(g, r.doc_id)
    assert sorted(r.doc_id for r in nearcopies.drop_copies(docs).collect()) == sorted(first.values())
    assert nearcopies.drop_copies(empty).collect() == []


def test_near_copies_come_from_close_fingerprints(spark):
    """Candidates are members with a close SimHash fingerprint of one kind, whatever else they share."""
    rng = np.random.default_rng(3)
    prints = rng.integers(-(2**62), 2**62, (400, nearcopies.PRINTS))
    for i in range(0, 200, 2):  # each second one is close in one kind: the same fingerprint, or up to eight bits away
        kind, flips = i % nearcopies.PRINTS, rng.choice(63, i % 9, replace=False)
        prints[i + 1, kind] = prints[i, kind] ^ sum(1 << int(b) for b in flips)
    rows = [(i, p) for i, p in enumerate(prints.tolist())]
    links = nearcopies.close_members(spark.createDataFrame(rows, "member bigint, prints array<bigint>")).collect()
    assert {tuple(sorted(r)) for r in links} == {(i, i + 1) for i in range(0, 200, 2)}


def test_a_dense_group_gives_few_links(spark):
    """Near copies of one text meet at very many anchors; what connects them already gives no more links."""
    rng = np.random.default_rng(7)
    base, weak = rng.integers(-(2**62), 2**62, nearcopies.PRINTS), rng.integers(0, 62, (nearcopies.PRINTS, 14))
    prints = np.concatenate([np.tile(base, (900, 1)), rng.integers(-(2**62), 2**62, (100, nearcopies.PRINTS))])
    for i in range(900):
        for kind in range(nearcopies.PRINTS):
            prints[i, kind] ^= sum(1 << int(b) for b in set(rng.choice(weak[kind], 6)))
    members = spark.createDataFrame(list(enumerate(prints.tolist())), "member bigint, prints array<bigint>")
    links = np.array([sorted(r) for r in nearcopies.close_members(members).collect()])
    assert len(links) < 2 * len(prints)
    linked, close = np.zeros((2, 1000, 1000), bool)
    linked[links[:, 0], links[:, 1]] = linked[links[:, 1], links[:, 0]] = True
    for kind in range(nearcopies.PRINTS):
        at = {fp: i for i, fp in enumerate(prints[:, kind].tolist())}
        for r in simhash.fingerprint_links(members.select(F.col("prints")[kind].alias("fp")).distinct(), nearcopies.NEAR).collect():
            close[at[r.a], at[r.b]] = close[at[r.b], at[r.a]] = True
        close |= prints[:, kind][:, None] == prints[:, kind]
    assert brute_components(linked) == brute_components(close)


def test_members_close_by_chance_are_left_out(spark):
    """A fingerprint of one kind in common used to be enough, and such links grow with the square of the texts."""
    rng = np.random.default_rng(8)
    prints = rng.integers(-(2**62), 2**62, (200, nearcopies.PRINTS))
    for i in range(0, 100, 2):  # close in all kinds, or in one
        for kind in range(nearcopies.PRINTS if i % 4 else 1):
            prints[i + 1, kind] = prints[i, kind] ^ sum(1 << int(b) for b in rng.choice(63, i % 9, replace=False))
    members = spark.createDataFrame(list(enumerate(prints.tolist())), "member bigint, prints array<bigint>")
    links = nearcopies.close_members(members, nearcopies.NEAR_ALL).collect()
    assert {tuple(sorted(r)) for r in links} == {(i, i + 1) for i in range(2, 100, 4)}


def test_all_links_of_a_sparse_bucket_come_out(spark):
    prints = spark.createDataFrame([(0,), (1,), (3,)], "fp bigint")
    assert len(simhash.fingerprint_links(prints, 2, simhash.own_runs).collect()) == 2
    found = simhash.fingerprint_links(prints, 2, simhash.own_runs, each=1).collect()
    assert {tuple(sorted((r.a, r.b))) for r in found} == {(0, 1), (0, 3), (1, 3)}


def test_set_links_equal_brute_force():
    rng = np.random.default_rng(9)
    for n in (1, 5, 40, 80):
        base, sets = rng.integers(0, 300, 30).astype(np.uint64), []
        for _ in range(n):
            s = base.copy() if rng.random() < 0.7 else rng.integers(0, 300, rng.integers(0, 30)).astype(np.uint64)
            s[: rng.integers(0, 6)] = rng.integers(0, 300)
            sets.append(np.unique(s))
        a, b = nearcopies.set_links(sets)
        found, close = np.zeros((2, n, n), bool)
        found[a, b] = found[b, a] = True
        for i in range(n):
            for j in range(n):
                both = len(np.intersect1d(sets[i], sets[j]))
                close[i, j] = i != j and both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9
        assert (found <= close).all() and brute_components(found) == brute_components(close)


def test_sets_that_share_little_are_not_all_compared():
    """Each set used to be compared with all that were left: two minutes here."""
    rng = np.random.default_rng(10)
    common = rng.integers(0, 2**62, 100).astype(np.uint64)
    sets = [np.unique(np.append(common, rng.integers(0, 2**62, 300).astype(np.uint64))) for _ in range(4000)]
    sets.append(sets[7][:390])
    began = time.monotonic()
    assert nearcopies.set_links(sets) == ([7], [4000])
    assert time.monotonic() - began < 20


def test_links_between_known_groups_only(spark):
    """Fingerprints that are known to be connected give no links among themselves, nulls count as not known."""
    rows = [(0, 5), (1, 5), (3, 6), (7, None), (15, None), (1 << 40, 8)]
    prints = spark.createDataFrame(rows, "fp bigint, known bigint")
    group = {0: 5, 1: 5, 3: 6, 1 << 40: 8}
    found = [(r.a, r.b) for r in simhash.fingerprint_links(prints, 1).collect()]
    assert {tuple(sorted(group.get(x, -x) for x in r)) for r in found} == {(5, 6), (5, 8), (-7, 6), (-15, -7)}
    none = prints.withColumn("known", F.lit(5).cast("bigint"))
    assert simhash.fingerprint_links(none, 1).collect() == []
    runs = [(r.a, r.b) for r in simhash.fingerprint_links(prints.drop("known"), 1, simhash.own_runs).collect()]
    assert {tuple(sorted(r)) for r in runs} == {(0, 1), (1, 3), (3, 7), (7, 15), (0, 1 << 40)}


def test_rows_with_links_equal_brute_force():
    rng = np.random.default_rng(4)
    key = np.sort(rng.integers(0, 60, 500))
    fp = rng.integers(0, 2**63, 40).astype(np.uint64)[rng.integers(0, 40, 500)] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    close = (np.bitwise_count(fp[:, None] ^ fp) <= 2) & (key[:, None] == key) & ~np.eye(500, dtype=bool)
    assert simhash.with_links(key, fp, 2).tolist() == close.any(axis=1).tolist()
    a, b = simhash.spanning(fp, 2)
    group = brute_components(np.bitwise_count(fp[:, None] ^ fp) <= 2)
    linked = np.zeros((500, 500), bool)
    linked[a, b] = linked[b, a] = True
    assert brute_components(linked) == group


def test_one_row_of_each_group_stays(spark, odd):
    """Null and shared ids: a group never goes as a whole, and never leaves two rows."""
    good = [" ".join(f"{c}{k}" for k in range(60)) for c in "abcdef"]
    rows = [(None, good[0], "x"), (None, good[1], "x"), (None, good[1] + " end", "y"), (7, good[1], "z"), (5, good[2], "x"), (5, good[3], "x")]
    rows += [(5, good[3], "x"), (6, good[3] + " end", "x"), (3, good[4], None), (3, good[4], "x"), (None, good[5], None), (None, good[5], None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    kept = nearcopies.drop_copies(df).collect()
    want = [("None", good[0]), ("7", good[1]), ("5", good[2]), ("5", good[3]), ("3", good[4]), ("None", good[5])]
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted(want)
    rows = odd.collect()
    left = nearcopies.drop_copies(odd).collect()
    groups = dict(zip([r.text for r in rows], brute_near_copies([r.text for r in rows]), strict=True))
    assert len(left) == len(set(groups.values())) == len({groups[r.text] for r in left})


def test_a_hub_is_split(spark):
    """The links of a star's centre, which are all links, can be split over tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        star = spark.range(1, 60_001, 1, 8).select(F.col("id").alias("u"), F.floor(F.col("id") / 100_000).alias("v"))
        minima = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min("v").alias("m"))
        out = components._found(star, minima, "v").select("u", "m")
        assert len(out.collect()) == 60_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = components.components(star, "u", "v").agg(F.count("*"), F.max("component")).first()
    assert tuple(got) == (60_001, 0)


def test_anchors_meet_all_close_prints():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**63, 300).astype(np.uint64)
    near = fp.copy()
    for k in range(300):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            near[k] ^= np.uint64(1) << np.uint64(b)
    owner, key = simhash.anchors(np.concatenate([fp, near]))
    of = [set() for _ in range(600)]
    for o, k in zip(owner.tolist(), key.tolist(), strict=True):
        of[o].add(k)
    assert all(of[i] & of[i + 300] for i in range(300))


def test_vectors_equal_brute_force(spark, sf_dir):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    v = np.concatenate([base, base[:20] + 0.05 * rng.normal(size=(20, 16)), base[:1] + 0.01 * rng.normal(size=(80, 16)), base[5:7] * 3, base[5:6]])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(900, None), (901, [0.0] * 16), (902, [1.0] * 15 + [None]), (903, [float("nan")] * 16), (904, [float("inf")] * 16), (905, [1.0, 2.0]), (None, v[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("v", F.lit("clash")).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(df, shards=3).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(v))
    for _ in range(len(v)):
        label = np.minimum(label, np.where(linked, label[None, :], len(v)).min(axis=1))
    for i in range(len(v)):
        assert got[i] == (linked[i].sum(), label[i], i == label[i])
    assert all(got[i] == (0, i, True) for i in range(900, 906)) and got[None][0] == 0 and got[None][2] is False
    assert hnsw.near_duplicates(df.limit(0)).collect() == []


def test_vectors_of_many_lengths_and_shared_ids(spark):
    """More lengths than any bound, two vectors of one id, and thousands of nodes with planted pairs."""
    rows = [(i, [1.0] + [0.0] * i) for i in range(1200)] + [(5000 + i, [2.0] + [0.0] * i) for i in range(1200)]
    rows += [(9000, [1.0, 1.0]), (9000, [1.0, -1.0]), (9001, [1.0, 1.01]), (9002, [1.0, -1.01])]
    got = [tuple(r) for r in hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), shards=2).collect()]
    assert {(i, n, c) for i, n, c, _ in got if i < 9000} == {x for i in range(1200) for x in ((i, 1, i), (5000 + i, 1, i))}
    assert sorted((i, n, c) for i, n, c, _ in got if i >= 9000) == [(9000, 1, 9000), (9000, 1, 9000), (9001, 1, 9000), (9002, 1, 9000)]
    rng = np.random.default_rng(7)
    v = rng.normal(size=(3000, 24))
    v[2000:] = v[rng.integers(0, 2000, 1000)] + 0.05 * rng.normal(size=(1000, 24))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>").repartition(4)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    found = np.array([r.n_links for r in hnsw.near_duplicates(df, shards=2).orderBy("vec_id").collect()])
    assert (found <= linked.sum(axis=1)).all() and found.sum() >= 0.99 * linked.sum() > 1500


def test_a_graph_has_only_what_may_have_a_link(monkeypatch):
    """Every query used to be searched in a graph of all members of every shard; of a foreign query's links both ends are counted."""
    sizes, graph = [], hnsw.Graph
    monkeypatch.setattr(hnsw, "Graph", lambda v: sizes.append(len(v)) or graph(v))
    rng = np.random.default_rng(11)
    v = rng.normal(size=(2000, 48))
    asked = rng.normal(size=(600, 48))
    asked[:20] = 2 * v[:20] + 0.01 * rng.normal(size=(20, 48))
    rows = [(0, 0, i, 1 + i % 2, x) for i, x in enumerate(v.tolist())] + [(0, 2, 5000 + i, 3, x) for i, x in enumerate(asked.tolist())]
    names = ["shard", "query", "node", "times", "v"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
    found = pa.Table.from_batches(hnsw._compare(iter([batch.slice(0, 900), batch.slice(900)]))).to_pylist()
    links = Counter({r["node"]: r["n_links"] for r in found if r["n_links"]})
    assert links == {i: 3 for i in range(20)} | {5000 + i: 1 + i % 2 for i in range(20)}
    assert {tuple(sorted((r["a"], r["b"]))) for r in found if r["a"] is not None} == {(i, 5000 + i) for i in range(20)}
    assert sizes == [20]


@pytest.mark.parametrize("width", [1, 2, 30, 700])
def test_bounds_lose_no_link(width):
    rng = np.random.default_rng(width)
    v = rng.normal(size=(500, width)) * rng.random(width) ** 3
    v[250:] = v[:250] + 0.2 * np.linalg.norm(v[:250], axis=1, keepdims=True) * rng.normal(size=(250, width)) / np.sqrt(width)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    own = np.where(np.arange(500) < 100, np.arange(500), -1)
    close = v @ v.T >= 0.95
    close[np.arange(100), np.arange(100)] = False
    asked, nodes = hnsw.Bound(v).possible(v, own, 0.95 - 1e-4)
    assert (asked >= close.any(axis=1)).all() and (nodes >= close.any(axis=0)).all()


def test_language_held_out(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = language.train(docs, ~held_out(F.col("doc_id")))
    rows = language.identify(docs, learned).join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.96 * len(rows)
    judged = {r.doc_id: r for r in language.identify(odd, learned).collect()}
    assert all(judged[i].lang_pred == "und" and judged[i].score == 0 for i in (0, 1, 2, 4)) and judged[5].lang_pred == "en"
    assert language.identify(empty, learned).collect() == [] and language.train(empty) == {}
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}


def test_long_clean_texts_are_sure(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    learned = language.train(docs, ~held_out(F.col("doc_id")))
    rows = docs.where(held_out(F.col("doc_id")) & F.col("text").isNotNull()).select("doc_id", "lang", "text").orderBy("doc_id").collect()
    texts = [(i, lang, "\n".join(r.text for r in rows if r.lang == lang)) for i, lang in enumerate(["en", "de", "fr"])]
    texts += [(10 + i, lang, (t * 5)[:4_000_000]) for i, lang, t in texts]
    judged = language.identify(spark.createDataFrame(texts, "doc_id bigint, lang string, text string"), learned)
    lang = {i: x for i, x, _ in texts}
    found = judged.collect()
    assert max(len(t) for _, _, t in texts) > 1_000_000
    assert all(r.sure and r.lang_pred == lang[r.doc_id] for r in found), (found, [len(t) for _, _, t in texts])


def test_samples_are_bounded_by_rows(spark, monkeypatch):
    """An id with very many different texts gives one of them, and its rows in other languages are not drawn along."""
    rows = [(1, f"text number {i} of the hot id {'!' * (i % 7)}", "en" if i % 2 else "de") for i in range(900)]
    rows += [(i, f"text of document {i} alone", "en" if i % 3 else "de") for i in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    taken, sampled, join, written = {}, [], language._join, quality.materialise
    monkeypatch.setattr(language, "_join", lambda texts: taken.setdefault(len(taken), len(texts)) and join(texts))
    language.train(docs)
    assert taken == {0: 100, 1: 200}  # de: 99 documents and the hot id, en: 199 and the hot id, all within the bound

    def materialise(df, name):
        found = written(df, name)
        sampled.append(found.count())
        return found

    monkeypatch.setattr(quality, "materialise", materialise)
    quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(1, 200)], "doc_id bigint, quality int"))
    assert sampled == [199]


def test_quality_held_out(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels, ~held_out(F.col("doc_id")))
    assert model.rules
    rows = quality.score(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert sum(r.predicted == r.quality for r in rows) > 0.95 * len(rows)
    found = quality.score(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert quality.score(empty, model).collect() == []
    assert quality.train(docs, labels.limit(0)).score(None) is not None
    one = quality.train(docs, labels.where("quality = 1"))
    assert one.rules == () and one.intercept > 0


def test_rules_of_trees():
    text = "Tree 0\n    If (feature 0 <= 5.0)\n     If (feature 0 <= 2.0)\n      Predict: 1\n     Else (feature 0 > 2.0)\n      Predict: 0\n    Else (feature 0 > 5.0)\n     Predict: 0\n"
    name = quality.STATISTICS[0]
    assert quality.tree_rules(text) == [((name, "<=", 5.0),), ((name, "<=", 2.0),), ((name, "<=", 5.0), (name, ">", 2.0)), ((name, ">", 5.0),)]


def test_host_rules(spark, odd, empty):
    rows = {r.doc_id: r for r in hostrules.judge_documents(odd).collect()}
    assert (rows[0].n_words, rows[0].kept) == (0, False) and rows[11].n_dup_lines == 39 and rows[11].n_repeat_words == 120
    assert len(hostrules.judge_documents(odd).collect()) == odd.count() and hostrules.judge_documents(empty).collect() == []
    good = " ".join(f"w{i}" for i in range(60))
    docs = [(i, good if i % 10 == 0 else "bad", "bad.host") for i in range(100)] + [(100 + i, good, "good.host") for i in range(100)]
    docs += [(300, good, None)]
    kept = {r.doc_id for r in hostrules.judge_documents(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).where("kept").collect()}
    assert kept == {*range(100, 200), 300}


def test_mined_rules_equal_enumerated_sets(spark):
    from itertools import combinations

    rnd = random.Random(8)
    rows = []
    for _ in range(900):
        tokens = rnd.sample("abcdefg", rnd.randint(1, 4))
        bad = ("a" in tokens and "b" in tokens) or ("c" in tokens and rnd.random() < 0.7) or rnd.random() < 0.1
        rows.append((tokens, bad))
    rows += [(["rare"], True)] * 19
    got = {tuple(r.antecedent): (round(r.confidence, 9), r.key) for r in urlfilter.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()}
    count, hits = Counter(), Counter()
    for tokens, bad in rows:
        for k in range(1, 5):
            for some in combinations(sorted(tokens), k):
                count[some] += 1
                hits[some] += bad
    base = sum(b for _, b in rows) / len(rows)
    fits = {s: hits[s] / n for s, n in count.items() if hits[s] >= 20 and hits[s] >= 0.002 * len(rows) and hits[s] / n >= max(0.5, 1.5 * base)}
    want = {s: c for s, c in fits.items() if not any(fits.get(tuple(x for x in s if x != t), -1) >= c for t in s)}
    assert {s: c for s, (c, _) in got.items()} == {s: round(c, 9) for s, c in want.items()} and ("a", "b") in got and ("rare",) not in got
    assert all(count[k,] == min(count[t,] for t in s) for s, (_, k) in got.items())


def test_url_filter(spark):
    urls = ["http://a.net/x", "http://EXAMPLE.net/en/1", "http://b.example.com/de/2?q=1", "https://x.org/fr/", "net/", None, "http://net", "", "a://b://c.net/#x", "http://spam.com/ads/7"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)] + [(3, urls[3], "k")], "page_id bigint, url string, key string")
    labelled = spark.createDataFrame([(f"http://s{i % 3}.com/ads/{i}", True) for i in range(30)] + [(f"http://s{i % 3}.com/ok/{i}", False) for i in range(60)], "url string, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(pages, labelled).collect()}
    assert got == {
        0: ("a.net", "/x", "net/", "block"), 1: ("example.net", "/en/1", "example.net/en/", "allow"),
        2: ("b.example.com", "/de/2", "example.com/de/", "block"), 3: ("x.org", "/fr/", "org/fr/", "allow"), 4: ("", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("net", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("b:", "//c.net/", None, "allow"),
        9: ("spam.com", "/ads/7", None, "block"),
    }
    assert urlfilter.judge_urls(pages, labelled).count() == len(urls) + 1
    assert {r.verdict for r in urlfilter.judge_urls(pages, labelled.limit(0)).where("rule IS NULL").collect()} == {"allow"}
    assert urlfilter.judge_urls(pages.limit(0), labelled).collect() == []


def test_language_scores_equal_plain_compression(spark):
    """Prediction and score from the plain sizes of whole texts, block by block."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held")).collect()
    learned = language.train(docs, ~held_out(F.col("doc_id")))
    used = [r for r in rows if not r.held and r.text is not None and r.lang is not None]
    assert sorted(learned) == sorted({r.lang for r in used})
    got = {r.doc_id: r for r in language.identify(docs, learned).collect()}
    kind = zstandard.DICT_TYPE_RAWCONTENT
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0)
            continue
        raw, sizes = r.text.lower().encode(), {}
        for lang, data in learned.items():
            press = zstandard.ZstdCompressor(
                level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            sizes[lang] = sum(len(press.compress(raw[k : k + language.BLOCK_BYTES])) for k in range(0, len(raw), language.BLOCK_BYTES))
        best = min(sorted(sizes), key=sizes.get)
        odds = sum(math.exp(-100 * (n / sizes[best] - 1) / language.LEAD_PERCENT) for n in sizes.values())
        assert got[r.doc_id].lang_pred == best and got[r.doc_id].score == pytest.approx(1 / odds)


def test_language_sample_is_the_first_by_hash(spark, monkeypatch):
    """More ids than the bound in every part of a language: ranking in parts draws the same ids as one ranking."""
    docs = spark.range(0, 9_000, 1, 7).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.when(F.col("id") % 9 == 0, "de").otherwise("en").alias("lang"))
    taken = []
    monkeypatch.setattr(language, "_join", lambda texts: taken.append(sorted(texts)) or b"")
    language.train(docs)
    ranked = docs.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    want = [sorted([r.text.encode() for r in ranked if r.lang == lang][: language.SAMPLE_DOCUMENTS]) for lang in ("de", "en")]
    assert taken == want and len(want[0]) == len(want[1]) == language.SAMPLE_DOCUMENTS


def test_quality_scores_follow_from_the_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), ~held_out(F.col("doc_id")))
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        stats = dict(zip(quality.STATISTICS, quality.statistics((r.text or "").encode()), strict=True))
        held = [w for rule, w in model.rules if all(stats[n] <= b if side == "<=" else stats[n] > b for n, side, b in rule)]
        score = 1 / (1 + math.exp(-(model.intercept + sum(held))))
        assert got[r.doc_id].score == pytest.approx(score) and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.7)
