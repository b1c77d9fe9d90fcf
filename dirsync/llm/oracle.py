"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import importance, variants
from .hostrules import MAX_DUP_LINE_PERCENT, MAX_HOST_RATE, MAX_REPEAT_PERCENT, MAX_SYMBOL_PERCENT, MIN_WORDS
from .repeats import MATCH

_OP2 = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i AS s, substr(h, 2 * i + 1, 2 * {MATCH}) AS g
  FROM (SELECT doc_id, h, unnest(range(0, n - {MATCH} + 1)) AS i FROM d WHERE n >= {MATCH})
), m AS (
  SELECT doc_id, s, min(doc_id) OVER (PARTITION BY g) AS first_doc FROM w
), r AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM m WHERE first_doc < doc_id
), i AS (
  SELECT doc_id, s, sum(CASE WHEN p IS NULL OR s > p + {MATCH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM r
), x AS (
  SELECT doc_id, k, min(s) AS a, max(s) + {MATCH} AS b FROM i GROUP BY doc_id, k
), y AS (
  SELECT x.doc_id, x.a, x.b, coalesce(lag(x.b) OVER o, 0) AS before, lead(x.a) OVER o IS NULL AS is_last, d.h, d.n
  FROM x JOIN d USING (doc_id) WINDOW o AS (PARTITION BY x.doc_id ORDER BY x.a)
), k AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT)
      || CASE WHEN is_last THEN substr(h, (2 * b + 1)::BIGINT) ELSE '' END, '' ORDER BY a) AS kept
  FROM y GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_WORD = r"[^\x20\x09-\x0D]+"
_OP4 = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)
), r AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM g, (VALUES (0), (1), (2)) v(j) WHERE times > 1 GROUP BY doc_id
), c AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c
), f AS (
  SELECT *, base_failed OR 100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars OR 100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS failed FROM b
), h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k FROM f WHERE source IS NOT NULL GROUP BY source
), t AS (
  SELECT sum(k) / sum(n) AS m, sum(k / n * k) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n)) AS v, count(*) / sum(n) AS share FROM h
), p AS (
  SELECT m, least(greatest(CASE WHEN v > m * (1 - m) * share THEN (m * (1 - m) - v) / (v - m * (1 - m) * share) ELSE 10000 END, 1), 10000) AS strength FROM t
), j AS (
  SELECT source, (k + m * strength) / (n + strength) > {MAX_HOST_RATE} AS rejected FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM f LEFT JOIN j USING (source)
"""

#: CRC-32 of the bytes given as hex digits, by its bits: a table of 256 numbers, then a byte at a time.
_CRC_TABLE = """t AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
)"""


def _crc32(hex_digits: str) -> str:
    byte = f"('0x' || substr({hex_digits}, 2 * i + 1, 2))::BIGINT"
    steps = f"list_prepend(4294967295, list_transform(range(length({hex_digits}) // 2), lambda i: {byte}))"
    return f"xor(list_reduce({steps}, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"


def _bucket_counts(table: str) -> str:
    words = f"SELECT unnest(regexp_extract_all({_LOWERED}, '{_FEATURE}')) AS word FROM {table}"
    return f"SELECT word, count(*) AS n FROM ({words}) GROUP BY word"


_FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_B = importance.BUCKETS
_OP12 = f"""
WITH {_CRC_TABLE}, a AS ({_bucket_counts("documents")}), b AS ({_bucket_counts("benchmark")}), w AS (
  SELECT word, {_crc32("h")} % {_B} AS bucket FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM a UNION SELECT word FROM b)), t
), s AS (
  SELECT bucket, sum(n)::DOUBLE AS n FROM a JOIN w USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, sum(n)::DOUBLE AS n FROM b JOIN w USING (word) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(g.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + {_B})
    / ((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM g) + {_B}))))::BIGINT AS gain
  FROM s LEFT JOIN g USING (bucket)
), f AS (
  SELECT doc_id, sum(gain)::BIGINT AS weight, count(*) AS n_features
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '{_FEATURE}')) AS word FROM documents) JOIN w USING (word) JOIN gain USING (bucket)
  GROUP BY doc_id
), h AS (
  SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN f USING (doc_id)
), z AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM h
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM z WHERE n_features >= {importance.MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {importance.PERCENT} * n // 100 THEN rank END AS rank
FROM z LEFT JOIN r USING (doc_id)
"""

_OP13 = f"""
WITH RECURSIVE {_CRC_TABLE}, o AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY doc_id, run
), c AS (
  SELECT run, n, {_crc32("x")} AS h FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM o), t
), a AS (
  SELECT CASE WHEN h % {variants.ONE_IN} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM c
), w AS (
  SELECT word, sum(n)::BIGINT AS n FROM a WHERE length(word) >= {variants.MIN_LETTERS} GROUP BY word HAVING sum(n) >= {variants.MIN_COUNT}
), d AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), p AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM d x JOIN d y ON x.less = y.less AND x.i = y.i AND x.word <> y.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.less = w.word
  UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.less = w.word
), b AS (
  SELECT word, count(*) AS n_near, min({{'n': -near_n, 'form': near}}) AS best FROM p GROUP BY word
), f AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN -best.n >= {variants.FACTOR} * n THEN best.form END AS form, CASE WHEN -best.n >= {variants.FACTOR} * n THEN -best.n END AS form_n
  FROM w LEFT JOIN b USING (word)
), r AS (
  SELECT word, word AS root, form AS further FROM f
  UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON r.further = f.word
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON f.word = r.word AND r.further IS NULL
"""

ORACLES: dict[str, str] = {"op2_suffix_dedup": _OP2, "op4_host_rules": _OP4, "op12_importance": _OP12, "op13_spelling": _OP13}
