"""Cleaning of names, phones, titles, teams and lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in text fields.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# Fixed value: the marker some accounts put before a name.
NUMBERED_PREFIX = r"^0[0-9]+ - "


def strip(c: Column) -> Column:
    """Trim white space of any kind, not only blanks; null becomes ''."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITESPACE))


def null_if_blank(c: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def truthy(c: Column) -> Column:
    """True when the text is there and not empty (white space counts as text)."""
    return F.coalesce(c, F.lit("")) != ""


def fmt_phone(p: Column) -> Column:
    digits = F.regexp_replace(p, "[^0-9]", "")
    local = F.when(
        (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)
    ).otherwise(digits)
    pretty = F.format_string(
        "(%s) %s-%s", F.substring(local, 1, 3), F.substring(local, 4, 3), F.substring(local, 7, 4)
    )
    return F.when(F.length(local) == 10, pretty).otherwise(F.coalesce(p, F.lit("")))


def clean_title(t: Column, default: str, generic: Iterable[str], suffix: str) -> Column:
    t = F.coalesce(t, F.lit(""))
    kept = strip(F.replace(t, F.lit(suffix), F.lit("")))
    return F.when(F.upper(t).isin(*generic) | (t == "") | (kept == ""), F.lit(default)).otherwise(kept)


def infer_region(office: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Region of the first keyword, in list order, that the office text contains."""
    low = F.lower(office)
    hits = [F.when(low.contains(word), F.lit(region)) for word, region in pairs]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def name_key(n: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(n, F.lit(""))), "[^a-z]", "")


def slugify(n: Column) -> Column:
    bare = F.translate(strip(F.lower(n)), "'’", "")
    return F.btrim(F.regexp_replace(bare, "[^a-z0-9]+", "-"), F.lit("-"))


def _unmarked(trimmed: Column) -> Column:
    """Trimmed text without its marker; the pattern is tried only where it can hit."""
    return F.when(trimmed.startswith("0"), strip(F.regexp_replace(trimmed, NUMBERED_PREFIX, ""))).otherwise(trimmed)


def strip_prefix(n: Column) -> Column:
    """Drop a leading ``0NN - `` marker, then trim."""
    return _unmarked(strip(n))


def joined_name(first: Column, last: Column, preferred: Column, full: Column) -> Column:
    """Name from parts that are already trimmed and without markers."""
    none = F.lit("")
    given = F.coalesce(F.nullif(preferred, none), F.nullif(first, none))
    joined = F.concat_ws(" ", given, F.nullif(last, none))
    return F.nullif(_unmarked(F.coalesce(F.nullif(joined, none), full)), none)


def display_name(first: Column, last: Column, preferred: Column, full: Column) -> Column:
    """Preferred (else legal) first name and last name; the full name if both are blank."""
    return joined_name(strip_prefix(first), strip_prefix(last), strip_prefix(preferred), strip(full))


def first_nonblank(*cs: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))


def split_list(c: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip)
    return F.filter(parts, lambda x: x != "")


def in_list_ci(c: Column, values: Iterable[str]) -> Column:
    wanted = sorted({v.strip().lower() for v in values})
    return F.lower(strip(c)).isin(*wanted) if wanted else F.lit(False)


def event_line(mark: str, name: Column, email: Column, *more: Column) -> Column:
    """One digest line: mark, name, address, then any further parts."""
    head = F.format_string(f"  {mark} %s <%s>", name, email)
    return F.concat_ws(" · ", head, *more) if more else head
