"""URLs, keys and page text."""

from __future__ import annotations

import html
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import null_if_blank, strip


def url_hash(u: Column) -> Column:
    """The SHA-256 of the URL; blank stays blank."""
    u = F.coalesce(u, F.lit(""))
    return F.when(u == "", F.lit("")).otherwise(F.sha2(u, 256))


def entity_key(id_: Column, email: Column) -> Column:
    """Trimmed id, else a key made from the e-mail, else null."""
    mail = null_if_blank(F.lower(email))
    return F.coalesce(null_if_blank(id_), F.concat(F.lit("email-"), F.sha2(mail, 256)))


def valid_url(u: Column) -> Column:
    return F.when(u.rlike("^https?://"), u).otherwise(F.lit(""))


def is_self_hosted(u: Column, marks: Iterable[str]) -> Column:
    u = F.coalesce(u, F.lit(""))
    cond = u != ""
    for mark in marks:
        cond = cond & u.contains(mark)
    return cond


def is_trusted(u: Column, hosts: Iterable[str]) -> Column:
    u = F.coalesce(u, F.lit(""))
    cond = F.lit(False)
    for host in hosts:
        cond = cond | u.contains(host)
    return cond


def host_class(u: Column, marks: Iterable[str], hosts: Iterable[str]) -> Column:
    u = strip(u)
    return (
        F.when(u == "", "blank")
        .when(is_self_hosted(u, marks), "self_hosted")
        .when(is_trusted(u, hosts), "trusted")
        .otherwise("unknown")
    )


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def html_text(c: Column) -> Column:
    """Text with HTML entities decoded.

    The entity table is far too large for a native expression, so this is the
    one Python function of the library.  Text without '&' is passed around it.
    """
    return F.coalesce(_unescape(F.when(c.contains("&"), c)), c)
