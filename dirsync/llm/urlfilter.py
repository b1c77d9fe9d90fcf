"""Judge urls by given rules, and by token combinations mined from labels.

FP-growth finds the combinations of url tokens that go along with the bad label.
Rules below the least support, number of rows, confidence or lift are dropped, and so is a rule that a
shorter one with no less confidence makes needless.  The rest is an inverted
index: each rule stands under the rarest token of its left side, a url looks up
its tokens, and a rule that is found is compared in full.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirsync.operators.lookups import lookup
from dirsync.session import materialise

#: Of a rule: share and number of the labelled urls that it fits and that are bad, share of the fitting ones that are bad, and
#: how many times the share of bad urls among all that is.
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE, MIN_LIFT = 0.002, 20, 0.5, 1.5
#: (verdict, host, path); the longest that fits wins.
GIVEN_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BAD = "=bad"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for urls without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(rest: Column) -> Column:
    """A-Z is lower-cased, other letters are left."""
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules=GIVEN_RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits; null where none does.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def tokens(rest: Column) -> Column:
    """Distinct tokens of a url: labels of the host, parts of the path but numbers, names in the query."""
    mark = lambda kind, parts: F.transform(parts, lambda x: F.concat(F.lit(kind), x))
    host = F.split(host_of(rest), r"\.")
    path = F.filter(F.split(path_of(rest), "/"), lambda x: ~x.rlike(r"^\d+(\.\w+)?$"))
    query = F.regexp_extract_all(F.regexp_extract(rest, r"\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]+)"), 1)
    found = F.concat(mark("host:", host), mark("path:", path), mark("query:", query))
    return F.array_distinct(F.filter(found, lambda x: ~x.endswith(":")))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """antecedent, confidence, support, key (its rarest token), from rows (tokens, bad).

    A share alone would make rules of single urls where few are labelled, so a rule
    also needs MIN_ROWS bad urls.
    """
    items = F.when(F.col("bad"), F.array_append("tokens", BAD)).otherwise(F.col("tokens"))
    rows = materialise(labelled.where(F.size("tokens") > 0).select(items.alias("items")), "url-items")
    support = min(1.0, max(min_support, MIN_ROWS / max(rows.count(), 1)))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(rows)
    is_rule = F.array_contains("consequent", BAD) & (F.size("antecedent") > 0)
    rules = model.associationRules.where(is_rule & (F.col("lift") >= MIN_LIFT) & (F.round(F.col("support") * rows.count()) >= MIN_ROWS))
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    rules = materialise(rules, "url-rules")
    shorter = rules.select(F.col("antecedent").alias("less"), F.col("confidence").alias("of_less"))
    parts = rules.select("antecedent", "confidence", F.explode("antecedent").alias("without"))
    parts = parts.select("antecedent", "confidence", F.array_remove("antecedent", F.col("without")).alias("less"))
    needless = parts.join(shorter, "less").where("of_less >= confidence").select("antecedent").distinct()
    rules = rules.join(needless, "antecedent", "left_anti")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("key"), "freq")
    keyed = rules.select("*", F.explode("antecedent").alias("key")).join(single, "key")
    return keyed.groupBy("antecedent", "confidence", "support").agg(F.min_by("key", F.struct("freq", "key")).alias("key"))


def bad_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, confidence, of the distinct urls (url, tokens) that a mined rule fits.

    The join on the token goes to Spark's size estimates: the rules are a written
    table, broadcast if small, and else joined by an exchange that can be split.
    """
    looked = urls.select("url", "tokens", F.explode("tokens").alias("key"))
    found = looked.join(rules.select("key", "antecedent", "confidence"), "key")
    found = found.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return found.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labelled: DataFrame, given=GIVEN_RULES, id_col="page_id", url_col="url") -> DataFrame:
    """page_id, host, path, rule, verdict, confidence: one row per row of ``pages``.

    ``labelled`` has (url, bad).  Where no given rule fits, a url is blocked if a
    mined rule fits it, and allowed else.  Null urls and urls without ``://`` have
    empty host and path, no tokens, and are allowed.  Equal urls are looked up
    once and repeated rows are judged each; empty tables give no rows, and without
    labelled rows nothing is mined.  Other columns are not read.
    """
    with_tokens = lambda d: d.select("url", tokens(after_scheme(F.col("url"))).alias("tokens"), *[c for c in d.columns if c == "bad"])
    rules = materialise(mine_rules(with_tokens(labelled.select("url", "bad"))), "url-rules")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    hits = bad_urls(with_tokens(rows.select("url").where(F.col("url").isNotNull()).distinct()), rules)
    rest = after_scheme(F.col("url"))
    judged = lookup(rows, hits, F.col("url"), "url", pos="page_id").select("page_id", host_of(rest).alias("host"), path_of(rest).alias("path"), "confidence")
    rule, verdict = given_rule(F.col("host"), F.col("path"), given)
    mined = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "confidence")
