"""URL rules by host suffix and path prefix.

Each URL is expanded into the expressions ``host suffix + path prefix`` under which a rule could stand. The
expressions meet the rules in an equi-join on the first hex digits of their SHA-256; the full digests are compared
afterwards, and the longest rule that is left decides.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.llm.base import repeated

PREFIX_DIGITS = 8
#: Rules up to this number (some 200 bytes each) are sent to every executor; more of them take a shuffle join.
BROADCAST_RULES = 100_000
RULE_SALTS = 16
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_table(rules: DataFrame) -> DataFrame:
    """``rules`` (host, path, verdict) -> rule, verdict, digest, prefix. Null parts are empty; of rules with one
    expression and different verdicts, ``block`` stands."""
    rule = F.concat(F.coalesce("host", F.lit("")), F.coalesce("path", F.lit("")))
    one = rules.select(rule.alias("_rule"), (F.col("verdict") == "block").alias("_block")).groupBy("_rule").agg(
        F.max(F.coalesce("_block", F.lit(False))).alias("_block"))
    digest = F.sha2("_rule", 256)
    return one.select("_rule", F.when(F.col("_block"), "block").otherwise("allow").alias("_verdict"),
                      digest.alias("_digest"), F.substring(digest, 1, PREFIX_DIGITS).alias("_prefix"))


def _expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    prefixes = F.transform(F.filter(known, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(
        F.concat(s, p).alias("text"), F.length(s).alias("host_length")))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url",
          broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule (``host/path`` text or null), verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest rule wins, of equally
    long ones that with the longer host. URLs without a fitting rule get ``default``. Null URLs, and URLs without
    ``://``, have an empty host and path; rows that repeat are returned as often as they come; null keys stay; an
    empty table gives none. Other columns of ``pages`` are not read, whatever their names.

    Rows are folded by (key, url) first. All expressions of a row stay in its partition, so that only the folded
    rows are shuffled. Path prefixes are cut at the lengths that occur among the rules.
    """
    table = rule_table(rules)
    found = rules.agg(F.collect_set(F.length(F.coalesce("path", F.lit("")))).alias("lengths")).first()
    lengths = sorted(found["lengths"])
    few = table.limit(broadcast_rules + 1).count() <= broadcast_rules
    rows = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"))
    folded = rows.groupBy("_key", "_url").agg(F.count(F.lit(1)).alias("_copies"))
    parts = folded.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    spread = parts.withColumn("_e", F.explode_outer(_expressions(F.col("_host"), F.col("_path"), lengths)))
    hashed = spread.withColumn("_full", F.sha2(F.col("_e.text"), 256)).withColumn(
        "_short", F.substring("_full", 1, PREFIX_DIGITS))
    if few:
        joined = hashed.join(F.broadcast(table), F.col("_short") == F.col("_prefix"), "left")
    else:
        salted = table.withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.lit(RULE_SALTS - 1))))
        salt = F.pmod(F.xxhash64("_key", "_url"), F.lit(RULE_SALTS)).cast("int")
        joined = hashed.withColumn("_salt", salt).join(
            salted, (F.col("_short") == F.col("_prefix")) & (F.col("_salt") == F.col("_r_salt")), "left")
    confirmed = F.when(F.col("_digest") == F.col("_full"), F.struct(
        F.length("_rule").alias("length"), F.col("_e.host_length").alias("host_length"), F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict")))
    best = joined.groupBy("_key", "_url").agg(
        F.max(confirmed).alias("_best"), F.first("_host").alias("_host"), F.first("_path").alias("_path"),
        F.first("_copies").alias("_copies"))
    return repeated(best.select(
        F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"), "_copies"), "_copies")
