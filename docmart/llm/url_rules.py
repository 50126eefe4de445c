"""URL filter rules, found by their rarest literal token.

A host rule (host, path) fits its host and all subdomains when the url's path
starts with the rule's.  A pattern rule is a regular expression on the
lower-cased url.  Each rule names the literal tokens ([a-z0-9]+) that any url
it fits must hold; it is indexed by the one that the fewest urls hold, counted
over all urls.  The tokens of a url fetch candidate rules from that index, and
only those are tested.  The longest fitting host rule decides; without one, a
fitting pattern blocks; else the url is allowed.  Rules without any literal
token are tested on every url.

Null urls, and urls without "://", have an empty host and path, and no rule
fits them but patterns.  Repeated rows get the same verdict; an empty table
gives none.  Only DataFrame functions are used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_az, stored

BROADCAST_RULES = 100_000     # beyond, the index is joined by shuffle


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    host: str | None = None
    path: str | None = None
    pattern: str | None = None
    tokens: tuple[str, ...] = ()


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Its literal tokens: the host's labels, and path tokens that the rule itself ends."""
    low = path.translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})       # as the urls are before they are cut
    held = re.findall(r"[a-z0-9]+", host) + re.findall(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", low)
    return Rule(host + path, verdict, host=host, path=path, tokens=tuple(held) if host.isascii() else ())


def word_rule(name: str, *tokens: str) -> Rule:
    """Blocks urls that hold the tokens next to each other."""
    body = "[^a-z0-9]+".join(tokens)
    return Rule(name, "block", pattern=f"(^|[^a-z0-9]){body}([^a-z0-9]|$)", tokens=tokens)


# Fixed values of the contract.
HOST_RULES = (host_rule("block", "net", "/"), host_rule("allow", "example.net", "/en/"),
              host_rule("block", "example.com", "/de/"), host_rule("allow", "org", "/fr/"))
PATTERN_RULES = (
    word_rule("spam", "spam"), word_rule("casino", "casino"), word_rule("betting", "bet", "online"),
    word_rule("adult", "xxx"), word_rule("porn", "porn"), word_rule("pills", "viagra"),
    word_rule("ads", "ads"), word_rule("tracker", "track", "click"), word_rule("login", "wp", "login"),
    word_rule("torrent", "torrent"), word_rule("warez", "warez"),
)


def split_url(df: DataFrame) -> DataFrame:
    """Adds host and path."""
    at = F.locate("://", "url")
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (df.withColumn("host", lower_az(F.regexp_extract(rest, r"^([^/?#]*)", 1)))
            .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """(page_id, url, host, path, rule, pattern, verdict) of every row of ``pages``."""
    spark = pages.sparkSession
    table = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.host).cast("string").alias("rule_host"),
        F.lit(r.path).cast("string").alias("rule_path"), F.lit(r.pattern).cast("string").alias("regex"),
        F.array(*[F.lit(t) for t in sorted(set(r.tokens))]).cast("array<string>").alias("tokens")) for r in rules])))
    few = len(rules) <= BROADCAST_RULES
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)

    urls = split_url(pages.select("url").where("url is not null").distinct()).withColumn("lowered", lower_az(F.col("url")))
    urls = stored(urls, "urls")
    held = urls.select("url", F.explode(F.array_distinct(F.split("lowered", "[^a-z0-9]+"))).alias("token"))
    literals = table.select("name", F.explode("tokens").alias("token"))
    counts = held.join(small(literals.select("token").distinct()), "token", "left_semi") \
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (literals.join(counts, "token", "left")
              .groupBy("name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("r"))
              .select("name", F.col("r.token").alias("token")))
    index = stored(table.join(rarest, "name").drop("tokens"), "rule_index")
    found = held.join(small(index), "token").join(urls, "url") if not few else \
        urls.withColumn("token", F.explode(F.array_distinct(F.split("lowered", "[^a-z0-9]+")))).join(small(index), "token")
    free = [r for r in rules if not r.tokens]
    if free:
        always = table.where(F.size("tokens") == 0).drop("tokens")
        every = always.agg(F.collect_list(F.struct("name", "verdict", "rule_host", "rule_path", "regex")).alias("all"))
        one = every.first()["all"]      # the given rules themselves, at most len(rules)
        found = found.drop("token").unionByName(urls.withColumn("r", F.explode(F.array(*[F.struct(
            *[F.lit(x[c]).cast("string").alias(c) for c in ("name", "verdict", "rule_host", "rule_path", "regex")])
            for x in one]))).select("*", "r.*").drop("r"))
    host_fits = ((F.col("host") == F.col("rule_host")) | F.expr("endswith(host, concat('.', rule_host))")) \
        & F.expr("startswith(path, rule_path)")
    fits = F.when(F.col("regex").isNull(), host_fits).otherwise(F.expr("lowered rlike regex"))
    best = (found.where(fits).groupBy("url").agg(
        F.max(F.when(F.col("regex").isNull(), F.struct(F.char_length("name").alias("n"), "name", "verdict"))).alias("by_host"),
        F.min(F.when(F.col("regex").isNotNull(), F.col("name"))).alias("pattern")))
    # urls that no rule fits (most) need no partner in the join
    return (split_url(pages.select("page_id", "url")).join(best, "url", "left")
            .select("page_id", "url", "host", "path", F.col("by_host.name").alias("rule"), "pattern",
                    F.coalesce(F.col("by_host.verdict"), F.when(F.col("pattern").isNotNull(), "block"),
                               F.lit("allow")).alias("verdict")))
