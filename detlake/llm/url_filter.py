"""URL filters: pattern rules indexed by their rarest literal token, so only rules that a URL's tokens fetch run their
regular expression. DataFrame functions only.

A pattern is text with `*` for any characters. Its tokens are runs of a-z and 0-9 with other characters of the pattern on both
sides, so a URL that matches holds all of them. Tokens are counted over all URLs, a pattern is filed under its rarest one,
and a pattern without any token is run on every URL. Base rules (host and path) come first: the longest that fits decides;
only other URLs take the patterns' verdict, block if one matches.

Verdicts depend on the URL alone, so they are found once for each distinct URL and joined to the rows. Rules are given as a
list; up to `broadcast_rules` they are broadcast, above it the join shuffles.

Defined cases: null URLs and URLs without `://` have an empty host and path, fit no rule and are allowed; repeated rows get equal
verdicts; null ids are kept; other columns are ignored."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from detlake.llm.columns import lower_ascii

#: (host and path, verdict)
BASE_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: patterns of unwanted hosts and parameters
PATTERNS = ("*/casino-win.*", "*.casino-win.*", "*/free-bets.*", "*.free-bets.*", "*/ads-track.*", "*.ads-track.*", "*/spam-farm.*", "*.spam-farm.*", "*/cheap-pills.*", "*.cheap-pills.*",
            "*/adult.*", "*.adult.*", "*/adult-*", "*-adult.*", "*?sessionid=*", "*&sessionid=*", "*/wp-login.php*", "*.doubleclick.*", "*/track.gif?*")
BROADCAST_RULES = 50_000


def literal_tokens(pattern: str) -> list[str]:
    return re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", pattern)


def regex(pattern: str) -> str:
    return "(?s)^" + ".*".join(re.sub(r"([^a-z0-9])", r"\\\1", part) for part in pattern.split("*")) + "$"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def _lists(table: DataFrame, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A small table of literals, made in the JVM."""
    items = F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names))) for row in rows))
    return table.sparkSession.range(1).select(F.inline(items))


def pattern_matches(urls: DataFrame, patterns: tuple[str, ...], broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """The distinct rows of `urls` (url) that match a pattern."""
    filed = [(p, t) for p in patterns for t in sorted(set(literal_tokens(p)))]
    loose = [p for p in patterns if not literal_tokens(p)]
    small = lower_ascii(F.col("url"))
    tokens = urls.select("url", F.array_distinct(F.regexp_extract_all(small, F.lit("[a-z0-9]+"), F.lit(0))).alias("tokens"))
    found = urls.where(F.lit(False))
    for p in loose:
        found = found.unionByName(urls.where(small.rlike(regex(p))))
    if filed:
        names = _lists(urls, filed, ("pattern", "token"))
        seen = tokens.select(F.explode("tokens").alias("token")).join(F.broadcast(names.select("token").distinct()) if len(filed) <= broadcast_rules else names.select("token").distinct(), "token")
        counts = seen.groupBy("token").agg(F.count("*").alias("n"))
        first = F.row_number().over(W.partitionBy("pattern").orderBy(F.coalesce("n", F.lit(0)), "token"))
        index = names.join(counts, "token", "left").withColumn("r", first).where("r = 1")
        index = index.join(_lists(urls, [(p, regex(p)) for p in dict.fromkeys(p for p, _ in filed)], ("pattern", "regex")), "pattern").select("token", "regex")
        rules = F.broadcast(index) if len(filed) <= broadcast_rules else index
        hits = tokens.select("url", F.explode("tokens").alias("token")).join(rules, "token").where(F.expr("rlike(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), regex)"))
        found = found.unionByName(hits.select("url"))
    return found.distinct()


def judged(pages: DataFrame, base: tuple = BASE_RULES, patterns: tuple[str, ...] = PATTERNS, url: str = "url", id: str = "page_id") -> DataFrame:
    """One row per row of `pages`: (id, host, path, rule, verdict)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url")).withColumn("host", host).withColumn("path", path)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the longest that fits decides; of equal length, the first in order
    for text, word in sorted(base, key=lambda r: (len(r[0]), r[0]), reverse=True)[::-1]:
        name, slash, rest = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    rows = rows.withColumn("rule", rule).withColumn("own", verdict)
    open_urls = rows.where("own IS NULL AND host <> ''").select("url").distinct()
    bad = pattern_matches(open_urls, patterns).withColumn("bad", F.lit("block"))
    return rows.join(bad, "url", "left").select(F.col("id").alias(id), "host", "path", "rule", F.coalesce("own", "bad", F.lit("allow")).alias("verdict"))
