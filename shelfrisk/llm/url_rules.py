"""URL filtering by pattern rules found through their rarest token (operator 4), in DataFrame functions only.

A rule is a regular expression over ``host/path`` with the literal tokens that every match must contain. Each rule
is indexed under the one of its tokens that the fewest urls hold; a url's tokens fetch candidate rules from that
index, and only those rules' expressions are run. Of the rules that fit, site rules (host and path) go before
word rules, then the longest wins, ties go to block and then to the larger text. A url that no rule fits is allowed.

Every distinct url is judged once; verdicts go back to the pages by their url.

Defined results: null urls and those without ``://`` have an empty host and path, fit no rule and are allowed;
a null page_id is passed on; repeated rows each get their row; without rules all is allowed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to which the index is broadcast; longer rule lists are joined by a shuffle.
BROADCAST_RULES = 100_000

#: Site rules: (rule, verdict); a rule fits its host and all subdomains, and paths that start with its path.
SITES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: Word rules: host labels of words, joined by hyphens, that stand for unwanted sites.
WORDS = ["adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm", "ads-track"]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[0-9a-z]+"), 0)


def site_rule(rule: str, verdict: str) -> tuple[str, str, str, int, list[str]]:
    host, _, path = rule.partition("/")
    pattern = rf"^([^/]*\.)?{re.escape(host)}/{re.escape(path)}"
    # the path's last token may go on in the url, unless a sign ends it
    known = re.findall("[0-9a-z]+", host) + re.findall("[0-9a-z]+(?=[^0-9a-z])", path.lower())
    return rule, verdict, pattern, 1, known


def word_rule(word: str) -> tuple[str, str, str, int, list[str]]:
    return word, "block", rf"^([^/]*\.)?{re.escape(word)}(\.[^/]*)?(/|$)", 0, re.findall("[0-9a-z]+", word)


def rules(spark: SparkSession, sites: list[tuple[str, str]] = SITES, words: list[str] = WORDS) -> DataFrame:
    """(rule, verdict, pattern, site, tokens)."""
    rows = [site_rule(*s) for s in sites] + [word_rule(w) for w in words]
    return spark.createDataFrame(rows, "rule string, verdict string, pattern string, site int, tokens array<string>")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    after = F.when(F.instr(url, "://") > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "#", 1)).otherwise("")
    after = F.coalesce(F.substring_index(after, "?", 1), F.lit(""))
    host = F.translate(F.substring_index(after, "/", 1), UPPER, LOWER)
    return host, F.substring(after, F.length(F.substring_index(after, "/", 1)) + 1, F.length(after))


def filter_urls(pages: DataFrame, rule_list: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("_url"))
    host, path = split_url(F.col("_url"))
    urls = (rows.filter("_url IS NOT NULL").groupBy("_url").agg(F.count(F.lit(1)).alias("_pages"))
            .select("_url", "_pages", F.concat(host, path).alias("_at")))
    words = urls.select("_url", "_pages", "_at", F.explode(F.array_distinct(tokens(F.col("_at")))).alias("_token"))
    listed = rule_list.select("rule", "verdict", "pattern", "site", F.explode("tokens").alias("_token"))
    found = words.join(_bounded(listed.select("_token").distinct(), rule_list), "_token").groupBy("_token").agg(F.sum("_pages").alias("_n"))
    rarest = (listed.join(found, "_token", "left").groupBy("rule", "verdict", "pattern", "site")
              .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_token").alias("token"))).alias("_least")))
    index = rarest.select("rule", "verdict", "pattern", "site", F.col("_least.token").alias("_token"))
    fits = words.join(_bounded(index, rule_list), "_token").filter(F.expr("regexp_like(_at, pattern)"))
    order = F.struct("site", F.length("rule"), F.col("verdict") == "block", "rule")
    best = fits.groupBy("_url").agg(F.max_by(F.struct("rule", "verdict"), order).alias("_best"))
    back = rows.join(best, "_url", "left")
    host, path = split_url(F.col("_url"))
    is_site = F.col("_best.rule").contains("/")
    return back.select("page_id", host.alias("host"), path.alias("path"), F.when(is_site, F.col("_best.rule")).alias("rule"),
                       F.coalesce("_best.verdict", F.lit("allow")).alias("verdict"))


def _bounded(df: DataFrame, rule_list: DataFrame) -> DataFrame:
    return F.broadcast(df) if rule_list.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else df


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rules(spark))


OP4_SQL = r"""
WITH u AS (
    SELECT CAST(page_id AS BIGINT) AS page_id, CASE WHEN instr(url, '://') > 0
               THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS pos FROM pages
), p AS (
    SELECT page_id, coalesce(translate(regexp_extract(pos, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(substr(pos, length(regexp_extract(pos, '^[^/]*', 0)) + 1), '') AS path FROM u
), r AS (
    SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                   WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                   WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                   WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches('.' || host || '.', '[.](adult-x|casino-win|cheap-pills|free-bets|spam-farm|ads-track)[.]') THEN 'block'
            ELSE 'allow' END AS verdict
FROM r
"""
