"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over host and path (or over the whole URL) and names the tokens,
runs of lower-case ASCII letters and digits, that any URL it fits must hold. Token frequencies
are counted over the URLs at hand; each rule stands in the index under its rarest token only.
The tokens of a URL fetch candidate rules by a join, and only their expressions are run. Of the
rules that fit, the longest wins.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a Java regular expression on host and path, or on the lower-case URL."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    target: str = "place"


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""
    pattern = r"(?s)^([^/]*\.)?" + re.sub(r"([^A-Za-z0-9/])", r"\\\1", host + path)
    # A path may go on behind the rule's last letter, so only tokens that end there are sure.
    closed = host + path if re.search("[^A-Za-z0-9]$", path) else host + path.rstrip(_UPPER + _LOWER + "0123456789")
    return Rule(host + path, verdict, pattern, tuple(dict.fromkeys(re.findall("[a-z0-9]+", closed.translate(str.maketrans(_UPPER, _LOWER))))))


def word_rule(verdict: str, word: str) -> Rule:
    """Fits URLs that hold ``word`` as a token of its own."""
    return Rule(f"*{word}*", verdict, f"(?s)(^|[^a-z0-9]){word}([^a-z0-9]|$)", (word,), "url")


#: Fixed values of the query: rules by host and path.
RULES = (
    host_rule("allow", "com", "/"),
    host_rule("block", "example.com", "/en/"),
    host_rule("allow", "www.example.com", "/en/"),
    host_rule("block", "net", "/es/"),
    host_rule("block", "net", "/fr/"),
)
#: The method's own rules for URLs that no rule fits: unwanted topics by word.
TOPICS = tuple(word_rule("block", w) for w in ("adult", "bet", "casino", "gambling", "poker", "porn", "sex", "xxx"))


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def place_of(url: Column) -> tuple[Column, Column]:
    """Host (ASCII in lower case) and path, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def _tokens(c: Column) -> Column:
    return F.array_distinct(F.split(_lower(c), "[^a-z0-9]+"))


def rule_index(spark: SparkSession, rules: Sequence[Rule], urls: DataFrame) -> DataFrame:
    """``rules`` with the token that fetches them; one without tokens is fetched by every URL.

    ``urls`` has an array column ``tokens``. Ties go to the token that is first in the alphabet.
    """
    schema = "rule_no int, rule string, verdict string, pattern string, target string, token string"
    rows = [(i, r.name, r.verdict, r.pattern, r.target, t) for i, r in enumerate(rules) for t in r.tokens or ("",)]
    listed = spark.createDataFrame(rows, schema)
    counts = urls.select(F.explode("tokens").alias("token")).join(F.broadcast(listed.select("token").distinct()), "token")
    counts = counts.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token").alias("token"))
    best = listed.join(counts, "token", "left").groupBy("rule_no").agg(F.min(rarity)["token"].alias("token"))
    return listed.join(best, ["rule_no", "token"])


def judge(
    pages: DataFrame, rules: Sequence[Rule], own: Sequence[Rule] = (), default: str = "allow", id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    ``rule`` names the longest of ``rules`` that fits, else it is NULL and the verdict is that
    of the longest of ``own`` that fits, else ``default``. NULL urls fit nothing. The rules are
    a list that the driver holds, so their index may be broadcast.
    """
    host, path = place_of(F.col(url))
    rows = pages.select(
        F.monotonically_increasing_id().alias("number"), F.col(id).alias("page_id"), host.alias("host"), path.alias("path"),
        _lower(F.coalesce(F.col(url), F.lit(""))).alias("url"),
    )
    # The empty token stands for rules without literals; split() may add one, too.
    rows = rows.withColumn("tokens", F.array_union(_tokens(F.concat_ws("/", "host", "path", "url")), F.array(F.lit(""))))
    index = rule_index(pages.sparkSession, [*rules, *own], rows).withColumn("given", F.col("rule_no") < len(rules))
    target = F.when(F.col("target") == "url", F.col("url")).otherwise(F.concat("host", "path"))
    fits = rows.withColumn("token", F.explode("tokens")).join(F.broadcast(index), "token", "left")
    fits = fits.withColumn("fits", F.coalesce(F.regexp_like(target, F.col("pattern")), F.lit(False)))
    rank = F.struct("given", F.length("rule").alias("size"), F.col("rule_no").alias("no"), "rule", F.col("verdict").alias("verdict"))
    found = fits.groupBy("number", "page_id", "host", "path").agg(F.max(F.when(F.col("fits"), rank)).alias("best"))
    return found.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.given"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
