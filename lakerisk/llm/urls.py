"""URL filters: host and path rules, and association rules mined from labelled URLs."""

import json
import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm.text import ascii_lower, whole
from lakerisk.sources.tables import staged

BAD = "label=bad"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, then a path from its first slash on, such as ``example.net/en/``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host_col: Column, path_col: Column, rules: list[Rule]) -> Column:
    """struct<rule, verdict> of the longest pattern that fits, else null."""
    hits = []
    for rule in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern)):
        fits = ((host_col == rule.host) | host_col.endswith(f".{rule.host}")) & path_col.startswith(rule.path)
        hits.append(F.when(fits, F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*hits, none)


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels, words of path and query, with runs of
    digits read as ``#`` so that page numbers do not become tokens of their own."""
    shaped = lambda text, tag: F.transform(
        F.filter(F.split(F.regexp_replace(ascii_lower(text), "[0-9]+", "#"), r"[^a-z#\-\x{80}-\x{10ffff}]+"), lambda t: t != ""),
        lambda t: F.concat(F.lit(tag), t),
    )
    labels = F.filter(F.split(host(url), r"\."), lambda t: t != "")
    return F.array_distinct(
        F.concat(
            shaped(F.regexp_extract(url, r"^([^:/?#]*)://", 1), "s:"),
            F.transform(labels, lambda t: F.concat(F.lit("h:"), t)),
            shaped(path(url), "p:"),
            shaped(F.regexp_extract(url, r"[?#](.*)$", 1), "q:"),
        )
    )


def by_chance(hits: int, n: int, share: float) -> float:
    """Probability of ``hits`` or more among n rows of which each is bad with probability ``share``.
    It is under alpha just where the exact lower confidence bound 1 - alpha lies above ``share``."""
    if not 0 < share < 1:
        return 1.0
    total = 0.0
    for k in range(hits, n + 1):
        log_p = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
        p = math.exp(log_p)
        total += p
        if k > n * share and p < total * 1e-12:
            break
    return min(1.0, total)


def mine(labelled: DataFrame, min_support: float, min_confidence: float, least: int = 5, alpha: float = 0.05) -> list[dict]:
    """Rules [{if, support, confidence}] that say bad, shortest antecedents first.

    ``labelled`` has url and bad (boolean; null rows are left out). A rule needs
    ``least`` bad rows, and its confidence's exact lower bound must lie above the share of
    bad rows at the level ``alpha`` divided by the number of token sets that were tried, so
    that not even one rule is expected by chance, however small or large the table is; ``min_support``
    may ask for a share of the rows besides. A rule that a rule with fewer of its tokens
    makes at least as confidently is pruned. Tokens of every row tell nothing and are left out.
    """
    rows = labelled.filter("bad is not null and url is not null").select("bad", tokens(F.col("url")).alias("items"))
    rows = staged(labelled.sparkSession, rows.filter(F.size("items") > 0), "labelled")
    n, bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    if bad < least:
        return []
    seen = rows.select(F.explode("items").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    common = F.array(*map(F.lit, sorted(r["token"] for r in seen.filter(F.col("n") == n).collect()))).cast("array<string>")
    told = F.concat(F.array_except("items", common), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")))
    support = (max(least, min_support * n) - 0.5) / n  # FP-growth rounds the count up
    model = FPGrowth(itemsCol="items", minSupport=support).fit(rows.select(told.alias("items")))
    sets = staged(labelled.sparkSession, model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    plain = sets.filter(~F.array_contains("items", BAD))
    tried = max(1, plain.count())
    hits = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("items"), F.col("freq").alias("hits"))
    found = plain.join(hits, "items").filter((F.col("hits") >= min_confidence * F.col("freq")) & (F.col("hits") * n > F.col("freq") * bad))
    best: list[dict] = []
    for r in sorted(found.collect(), key=lambda r: (len(r["items"]), r["items"])):
        items, confidence = set(r["items"]), r["hits"] / r["freq"]
        if any(set(k["if"]) <= items and k["confidence"] >= confidence for k in best):
            continue
        if by_chance(r["hits"], r["freq"], bad / n) * tried < alpha:
            best.append({"if": sorted(items), "support": r["hits"] / n, "confidence": confidence})
    return best


def blocked_by(url_tokens: Column, mined: list[dict]) -> Column:
    """True if a mined rule's tokens are all in the URL.

    The inverted index files each rule under its first token; a URL looks up
    its own tokens and compares only the rules found there.
    """
    if not mined:
        return F.lit(False)
    index: dict[str, list[list[str]]] = {}
    for rule in mined:
        index.setdefault(rule["if"][0], []).append(rule["if"])
    literal = F.from_json(F.lit(json.dumps(index)), "map<string,array<array<string>>>")
    near = F.flatten(F.filter(F.transform(url_tokens, lambda t: F.element_at(literal, t)), lambda r: r.isNotNull()))
    return F.exists(near, lambda rule: F.size(F.array_except(rule, url_tokens)) == 0)


def judge(
    spark: SparkSession,
    pages: DataFrame,
    labelled: DataFrame,
    rules: list[Rule],
    min_support: float = 0.0,
    min_confidence: float = 0.6,
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url).

    The longest rule decides; without one, a URL is blocked if a mined rule matches.
    Null urls and urls without ``://`` have empty host and path, no rule, and are
    decided by their tokens alone, of which null has none (allowed). Repeated rows are
    judged each; other columns are ignored; without labels nothing is mined.
    """
    mined = mine(labelled, min_support, min_confidence)
    url = whole("url")
    seen = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), tokens(url).alias("_tokens"))
    hit = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(blocked_by(F.col("_tokens"), mined), F.lit("block")).otherwise(F.lit("allow"))
    return seen.select(
        "page_id",
        "host",
        "path",
        hit["rule"].alias("rule"),
        F.coalesce(hit["verdict"], own).alias("verdict"),
    )
