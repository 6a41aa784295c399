"""URL filter: fixed host and path rules, then association rules mined from labelled pages.

FP-growth finds combinations of URL tokens that go with bad labels. Rules that lack bad pages,
confidence, lift or significance, or that a shorter rule implies, are pruned. The rest is stored as
an inverted index, each rule under its rarest token, so that a URL meets only the rules of its own
tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import saved

# Fixed values of the contract: host and path that a URL's must begin with, and the verdict.
RULES: tuple[tuple[str, str, str], ...] = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
BAD = "label=bad"
# Parameters of the mining: least share of the labelled pages, least confidence, least lift.
LEAST_SUPPORT, LEAST_CONFIDENCE, LEAST_LIFT = 0.0002, 0.5, 1.2
# Least number of bad pages that a rule rests on, whatever the share, and the standard errors by
# which its bad share must lie above that of all pages: 4, as thousands of rules are tried at once.
LEAST_PAGES, SIGNIFICANCE = 10, 4.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` and for a null."""
    host, path = (F.coalesce(F.regexp_extract(url, PARTS, n), F.lit("")) for n in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits a host or a domain above it and begins the path, and its verdict."""
    rule = verdict = None
    for name, begin, says in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(begin)
        rule = (F if rule is None else rule).when(fits, F.lit(name + begin))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(says))
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """What a URL is made of: scheme, host, its labels, path words, file ending, query, fragment.
    Numbers in paths are one token, as each page has its own."""
    part = lambda pattern, tag: F.transform(
        F.regexp_extract_all(url, F.lit(pattern), F.lit(1)), lambda x: F.concat(F.lit(tag), x))
    return F.array_distinct(F.filter(F.concat(
        F.array(F.concat(F.lit("host="), host)),
        F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("label:"), x)),
        F.transform(F.split(F.regexp_replace(path, r"[0-9]+", "0"), "/"),
                    lambda x: F.concat(F.lit("path:"), x)),
        part(r"^([A-Za-z]+)://", "scheme:"), part(r"\.([a-z]+)(?:[?#]|$)", "ending:"),
        part(r"[?&]([^&#=]+)", "query:"), part(r"#(.+)$", "fragment:")),
        lambda x: F.length(x) > F.length(F.regexp_extract(x, r"^[a-z]+[:=]", 0))))


def parted(pages: DataFrame, key: str, url: str) -> DataFrame:
    host, path = url_parts(F.col(url))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                        host.alias("host"), path.alias("path"))
    return rows.withColumn("tokens", F.coalesce(
        url_tokens(F.col("url"), F.col("host"), F.col("path")), F.array().cast("array<string>")))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, tokens and label of the pages whose first path number is the id of a labelled
    document. Repeated rows count once, so that copies of one page make no rule."""
    marks = labels.select("doc_id", "quality", "toxic").filter("doc_id IS NOT NULL").groupBy(
        "doc_id").agg(F.max((F.coalesce("quality", F.lit(1)) == 0)
                            | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    number = F.regexp_extract("path", "([0-9]{1,18})", 1)
    known = rows.select("tokens", F.when(number != "", number.cast("long")).alias("doc_id"))
    return known.join(marks, "doc_id").select("doc_id", "tokens", "bad").distinct()


def lower_limit(share: Column, count: Column, errors: float) -> Column:
    """Wilson's lower confidence limit of a share of ``count`` pages."""
    square = errors * errors
    spread = F.sqrt(share * (1 - share) / count + square / (4 * count * count))
    return (share + square / (2 * count) - errors * spread) / (1 + square / count)


def mined_rules(known: DataFrame, support: float = LEAST_SUPPORT,
                confidence: float = LEAST_CONFIDENCE, lift: float = LEAST_LIFT) -> DataFrame:
    """rule_id, tokens and index token of each pruned rule ``tokens -> bad``.

    A rule holds on at least ``LEAST_PAGES`` bad pages and on ``support`` of all labelled pages,
    which bounds the number of frequent tokens to (tokens per URL) / support; the lower confidence
    limit of its bad share lies above the bad share of all labelled pages.
    """
    known = saved(known, "labelled")
    total = known.count()
    baskets = known.select(
        F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens"))
        .alias("items"))
    model = FPGrowth(itemsCol="items", minConfidence=confidence, minSupport=min(
        1.0, max(support, (LEAST_PAGES - 0.5) / max(1, total)))).fit(baskets)
    bad, share = F.round(F.col("support") * total), F.col("confidence")
    rules = model.associationRules.filter(
        (F.element_at("consequent", 1) == BAD) & (F.col("lift") >= lift) & (bad >= LEAST_PAGES)
        & (lower_limit(share, bad / share, SIGNIFICANCE) > share / F.col("lift"))).select(
        F.sort_array("antecedent").alias("rule"))
    # A rule is implied if one with a part of its tokens is there too.
    few = rules.select(F.col("rule").alias("few"))
    implied = rules.select("rule", F.explode("rule").alias("token")).join(
        few.withColumn("token", F.element_at("few", 1)), "token").filter(
        (F.size("few") < F.size("rule"))
        & F.forall("few", lambda x: F.array_contains("rule", x))).select("rule").distinct()
    rules = rules.join(implied, "rule", "left_anti")
    counts = model.freqItemsets.filter(F.size("items") == 1).select(
        F.element_at("items", 1).alias("token"), "freq")
    rare = rules.select("rule", F.explode("rule").alias("token")).join(counts, "token").groupBy(
        "rule").agg(F.min_by("token", "freq").alias("token"))
    return rare.select("token", "rule")


def matched_urls(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct URLs of which some rule holds all tokens, by the inverted index."""
    distinct = rows.filter(F.size("tokens") > 0).groupBy("url").agg(
        F.first("tokens").alias("tokens"))
    met = distinct.select("url", "tokens", F.explode("tokens").alias("token")).join(rules, "token")
    return met.filter(F.forall("rule", lambda x: F.array_contains("tokens", x))).select(
        "url").distinct()


def held_out_precision(pages: DataFrame, labels: DataFrame, key: str = "page_id",
                       url: str = "url", seed: int = 0) -> DataFrame:
    """One row: rules mined on one half of the labelled documents, and of the pages of the other
    half how many there are, are bad, are hit by a rule, and are both."""
    known = labelled(parted(pages, key, url), labels)
    half = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2))
    rules = mined_rules(known.filter(half == 0))
    tried = known.filter(half == 1).select(
        F.concat_ws(" ", "doc_id", "tokens").alias("url"), "tokens", "bad")
    hits = matched_urls(tried, rules).withColumn("hit", F.lit(True))
    number = lambda of, name: F.count(F.when(of, 1)).alias(name)
    return tried.join(hits, "url", "left").agg(
        F.count("*").alias("pages"), number(F.col("bad"), "bad"), number(F.col("hit"), "hit"),
        number(F.col("hit") & F.col("bad"), "bad_hit")).crossJoin(
        rules.agg(F.count("*").alias("rules")))


def url_filter(pages: DataFrame, labels: DataFrame, key: str = "page_id",
               url: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule (or null) and verdict.

    A fixed rule decides if one fits; else a URL that a mined rule matches is blocked and any
    other allowed. A null URL, or one without ``://``, has empty parts and is allowed. Without
    labelled pages nothing is mined. Repeated rows get the same verdict. Other columns are not read.
    """
    rows = parted(pages, key, url)
    hits = matched_urls(rows, mined_rules(labelled(rows, labels))).withColumn("hit", F.lit(True))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    return rows.drop("tokens").join(hits, "url", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))
