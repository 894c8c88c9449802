"""URL filters: rules for hosts and paths, and logistic regression on hashed character n-grams.

Everything is a Spark SQL expression: n-grams are slices of an array of
characters, hashed to a fixed number of buckets; weights are one constant
array.  Training descends the gradient over a small labelled table, one
aggregation for each step, and gathers one number for each bucket.

Null URLs and URLs without ``://`` have an empty host and path; they are
judged by the model's intercept, as is any URL without n-grams.  Very long
URLs cost time in proportion to their length.  Equal rows get equal results,
other columns pass through, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isograd.llm.storage import free_names, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BUCKETS = 1 << 15
LENGTHS = (3, 4, 5)
STEPS = 20
RATE = 0.5
DECAY = 1e-4
#: Probability from which a URL is blocked; a wrongly blocked page is worse than one let through.
LIMIT = 0.8

# The labelled table.  Each term is combined with each pattern; neutral hosts are pairs of letter groups.
BLOCK_TERMS = (
    "spam", "casino", "bets", "poker", "slots", "adult", "porn", "xxx", "sex", "nude", "escort", "pills", "viagra", "cheap-pharma",
    "warez", "crack", "torrent", "malware", "phish", "scam", "payday", "fast-loans", "click-bait", "link-farm", "lottery", "jackpot",
    "ads", "ad-track", "casino-win", "pop-ads",
)
ALLOW_TERMS = (
    "news", "library", "museum", "school", "science", "weather", "garden", "recipes", "history", "music", "travel", "health", "city",
    "sports", "review", "forum", "archive", "journal", "docs", "wiki", "university", "research", "photo", "maps", "books", "art",
)
LETTER_GROUPS = ("th", "er", "an", "on", "re", "st", "in", "ti", "ble", "nd", "ou", "ha", "ly", "tion", "es", "at", "he", "ed", "en", "nt", "wh", "sh",
                 "or", "ea", "al")
PATTERNS = (
    "http://{}.example.com/en/1", "https://www.{}.example.org/fr/27.html", "http://m.{}.example.net/de/305/", "https://blog.{}.example.com/es/4118",
)
COMPOUND_PATTERNS = (
    "https://free-{}.example.org/fr/27", "http://www.{}-farm.example.net/de/305.html", "https://{}-x.example.com/es/4118/",
    "http://m.best-{}.example.org/en/99.html", "http://{}-win.example.com/en/7", "https://my-{}.example.net/de/1234",
)


def labelled(spark: SparkSession) -> DataFrame:
    """The small labelled table, over a thousand rows by rule: ``url`` and ``bad`` (1.0 or 0.0)."""

    def kind(terms: Column, patterns: Sequence[str], bad: float) -> DataFrame:
        every = spark.range(1).select(F.explode(terms).alias("term")).select("term", F.explode(F.array(*map(F.lit, patterns))).alias("pattern"))
        return every.select(F.expr("replace(pattern, '{}', term)").alias("url"), F.lit(bad).alias("bad"))

    groups = F.array(*map(F.lit, LETTER_GROUPS))
    pairs = F.flatten(F.transform(groups, lambda x: F.transform(groups, lambda y: F.concat(x, y))))
    return (
        kind(F.array(*map(F.lit, BLOCK_TERMS)), PATTERNS + COMPOUND_PATTERNS, 1.0)
        .unionAll(kind(F.array(*map(F.lit, ALLOW_TERMS)), PATTERNS + COMPOUND_PATTERNS, 0.0))
        .unionAll(kind(pairs, PATTERNS[:2], 0.0))
    )


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ngram_buckets(host: Column, path: Column, buckets: int = BUCKETS, lengths: Sequence[int] = LENGTHS) -> Column:
    """Buckets of the character n-grams of host and path, each with its ends marked."""

    def of(kind: str, value: Column) -> list[Column]:
        chars = F.split(F.concat(F.lit("^"), F.translate(value, "0123456789", "0000000000"), F.lit("$")), "")

        def hashed(n: int) -> Column:
            starts = F.when(F.size(chars) >= n, F.sequence(F.lit(1), F.size(chars) - (n - 1)))
            gram = lambda i: F.concat_ws("", F.slice(chars, i, n))
            return F.transform(
                F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.pmod(F.xxhash64(F.lit(kind), gram(i)), F.lit(buckets)).cast("int")
            )

        return [hashed(n) for n in lengths]

    return F.concat(*of("h", host), *of("p", path))


def _constant(values: Sequence[float]) -> Column:
    """A constant array, handed to Spark as one string that the optimiser folds."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _margin(at: Column, weights: Sequence[float]) -> Column:
    known = _constant(weights)
    total = F.aggregate(at, F.lit(0.0), lambda s, i: s + F.get(known, i))
    return F.get(known, F.lit(len(weights) - 1)) + F.when(F.size(at) > 0, total / F.sqrt(F.size(at).cast("double"))).otherwise(0.0)


def train(
    table: DataFrame, buckets: int = BUCKETS, lengths: Sequence[int] = LENGTHS, steps: int = STEPS, rate: float = RATE, decay: float = DECAY
) -> list[float]:
    """Weights of the buckets and the intercept, over ``table`` (``url``, ``bad``), in which both kinds count alike.

    Each weight descends with a rate of its own, by the slopes it has seen.
    """
    featured = table.select("bad", ngram_buckets(host(F.col("url")), path(F.col("url")), buckets, lengths).alias("at"))
    rows = stored(featured.coalesce(1), "url-training").coalesce(1)  # small by its parameter: one task, no shuffle
    size = {r["bad"]: r["n"] for r in rows.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("bad") == 1.0, 1.0 / max(1, size.get(1.0, 0))).otherwise(1.0 / max(1, size.get(0.0, 0)))
    weights, seen = [0.0] * (buckets + 1), [1e-10] * (buckets + 1)
    for _ in range(steps if size else 0):
        error = (F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(F.col("at"), weights))) - F.col("bad")) * share
        each = rows.select(
            F.explode(F.concat("at", F.array(F.lit(buckets)))).alias("bucket"),
            error.alias("error"),
            F.sqrt(F.greatest(F.size("at"), F.lit(1)).cast("double")).alias("norm"),
        )
        part = F.when(F.col("bucket") == buckets, F.col("error")).otherwise(F.col("error") / F.col("norm"))
        for r in each.groupBy("bucket").agg(F.sum(part).alias("slope")).collect():
            b = r["bucket"]
            slope = r["slope"] + decay * weights[b]
            seen[b] += slope * slope
            weights[b] -= rate * slope / seen[b] ** 0.5
    return weights


def rule_fits(host: Column, path: Column, rule: str) -> Column:
    """Whether a rule ``host/path`` fits: its host or a subdomain of it, and a path that starts with the rule's."""
    name, slash, rest = rule.partition("/")
    return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))


def filter_urls(
    pages: DataFrame,
    rules: dict[str, str],
    weights: Sequence[float],
    url: str = "url",
    into: str = "judged",
    lengths: Sequence[int] = LENGTHS,
    limit: float = LIMIT,
) -> DataFrame:
    """``pages`` with a struct: ``host``, ``path``, ``rule``, ``verdict``, ``score``.

    ``rules`` gives the verdict, block or allow, of each ``host/path``; the
    longest that fits wins.  Where none fits, the model's probability decides.
    """
    url_, rule_, score_ = free_names(pages.columns, "__url", "__rule", "__score")
    host_, path_ = F.col(f"{url_}.host"), F.col(f"{url_}.path")
    rule = F.lit(None).cast("string")
    for name in sorted(rules, key=lambda r: (len(r), r)):
        rule = F.when(rule_fits(host_, path_, name), F.lit(name)).otherwise(rule)
    verdict = F.lit(None).cast("string")
    for name, says in rules.items():
        verdict = F.when(F.col(rule_) == name, F.lit(says)).otherwise(verdict)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(ngram_buckets(host_, path_, len(weights) - 1, lengths), weights)))
    rest = pages.drop(into)
    judged = (
        rest.withColumn(url_, F.struct(host(F.col(url)).alias("host"), path(F.col(url)).alias("path")))
        .withColumn(rule_, rule)
        .withColumn(score_, score)
    )
    by_model = F.when(F.col(score_) >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        *rest.columns,
        F.struct(
            host_.alias("host"), path_.alias("path"), F.col(rule_).alias("rule"), F.coalesce(verdict, by_model).alias("verdict"),
            F.col(score_).alias("score"),
        ).alias(into),
    )
