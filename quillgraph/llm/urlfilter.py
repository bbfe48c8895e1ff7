"""URL filter: editors' rules first, gradient-boosted trees on lexical features for the rest.

Everything runs on built-in column expressions and the JVM's tree learner.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.operators.skew import salted_join
from quillgraph.sources.shared import shared_dir

#: Labelled URLs that the trees are fitted on at most, the first ones by hash.
TRAIN_ROWS = 20_000
#: Suffixes whose shares are broadcast, two numbers each; beyond that URLs are joined with them, hot suffixes dealt out.
SUFFIXES = 1_000_000
#: Tasks that the trees are fitted in.
FIT_TASKS = 8
#: Rules are compared one by one with each URL, so their number is bounded.
MAX_RULES = 1_000

MARKS = "-._/?=&%"
NUMBERS = (
    "n_url", "n_host", "n_path", "depth", "labels", "longest", "hyphens", "digits", "uppers", "entropy",
    "params", "query", "fragment", "escapes", "tld_share", "domain_share",
)


@dataclass(frozen=True)
class Rule:
    """``host/path`` and what it decides, ``allow`` or ``block``."""

    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        _, slash, rest = self.rule.partition("/")
        return slash + rest


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a URL; both empty without ``://`` or for null."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct ``(rule, verdict)``, or null.

    A rule fits its host and all subdomains if the path starts with its own.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (-len(r.rule), r.rule))
    known = F.array(
        *(F.struct(*(F.lit(v).alias(k) for k, v in (("rule", r.rule), ("verdict", r.verdict), ("host", r.host), ("path", r.path)))) for r in ordered)
    )

    def fits(r: Column) -> Column:
        same = (host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))
        return same & path.startswith(r["path"])

    first = F.get(F.filter(known, fits), F.lit(0))
    return F.when(first.isNotNull(), F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


def _count(text: Column, marks: str) -> Column:
    return F.length(text) - F.length(F.translate(text, marks, ""))


def _entropy(text: Column) -> Column:
    """Bits per character over letters without case, digits as one, the marks, and the rest as one."""
    lower, n = ascii_lower(text), F.greatest(F.length(text), F.lit(1))
    groups = [*string.ascii_lowercase, string.digits, *MARKS]
    counts = F.array(*(_count(lower, g) for g in groups), F.length(F.translate(lower, "".join(groups), "")))
    return F.aggregate(counts, F.lit(0.0), lambda s, c: s - F.when(c > 0, c / n * F.log2(c / n)).otherwise(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features, all but the two suffix shares, to ``(url, host, path)``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    labels = F.split(host, r"\.")
    rest = F.substr(url, F.length(F.substring_index(url, "?", 1)) + 1)
    n = F.greatest(F.length(url), F.lit(1))
    return urls.withColumns(
        {
            "n_url": F.length(url),
            "n_host": F.length(host),
            "n_path": F.length(path),
            "depth": _count(path, "/"),
            "labels": F.size(labels),
            "longest": F.array_max(F.transform(labels, F.length)),
            "hyphens": _count(host, "-"),
            "digits": _count(url, string.digits) / n,
            "uppers": _count(url, string.ascii_uppercase) / n,
            "entropy": _entropy(url),
            "params": F.when(rest == "", 0).otherwise(_count(rest, "&") + 1),
            "query": F.length(rest),
            "fragment": url.contains("#").cast("int"),
            "escapes": _count(url, "%") / n,
            "tld": F.element_at(labels, -1),
            "domain": F.concat_ws(".", F.slice(F.concat(F.array(F.lit("")), labels), -2, 2)),
        }
    )


@dataclass
class UrlModel:
    """Fitted trees and suffix shares; trees is None if there was one class at most.

    ``shares`` has for each kind of suffix its table ``(suffix, share)``, a
    suffix named by its 64-bit hash, and how many rows that has.
    """

    prior: float
    shares: dict[str, tuple[DataFrame, int]]
    trees: GBTClassificationModel | None

    def features(self, urls: DataFrame) -> DataFrame:
        """``urls (url, host, path, ...)`` with all features as numbers and no null."""
        made = lexical(urls)
        for kind in ("tld", "domain"):
            made = self._with_share(made.withColumn("suffix", F.xxhash64(kind)), kind).drop("suffix")
        return made.drop("tld", "domain").withColumns({x: F.col(x).cast("double") for x in NUMBERS})

    def _with_share(self, urls: DataFrame, kind: str) -> DataFrame:
        """Adds the block share of a URL's ``suffix``, the share of all if no label knows it."""
        shares, n = self.shares[kind]
        if n <= SUFFIXES:
            met = urls.join(F.broadcast(shares), "suffix", "left")
        else:
            named = urls.groupBy("suffix").agg(F.count("*").alias("times")).join(shares, "suffix", "left")
            met = salted_join(urls, named, "suffix", "url", "times").drop("times")
        return met.withColumn(f"{kind}_share", F.coalesce("share", F.lit(self.prior))).drop("share")

    def score(self, urls: DataFrame) -> DataFrame:
        """Adds ``score``, the chance that a URL is one to block, to ``(url, host, path, ...)``."""
        kept = urls.columns
        if self.trees is None:
            return urls.withColumn("score", F.lit(self.prior))
        made = VectorAssembler(inputCols=list(NUMBERS), outputCol="_features").transform(self.features(urls))
        scored = self.trees.transform(made).withColumn("score", vector_to_array("_chance")[1])
        return scored.select(*kept, "score")


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS, rounds: int = 20, depth: int = 4, smooth: float = 10.0) -> UrlModel:
    """Trees from labelled URLs ``(url, host, path, blocked)``, blocked 0 or 1.

    The trees are fitted on the ``train_rows`` first of the distinct labelled
    URLs by hash. Suffix statistics are the smoothed block shares of the last
    label and of the last two labels of the host, of every suffix over all
    distinct labelled URLs.
    """
    shared_dir(labelled.sparkSession)
    rows = labelled.select("url", "host", "path", F.col("blocked").cast("double").alias("blocked")).filter("url is not null")
    rows = rows.distinct().checkpoint()
    n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    prior = blocked / n if n else 0.0
    if blocked in (0, n):
        return UrlModel(prior, {}, None)
    sample = rows.orderBy(F.xxhash64("url"), "url", "blocked").limit(train_rows)
    sample = sample.repartition(FIT_TASKS, "url").sortWithinPartitions(F.xxhash64("url"), "url", "blocked").checkpoint()
    named, shares = lexical(rows), {}
    for kind in ("tld", "domain"):
        share = (F.sum("blocked") + smooth * prior) / (F.count("*") + smooth)
        held = named.groupBy(F.xxhash64(kind).alias("suffix")).agg(share.alias("share")).checkpoint()
        shares[kind] = held, held.count()
    model = UrlModel(prior, shares, None)
    made = VectorAssembler(inputCols=list(NUMBERS), outputCol="_features").transform(model.features(sample))
    learner = GBTClassifier(featuresCol="_features", labelCol="blocked", predictionCol="_predicted", maxIter=rounds, maxDepth=depth, seed=7)
    learner = learner.setProbabilityCol("_chance").setRawPredictionCol("_raw")
    model.trees = learner.fit(made.select("_features", "blocked"))
    return model


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, **options) -> DataFrame:
    """Every row of ``pages (page_id, url)`` judged: ``(page_id, host, path, rule, verdict, score)``.

    The verdict is the matching rule's; without one it is ``block`` if the
    trees give 0.5 or more. ``labelled (url, blocked)`` are the URLs to learn
    from; if it is None, those are the URLs that a rule decides. A null or
    malformed URL has an empty host and path and is scored like any other;
    repeated rows are judged alike; an empty table gives no rows; columns
    other than page_id and url are not looked at. More than ``MAX_RULES`` rules
    raise an error.
    """
    host, path = split_url(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    judged = parts.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        known = judged.filter("_rule is not null").withColumn("blocked", (F.col("_rule.verdict") == "block").cast("int"))
    else:
        host, path = split_url(F.col("url"))
        known = labelled.select("url", host.alias("host"), path.alias("path"), "blocked")
    scored = fit(known, **options).score(judged)
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "score"
    )
