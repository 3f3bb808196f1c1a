"""Url verdicts from given rules and from rules mined with FP-growth.

Given rules (host and path, allow or block) decide the urls they fit and label them. Spark's
FP-growth mines frequent sets of url tokens together with the label; a set that implies a label with
enough confidence is a rule, unless a smaller set inside it already is one that is no less sure.
Rules are kept in an inverted index under their rarest token, so a url is compared only with rules
that share it.

Only DataFrame functions and Spark's own FP-growth are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import kept_in_shared_folder, lower_ascii


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values of the contract.
RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)

DEFAULT_VERDICT = "allow"
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8

_LABEL = "label="
_RULE_SCHEMA = "rule_id long, tokens array<string>, verdict string, confidence double, support double"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; then up to ``?``, ``#`` or the end.

    Both are empty for null and for a url without ``://``.
    """
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)) if text is None else text.when(fits, F.lit(r.text))
        verdict = F.when(fits, F.lit(r.verdict)) if verdict is None else verdict.when(fits, F.lit(r.verdict))
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: end of the host, its labels, path parts without digits, ending, query keys.

    Numbers name single pages and can't be frequent; their first digit stays as a token.
    """
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    words = F.filter(parts, lambda x: ~x.rlike("[0-9]"))
    numbers = F.filter(parts, lambda x: x.rlike("^[0-9]"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1))), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z]+)$", 1)
    return F.array_sort(F.array_distinct(F.concat(
        F.transform(F.slice(labels, -1, 1), lambda x: F.concat(F.lit("end:"), x)),
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(words, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(numbers, lambda x: F.concat(F.lit("digit:"), F.substring(x, 1, 1))),
        F.transform(keys, lambda x: F.concat(F.lit("key:"), x)),
        F.when(ending != "", F.array(F.concat(F.lit("ending:"), ending))).otherwise(F.array().cast("array<string>")),
    )))


def _fitting(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens`` of ``sets`` with every rule all of whose tokens they hold, by the inverted index.

    ``tokens`` must be distinct. A rule stands in the index once, under its ``rarest`` token.
    """
    postings = sets.select("tokens", F.explode("tokens").alias("rarest"))
    index = rules.withColumnRenamed("tokens", "rule_tokens")
    return postings.join(index, "rarest").where(F.size(F.array_except("rule_tokens", "tokens")) == 0)


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules from ``tokens, verdict``: ``rule_id, tokens, verdict, confidence, support, rarest``.

    All labelled rows are mined. The single tokens that are frequent are at most (tokens per url) /
    ``min_support``. No labelled rows give no rules.
    """
    spark = labelled.sparkSession
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit(_LABEL), "verdict"))).alias("items"))
    if items.isEmpty():
        return spark.createDataFrame([], _RULE_SCHEMA + ", rarest string")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    sure = (
        model.associationRules.where(F.col("consequent")[0].startswith(_LABEL))
        .select(F.array_sort("antecedent").alias("tokens"),
                F.substring(F.col("consequent")[0], len(_LABEL) + 1, 1_000_000).alias("verdict"),
                "confidence", "support")
        .withColumn("rule_id", F.xxhash64("tokens", "verdict"))
    )
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (
        sure.select("rule_id", F.explode("tokens").alias("token")).join(counts, "token")
        .groupBy("rule_id").agg(F.min(F.struct("freq", "token")).getField("token").alias("rarest"))
    )
    rules = kept_in_shared_folder(sure.join(rarest, "rule_id"))
    # A rule goes if a smaller one inside it, of either verdict, is no less sure.
    inner = rules.select("rarest", "tokens", F.col("confidence").alias("inner_confidence"))
    needless = (
        _fitting(rules.select("tokens").distinct(), inner)
        .where(F.size("rule_tokens") < F.size("tokens"))
        .groupBy("tokens").agg(F.max("inner_confidence").alias("inner_confidence"))
    )
    return (
        rules.join(needless, "tokens", "left")
        .where(F.col("inner_confidence").isNull() | (F.col("confidence") > F.col("inner_confidence")))
        .select("rule_id", "tokens", "verdict", "confidence", "support", "rarest")
    )


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, labelled: DataFrame | None = None,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
          default: str = DEFAULT_VERDICT, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, mined`` for every row of ``pages``.

    Mined rules are learned from ``labelled`` (``url, verdict``), or, without it, from the pages that
    the given rules decide. The most confident rule that fits decides, then support, then the smaller
    verdict; without any, ``default``. ``mined`` holds its tokens. A null url has no host, no path and
    no tokens and gets ``default``. Repeated rows each get a row; no rows give no rows. Urls with the
    same tokens are judged once, so a host with very many pages is one row of the join.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", text.alias("rule"), verdict.alias("given"),
                       url_tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"))
    if labelled is None:
        known = rows.where(F.col("given").isNotNull()).select("tokens", F.col("given").alias("verdict"))
    else:
        h, p = host_and_path(F.col("url"))
        known = labelled.select(url_tokens(h, p, F.col("url")).alias("tokens"), "verdict")
    mined = mine_rules(known, min_support, min_confidence)
    open_sets = rows.where(F.col("given").isNull()).select("tokens").distinct()
    best = (
        _fitting(open_sets, mined.select("rarest", "tokens", "verdict", "confidence", "support"))
        .groupBy("tokens")
        .agg(F.min(F.struct(-F.col("confidence"), -F.col("support"), F.col("verdict"), F.col("rule_tokens"))).alias("best"))
        .select("tokens", F.col("best.verdict").alias("learned"), F.col("best.rule_tokens").alias("mined"))
    )
    return rows.join(best, "tokens", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("given", "learned", F.lit(default)).alias("verdict"),
        F.when(F.col("given").isNull(), F.array_join("mined", " ")).alias("mined"),
    )


def empty_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "url string, verdict string")
