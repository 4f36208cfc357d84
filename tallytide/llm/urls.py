"""URL filters: rules first, then gradient-boosted trees on lexical features of the address.

The trees are trained on labelled addresses; where only rules are at hand, the addresses they
cover are the labelled ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import LOWER, UPPER, ready, saved

TRAIN_ROWS = 20_000  # labelled addresses the trees are fitted on, about
TREES, DEPTH, SEED = 20, 4, 7
_SPLIT = re.compile(r"[/?#]")


@dataclass(frozen=True)
class Rule:
    """``host/path`` and whether it allows; it fits its host and all subdomains."""

    pattern: str
    allow: bool

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


RULES = (
    Rule("org/", True), Rule("example.org/es/", False), Rule("example.org/en/1", False),
    Rule("com/fr/", True), Rule("com/de/", False),
)


def host_of(url: Column) -> Column:
    found = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, NULL if none does. A short list: it becomes one expression."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern)):
        fits = _fits(rule, host, path)
        out = F.when(fits, rule.pattern) if out is None else out.when(fits, rule.pattern)
    return F.lit(None).cast("string") if out is None else out


def lexical(url: str | None) -> list[float]:
    """Length, host length and labels, path depth and longest segment, shares of digits and marks, entropy, parameters."""
    url = url or ""
    rest = url.partition("://")[2]
    host = _SPLIT.split(rest, maxsplit=1)[0]
    tail = rest[len(host) :]
    path = re.split(r"[?#]", tail, maxsplit=1)[0]
    query = tail[len(path) :].partition("?")[2].partition("#")[0]
    n = max(len(url), 1)
    parts = [p for p in path.split("/") if p]
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(url).values())
    return [
        float(len(url)), float(len(host)), float(host.count(".") + 1), float(len(parts)),
        float(max(map(len, parts), default=0)), sum(c.isdigit() for c in url) / n,
        sum(not c.isalnum() for c in url) / n, entropy, float(len([p for p in query.split("&") if p])),
        float(len(query)), float("#" in url), float(path.endswith("/")), float(sum(c.isdigit() for c in host)),
        float(url.startswith("https")),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def lexical_features(urls: pd.Series) -> pd.Series:
    return urls.map(lexical)


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _with_vector(df: DataFrame, features: Column, blocked: Column, seen: Column) -> DataFrame:
    """Lexical features plus the suffix's smoothed share of blocked addresses and its count."""
    share = (F.coalesce(blocked, F.lit(0.0)) + 1) / (F.coalesce(seen, F.lit(0.0)) + 2)
    both = F.concat(features, F.array(share, F.log1p(F.coalesce(seen, F.lit(0.0)))))
    return df.withColumn("_features", array_to_vector(both))


@dataclass(frozen=True)
class UrlModel:
    """Trees and suffix statistics, or one verdict where the labels know only one."""

    trees: object
    suffixes: DataFrame
    only: float | None


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> UrlModel:
    """``labelled``: url, label (1 block, 0 allow). NULL labels are left out; without labels everything is allowed.

    Suffix statistics come from all labelled rows; the trees from about ``rows`` of them, chosen
    by a hash of the address. For a training row the statistics come from the half of the rows
    that it is not in, so that its own label has no part in them.
    """
    ready(labelled.sparkSession)
    known = labelled.select("url", F.col("label").cast("double").alias("label")).dropna(subset=["label"])
    known = known.withColumn("_suffix", suffix_of(host_of(F.col("url"))))
    known = known.withColumn("_half", F.pmod(F.xxhash64("url"), F.lit(2)))
    halves = saved(known.groupBy("_suffix", "_half").agg(
        F.sum("label").alias("_blocked"), F.count("*").cast("double").alias("_seen")))
    suffixes = saved(halves.groupBy("_suffix").agg(F.sum("_blocked").alias("_blocked"), F.sum("_seen").alias("_seen")))
    total = suffixes.agg(F.sum("_seen").alias("n"), F.sum("_blocked").alias("b")).first()
    n, b = total["n"] or 0, total["b"] or 0
    if b in (0, n):
        return UrlModel(None, suffixes, float(n > 0 and b == n))
    share = int(min(1.0, rows / n) * (1 << 30))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(SEED), "url"), F.lit(1 << 30)) < share)
    other = halves.withColumn("_half", 1 - F.col("_half"))
    chosen = chosen.join(other, ["_suffix", "_half"], "left")
    fit_on = _with_vector(chosen, lexical_features("url"), 2 * F.col("_blocked"), 2 * F.col("_seen"))
    fit_on = saved(fit_on.select("_features", "label"))
    if fit_on.select("label").distinct().count() < 2:
        return UrlModel(None, suffixes, float(b > n - b))
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2)
    return UrlModel(trees.fit(fit_on), suffixes, None)


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, labelled: DataFrame | None = None, url: str = "url",
          keep: Sequence[str] | None = None) -> DataFrame:
    """Add host, path, rule, verdict (allow or block) and score (chance of block) to each page.

    The longest rule that fits decides; the trees judge the rest. Without ``labelled`` they
    learn from the addresses that rules cover. A NULL address, or one without ``://``, has an
    empty host and path. ``keep``: columns of ``pages`` to return, all by default; columns with
    one of the new names are replaced.
    """
    ready(pages.sparkSession)
    new = ("host", "path", "rule", "verdict", "score")
    kept = [c for c in (keep if keep is not None else pages.columns) if c not in new]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0))
    work = pages.select(row.alias("_row"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    work = work.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    allows = F.col("rule").isin([r.pattern for r in rules if r.allow])
    if labelled is None:
        labelled = work.filter("rule is not null").select("url", F.when(allows, 0).otherwise(1).alias("label"))
    model = train(labelled)
    if model.only is not None:
        scored = work.withColumn("score", F.lit(model.only))
    else:
        met = work.withColumn("_suffix", suffix_of(F.col("host"))).join(model.suffixes, "_suffix", "left")
        met = _with_vector(met, lexical_features("url"), F.col("_blocked"), F.col("_seen"))
        scored = model.trees.transform(met).withColumn("score", vector_to_array("probability")[1])
    by_rule = F.when(allows, "allow").when(F.col("rule").isNotNull(), "block")
    verdict = F.coalesce(by_rule, F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], "host", "path", "rule", verdict.alias("verdict"), "score")
