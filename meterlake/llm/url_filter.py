"""URL verdicts: longest host/path rule first, gradient-boosted trees on lexical features for the rest.

Everything runs in the JVM: the features are DataFrame expressions, the trees are Spark ML's.

Defined cases: a null or empty url, or one without ``://``, has an empty host and path, fits no rule and is judged by
the trees on its features. Very long urls are read whole. Repeated rows are judged alike; rules of one length that fit one url are
equal, and the first holds. Extra columns stay, whatever their names; the result columns' are replaced. With no
labelled url, or labels of one kind only, there is nothing to learn and urls without a rule are allowed (blocked, if all labels
say so). An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_names, checkpointed, fresh, let, lower_ascii


class Rule(NamedTuple):
    """Fits host and all its subdomains where the url's path starts with path (with its leading slash)."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: At most so many labelled urls are learned from: those with the smallest hash of the url.
MAX_LABELLED = 20_000
FEATURES = ("url_chars", "host_chars", "path_chars", "depth", "host_labels", "digit_ratio", "host_entropy", "hyphens", "n_params", "query_chars", "has_fragment", "suffix_rate", "suffix_share")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(df: DataFrame, rules: Sequence[Rule], host: str, path: str) -> DataFrame:
    """Adds rule and, last, the verdict of the longest rule that fits, both null where none does.

    Rules of one length cannot fit one url twice unless they are equal; the first then holds.
    """
    fits = lambda r: (df[host].isin(r.host) | df[host].endswith("." + r.host)) & df[path].startswith(r.path)
    ordered = sorted(rules, key=lambda r: -len(r.text))
    pick = lambda of: F.coalesce(*[F.when(fits(r), F.lit(of(r))) for r in ordered], F.lit(None).cast("string"))
    return df.withColumns({"rule": pick(lambda r: r.text), fresh(df, "rule_verdict")[0]: pick(lambda r: r.verdict)})


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("double")


def _entropy(c: Column) -> Column:
    """Shannon entropy in bits of a short string's characters."""
    n = F.length(c)
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    share = lambda x: (n - F.length(F.replace(c, x, F.lit("")))) / n
    sum_of = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, x: a - share(x) * F.log2(share(x)))
    return F.when(n == 0, 0.0).otherwise(sum_of)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    full, query = F.coalesce(url, F.lit("")), F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    double = lambda c: c.cast("double")
    return {
        "url_chars": double(F.length(full)),
        "host_chars": double(F.length(host)),
        "path_chars": double(F.length(path)),
        "depth": _count(path, "/[^/]"),
        "host_labels": _count(host, r"[^.]+"),
        "digit_ratio": F.when(F.length(full) == 0, 0.0).otherwise(_count(full, "[0-9]") / F.length(full)),
        "host_entropy": let(host, _entropy),
        "hyphens": _count(host, "-"),
        "n_params": _count(query, "[^&=]+="),
        "query_chars": double(F.length(query)),
        "has_fragment": double(F.contains(full, F.lit("#")).cast("int")),
    }


class UrlModel(NamedTuple):
    """The fitted trees and the suffix statistics that they read; neither where there was nothing to learn."""

    trees: object | None
    suffixes: DataFrame | None
    prior: float

    def block_probability(self, df: DataFrame, url: str, host: str, path: str) -> DataFrame:
        """df with block_probability; no other column is added, none is dropped."""
        if self.trees is None:
            return df.withColumn("block_probability", F.lit(self.prior))
        # All columns of df travel in one, so none can clash with the features' names.
        rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[url].alias("u"), df[host].alias("h"), df[path].alias("p"))
        made = {f"_{k}": c for k, c in lexical(F.col("u"), F.col("h"), F.col("p")).items()}
        # Suffix statistics: one row for each top-level name seen in the bounded labelled sample.
        rated = rows.withColumns(made | {"_suffix": F.regexp_extract("h", r"[^.]*$", 0)}).join(F.broadcast(self.suffixes), "_suffix", "left")
        rated = rated.withColumns({"_suffix_rate": F.coalesce("_suffix_rate", F.lit(self.prior)), "_suffix_share": F.coalesce("_suffix_share", F.lit(0.0))})
        scored = self.trees.transform(VectorAssembler(inputCols=[f"_{k}" for k in FEATURES], outputCol="_features").transform(rated))
        return scored.select("row.*", vector_to_array("_probability")[1].alias("block_probability"))


def fit(labelled: DataFrame, url: str, label: str, host: str, path: str, max_labelled: int = MAX_LABELLED, rounds: int = 12, depth: int = 4, smoothing: float = 20.0) -> UrlModel:
    """Learns from labelled urls (label 1: block, 0: allow) by the trees' log loss.

    The sample is bounded by ``max_labelled``; equal urls with equal labels count once, so a hot host that repeats an
    url does not crowd out the rest.
    """
    seen = labelled.where(labelled[label].isNotNull()).select(*[labelled[c].alias(a) for c, a in ((url, "u"), (host, "h"), (path, "p"))], labelled[label].cast("double").alias("y"))
    sample = checkpointed(seen.groupBy("u", "h", "p", "y").count().drop("count").orderBy(F.xxhash64("u"), "u", "y").limit(max_labelled))
    n, blocked = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        return UrlModel(None, None, 1.0 if n and blocked == n else 0.0)
    prior = blocked / n
    suffixes = sample.groupBy(F.regexp_extract("h", r"[^.]*$", 0).alias("_suffix")).agg(
        ((F.sum("y") + F.lit(prior * smoothing)) / (F.count("*") + F.lit(smoothing))).alias("_suffix_rate"),
        (F.count("*") / F.lit(float(n))).alias("_suffix_share"),
    )
    suffixes = checkpointed(suffixes)
    made = {f"_{k}": c for k, c in lexical(F.col("u"), F.col("h"), F.col("p")).items()}
    rows = sample.withColumns(made | {"_suffix": F.regexp_extract("h", r"[^.]*$", 0)}).join(F.broadcast(suffixes), "_suffix")
    vectors = VectorAssembler(inputCols=[f"_{k}" for k in FEATURES], outputCol="_features").transform(rows).select("_features", "y")
    trees = GBTClassifier(featuresCol="_features", labelCol="y", predictionCol="_prediction", maxIter=rounds, maxDepth=depth, stepSize=0.2, maxBins=32, minInstancesPerNode=5, seed=42).setProbabilityCol("_probability").setRawPredictionCol("_raw")
    return UrlModel(trees.fit(checkpointed(vectors)), suffixes, prior)


@any_names
def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", threshold: float = 0.5, model: UrlModel | None = None, **fitting) -> DataFrame:
    """pages with host, path, rule, verdict (allow or block) and block_probability.

    A rule's verdict stands; the rest go to ``model``, or to one fitted on the urls that the rules label.
    Columns of these names that pages has already are replaced.
    """
    base = pages.drop("host", "path", "rule", "verdict", "block_probability")
    host, path = host_and_path(base[url])
    ruled = with_rule(base.withColumns({"host": host, "path": path}), rules, "host", "path")
    of_rule = ruled.columns[-1]
    if model is None:
        label = F.when(F.col(of_rule) == "block", 1).when(F.col(of_rule) == "allow", 0)
        labels = ruled.select(F.col(url).alias("u"), "host", "path", label.alias("y"))
        model = fit(labels, "u", "y", "host", "path", **fitting)
    scored = model.block_probability(ruled, url, "host", "path")
    learned = F.when(F.col("block_probability") >= threshold, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce(of_rule, learned)).drop(of_rule)
