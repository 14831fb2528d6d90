"""URL verdicts: prefix rules first, then boosted trees on lexical features of the URL."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage

#: Bound of the training sample, in distinct labelled URLs.
TRAIN_ROWS = 20_000
TREES, DEPTH = 12, 4
FEATURES = ("url_length", "host_length", "path_depth", "host_labels", "digit_ratio", "hyphens", "entropy", "parameters",
            "suffix_rate", "suffix_weight")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after(url: Column) -> Column:
    """What follows the first ``://``; empty for null and where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """Longest rule ``host/path`` that fits the host or a parent of it and leads the path; null if none does."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}"), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _count(text: Column, what: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{what}]", "")).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy in bits over the text's characters."""
    n = F.length(text).cast("double")
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(c == "", 0.0).otherwise((n - F.length(F.replace(text, c, F.lit("")))) / n))
    return F.when(n > 0, F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` with the lexical features of column ``_url`` (null: empty) and its host's ``_suffix``."""
    url, host, path = F.coalesce("_url", F.lit("")), F.col("_host"), F.col("_path")
    n = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns({
        "url_length": n, "host_length": F.length(host).cast("double"), "path_depth": _count(path, "/"),
        "host_labels": _count(host, ".") + 1, "digit_ratio": F.when(n > 0, _count(url, "0-9") / n).otherwise(0.0),
        "hyphens": _count(host, "-"), "entropy": entropy(url),
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1), "_suffix": suffix_of(host)})


def fit(rows: DataFrame) -> tuple[object | None, DataFrame, float]:
    """Model, suffix statistics and rate of label 1 from ``(_url, _host, _path, label)``; rows no rule fits have a null label.

    Counts per suffix are taken over all rows, label rates over all labelled rows. Only the trees learn from a sample, the
    ``TRAIN_ROWS`` distinct labelled URLs with the smallest hash. Without both labels in the sample there is no model and the
    rate alone decides.
    """
    counts = rows.groupBy(suffix_of(F.col("_host")).alias("_suffix")).agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("ones"))
    counts = stage(counts, "url-suffixes")
    total = counts.agg(F.sum("labelled").alias("labelled"), F.sum("ones").alias("ones")).first()
    rate = (total["ones"] or 0.0) / max(1, total["labelled"] or 0)
    suffixes = counts.select("_suffix", ((F.col("ones") + rate * 2) / (F.col("labelled") + 2)).alias("suffix_rate"), F.log2(F.col("n") + 1).alias("suffix_weight"))
    sample = rows.filter(F.col("label").isNotNull()).dropDuplicates(["_url"]).orderBy(F.xxhash64("_url"), "_url").limit(TRAIN_ROWS)
    sample = stage(sample, "url-sample")
    if sample.select("label").distinct().count() < 2:
        return None, suffixes, rate
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, labelCol="label", featuresCol="features")
    return trees.fit(featured(sample, suffixes, rate).select("features", "label")), suffixes, rate


def featured(urls: DataFrame, suffixes: DataFrame, rate: float) -> DataFrame:
    """Features as one vector. The suffix table grows with the distinct suffixes, so Spark chooses the join by its size."""
    rows = lexical(urls).join(suffixes, "_suffix", "left").fillna({"suffix_rate": rate, "suffix_weight": 0.0})
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def judge_urls(pages: DataFrame, rules: dict[str, str], url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``(*keep, host, path, rule, verdict, score)`` of every row.

    ``rules`` maps ``host/path`` to ``allow`` or ``block``. URLs that a rule fits are the labelled ones the trees learn
    from; all others get the trees' verdict, ``block`` from a probability of 0.5. A null URL, or one without ``://``, has
    empty host and path. Repeated rows are judged each; an empty table gives no rows; URLs of any length are read whole. Of the table only ``keep`` and the URL are read; its rows are exchanged only where the suffix table
    is above Spark's size for broadcasts.
    """
    rows = pages.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.col(url).cast("string").alias("_url"))
    rows = rows.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    rows = rows.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    wanted = reduce(lambda so_far, rule: F.when(F.col("_rule") == rule, F.lit(rules[rule])).otherwise(so_far), rules, F.lit(None).cast("string"))
    label = F.when(F.col("_rule").isNotNull(), F.when(wanted == "block", 1.0).otherwise(0.0))
    model, suffixes, rate = fit(rows.select("_url", "_host", "_path", label.alias("label")))
    if model is None:
        scored = rows.withColumn("score", F.lit(rate))
    else:
        scored = model.transform(featured(rows, suffixes, rate)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], F.col("_host").alias("host"), F.col("_path").alias("path"),
                         F.col("_rule").alias("rule"), F.coalesce(wanted, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
