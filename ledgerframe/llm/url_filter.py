"""URL filter: allow/block rules, and boosted trees for the URLs no rule fits.

Rules are ``(action, host/path)``.  A rule fits its host and all subdomains when
the URL's path starts with the rule's path; the longest one wins.  The remaining
URLs are judged by gradient-boosted trees (``pyspark.ml``, trained and applied
on the JVM) over lexical features: lengths, depth, digit ratio, character
entropy, parameter counts, label counts and statistics of the host's suffix.
The trees learn from labelled URLs, by default those a rule has judged.

Only DataFrame and ``pyspark.ml`` functions are used.

Defined cases: a URL that is NULL or has no ``://`` has an empty host and path,
no rule fits it, and the trees judge it by its other features; an empty table
gives an empty result; without both labels among the labelled URLs the one that
occurs (``allow`` if none) is the verdict; repeated rows get the same verdict;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored

#: Training rows at most: the labelled URLs with the smallest hashes, each URL once.
MAX_TRAINING = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ["url_chars", "host_chars", "path_chars", "query_chars", "depth", "labels", "digit_ratio",
           "host_digit_ratio", "hyphens", "params", "other_ratio", "entropy", "host_entropy", "https"]
SUFFIX = ["suffix_log_count", "suffix_params", "suffix_digits"]


def host_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.lit(2 ** 31 - 1))
    host = F.translate(F.regexp_extract(after, r"(?s)^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    after = F.substring(url, F.instr(url, "://") + 3, F.lit(2 ** 31 - 1))
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise("")


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct<rule, action> of the longest rule that fits, or NULL.  ``rules`` is a
    short list, kept in the plan as literals."""
    fits = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        rule_host, slash, rest = rule.partition("/")
        hit = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) \
            & F.startswith(path, F.lit(slash + rest))
        fits = F.when(hit, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))) \
            .otherwise(fits)
    return fits


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.char_length(text)
    each = F.transform(F.array_distinct(F.split(text, "")),
                       lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / n)
    bits = F.aggregate(each, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def kept_chars(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, pattern, ""))


def lexical_features(urls: DataFrame) -> DataFrame:
    """Adds the LEXICAL columns and ``suffix`` (last two host labels) to rows with
    url, host and path."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return urls.withColumns({
        "url_chars": F.char_length(url), "host_chars": F.char_length("host"),
        "path_chars": F.char_length("path"), "query_chars": F.char_length(query),
        "depth": kept_chars(F.col("path"), "[^/]"), "labels": F.size(F.split("host", r"\.")),
        "digit_ratio": ratio(kept_chars(url, "[^0-9]"), F.char_length(url)),
        "host_digit_ratio": ratio(kept_chars(F.col("host"), "[^0-9]"), F.char_length("host")),
        "hyphens": kept_chars(F.col("host"), "[^-]"),
        "params": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
        "other_ratio": ratio(kept_chars(url, "[A-Za-z0-9]"), F.char_length(url)),
        "entropy": entropy(url), "host_entropy": entropy(F.col("host")),
        "https": F.startswith(url, F.lit("https:")).cast("int"),
        "suffix": F.substring_index("host", ".", -2),
    })


def suffix_statistics(features: DataFrame) -> DataFrame:
    """One row per host suffix, over all URLs."""
    return features.groupBy("suffix").agg(
        F.log1p(F.count("*")).alias("suffix_log_count"), F.avg("params").alias("suffix_params"),
        F.avg("digit_ratio").alias("suffix_digits"))


def training_sample(labelled: DataFrame, limit: int = MAX_TRAINING) -> DataFrame:
    """Labelled URLs once each, those with the smallest hashes of every label, with a
    ``weight``: how many rows they stand for.  A label gets half the places at least,
    as far as it has URLs."""
    urls = stored(labelled.groupBy("url", "label").agg(F.count("*").alias("n_rows")), "url-labelled")
    found = {r["label"]: r["n"] for r in urls.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for label, n in sorted(found.items()):
        most = min(n, max(limit // 2, limit - sum(found.values()) + n))
        part = urls.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(most) \
            .withColumn("weight", F.col("n_rows") * F.lit(n / most))
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return labelled.limit(0).withColumn("weight", F.lit(1.0))
    rows = labelled.join(F.broadcast(picked.select("url", "weight")), "url").dropDuplicates(["url"])
    return rows.orderBy(F.xxhash64("url"), "url")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], url_col: str = "url",
               id_col: str = "page_id", labelled: DataFrame | None = None,
               trees: int = 8, depth: int = 4) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.  ``labelled``
    (url, verdict) replaces the rules' own verdicts as training labels."""
    url = col(url_col).cast("string")
    rows = pages.select(col(id_col).alias("page_id"), url.alias("url"),
                        host_of(F.coalesce(url, F.lit(""))).alias("host"),
                        path_of(F.coalesce(url, F.lit(""))).alias("path"))
    rows = rows.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    lexical = stored(lexical_features(rows), "url-features")
    suffixes = stored(suffix_statistics(lexical), "url-suffixes")
    features = lexical.join(suffixes, "suffix", "left")
    if labelled is None:
        taught = features.where(F.col("fit").isNotNull()).withColumn("taught", F.col("fit.action"))
    else:
        given = labelled.select(col("url").alias("url"), col("verdict").alias("taught")) \
            .dropDuplicates(["url"])
        taught = features.join(given, "url")
    taught = stored(training_sample(taught.withColumn("label", (F.col("taught") == "allow").cast("double"))
                                    .na.drop(subset=["label"])), "url-training")
    vector = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features", handleInvalid="keep")
    seen = sorted(r[0] for r in taught.select("label").distinct().collect())
    if len(seen) < 2:
        judged = features.withColumn("allowed", F.lit(seen[0] if seen else 1.0))
    else:
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, predictionCol="allowed", weightCol="weight",
                              maxBins=32, stepSize=0.3).fit(vector.transform(taught).coalesce(1))
        judged = model.transform(vector.transform(features))
    method = F.when(F.col("allowed") > 0.5, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce("fit.action", method).alias("verdict"))
