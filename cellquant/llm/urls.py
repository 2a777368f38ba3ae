"""URL filters: host and path rules (longest wins), and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellquant.llm.common import ascii_lower, materialize

#: (verdict, host, path)
Rule = tuple[str, str, str]
FEATURES = (
    "url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "entropy", "params", "hyphens", "has_fragment",
    "has_query", "is_https", "suffix_log_count", "suffix_block_share", "domain_block_share", "segment_block_share",
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if null or without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def match_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add rule (``host/path`` of the longest rule that fits, else null) and rule_verdict to rows with host and path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def _count(c: Column, what: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))


def _entropy(c: Column) -> Column:
    """Shannon entropy in bits of the characters."""
    n = F.length(c)
    each = F.transform(F.array_distinct(F.split(c, "")), lambda x: (n - F.length(F.replace(c, x, F.lit("")))) / n)
    return F.when(n > 0, F.aggregate(F.filter(each, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))).otherwise(0.0)


def lexical_features(pages: DataFrame) -> DataFrame:
    """Add the features that one URL gives by itself, and its suffix (last host label), domain (last two) and the first
    segment of its path."""
    u, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    as_double = {
        "url_len": F.length(u),
        "host_len": F.length(host),
        "path_len": F.length(path),
        "depth": _count(path, "/"),
        "labels": F.size(labels),
        "digit_ratio": F.length(F.regexp_replace(u, "[^0-9]", "")) / F.greatest(F.length(u), F.lit(1)),
        "entropy": _entropy(u),
        "params": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "hyphens": _count(host, "-"),
        "has_fragment": F.contains(u, F.lit("#")).cast("int"),
        "has_query": F.contains(u, F.lit("?")).cast("int"),
        "is_https": F.startswith(u, F.lit("https:")).cast("int"),
    }
    return pages.withColumns({k: v.cast("double") for k, v in as_double.items()}).withColumns(
        {"suffix": F.element_at(labels, -1), "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), "."), "segment": F.regexp_extract(path, "^/([^/]*)", 1)}
    )


FOLDS = 5


def _suffix_stats(rows: DataFrame, key: str, prior: float, prior_weight: float) -> DataFrame:
    """Per suffix: how many URLs, and of each fold the smoothed share of block among the labelled URLs of the other folds
    (under -1: of all), so that no URL's own label is in what the trees learn from. A suffix without labels has the prior."""
    by_fold = rows.groupBy(key, "fold").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("labelled"), F.count_if(F.col("known") == "block").alias("blocked"))
    total = F.struct(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    each = by_fold.groupBy(key).agg(total.alias("t"), F.collect_list(F.struct("fold", "labelled", "blocked")).alias("folds"))  # at most FOLDS

    def share(blocked: Column, labelled: Column) -> Column:
        return (blocked + prior * prior_weight) / (labelled + prior_weight)

    shares = F.transform("folds", lambda f: F.struct(f.fold.alias("fold"), share(F.col("t.blocked") - f.blocked, F.col("t.labelled") - f.labelled).alias("share")))
    whole = F.array(F.struct(F.lit(-1).alias("fold"), share(F.col("t.blocked"), F.col("t.labelled")).alias("share")))
    return each.select(key, F.log1p(F.col("t.n").cast("double")).alias(f"{key}_log_count"), F.map_from_entries(F.concat(shares, whole)).alias(f"{key}_shares"))


def judge_urls(
    pages: DataFrame, rules: list[Rule], *, max_train_rows: int = 20_000, rounds: int = 10, depth: int = 4, prior_weight: float = 20.0, hidden_fold: int | None = None
) -> DataFrame:
    """page_id, host, path, rule, verdict and p_block of every URL.

    URLs that a rule fits are the labelled ones: a bounded sample of them (``max_train_rows``, by hash order) trains
    boosted trees, whose verdict holds where no rule fits. Suffix statistics cover every row; a labelled row takes them
    from other folds than its own. The labels of a ``hidden_fold`` are not used at all, to measure the trees on them.

    Null URLs and those without ``://`` have empty host and path and get the trees' verdict. With labels of one class, or
    none, there is no model: p_block is that class (allow if none). Repeated rows each get a row; page_id may be null or
    repeat; other columns are ignored; an empty table gives an empty result.
    """
    rows = lexical_features(match_rules(pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}), rules))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int"))
    rows = rows.withColumn("known", F.when(F.col("fold") != (-1 if hidden_fold is None else hidden_fold), F.col("rule_verdict")))
    seen = rows.agg(F.count("known").alias("labelled"), F.count_if(F.col("known") == "block").alias("blocked")).first()
    prior = (seen["blocked"] + 1) / (seen["labelled"] + 2)
    for key in ("suffix", "domain", "segment"):  # a frequent key's URLs stay on the large side, whose skewed partitions adaptive execution splits
        own = F.when(F.col("known").isNotNull(), F.col("fold")).otherwise(-1)
        rows = rows.join(_suffix_stats(rows, key, prior, prior_weight), key, "left")
        rows = rows.withColumn(f"{key}_block_share", F.coalesce(F.try_element_at(f"{key}_shares", own), F.lit(prior))).drop(f"{key}_shares")
    labelled = rows.where(F.col("known").isNotNull()).select(*FEATURES, (F.col("known") == "block").cast("double").alias("y"), "url", "page_id")
    sample = materialize(labelled.orderBy(F.xxhash64("url"), "url", "page_id").limit(max_train_rows).select(*FEATURES, "y"), "url-sample")
    classes = sorted(r["y"] for r in sample.select("y").distinct().collect())  # at most two
    if len(classes) == 2:
        assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="x")
        model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=rounds, maxDepth=depth, seed=7, checkpointInterval=-1).fit(assemble.transform(sample).select("x", "y"))
        rows = model.transform(assemble.transform(rows)).withColumn("p_block", vector_to_array("probability")[1])
    else:
        rows = rows.withColumn("p_block", F.lit(classes[0] if classes else 0.0))
    verdict = F.coalesce("rule_verdict", F.when(F.col("p_block") > 0.5, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
