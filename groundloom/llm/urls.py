"""URL filter: host and path rules, and gradient-boosted trees on lexical features for what no rule covers."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import checked_broadcast, hash_sample, table, written

SAMPLE_URLS = 50_000       # labelled urls, about, on which the trees are fitted
TREES, DEPTH = 20, 4
PRIOR_URLS = 20.0          # weight, in urls, of the overall rate in the rate of a suffix

# Fixed values: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
FEATURES = [f"_f_{name}" for name in ("length", "host_length", "path_length", "depth", "labels", "digits", "signs", "entropy", "parameters",
            "query_length", "suffix_rate", "domain_rate")]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of a url. Without ``://`` all are empty, and so for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring({u}, instr({u}, '://') + 3)".format(u="_u"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
            F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, written host + path, and its verdict; null if none fits.

    A rule fits its host and its subdomains if the path begins with the rule's. The rules are a short list: each is one test.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` (_u, _host, _path, _query) with the features that need nothing but the url itself."""
    u, n = F.col("_u"), F.greatest(F.length("_u"), F.lit(1))
    chars = F.split(u, "")
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - F.when(c == "", 0.0).otherwise(
        (F.length(u) - F.length(F.replace(u, c, F.lit("")))) / n * F.log2((F.length(u) - F.length(F.replace(u, c, F.lit("")))) / n)))
    labels = F.split("_host", r"\.")
    return rows.select(
        "*", F.length(u).alias("_f_length"), F.length("_host").alias("_f_host_length"), F.length("_path").alias("_f_path_length"),
        F.size(F.filter(F.split("_path", "/"), lambda s: s != "")).alias("_f_depth"), F.size(labels).alias("_f_labels"),
        (F.length(F.regexp_replace(u, "[^0-9]", "")) / n).alias("_f_digits"),
        (F.length(F.regexp_replace(u, "[A-Za-z0-9]", "")) / n).alias("_f_signs"), entropy.alias("_f_entropy"),
        F.when(F.length("_query") == 0, 0).otherwise(F.size(F.split("_query", "&"))).alias("_f_parameters"),
        F.length("_query").alias("_f_query_length"),
        F.element_at(labels, -1).alias("_suffix"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
        .alias("_domain"))


def suffix_rates(labelled: DataFrame, key: str, base: float) -> DataFrame:
    """(key, rate) of blocked urls for each suffix, shrunk to the overall rate."""
    return labelled.groupBy(key).agg(((F.sum("label") + PRIOR_URLS * base) / (F.count(F.lit(1)) + PRIOR_URLS)).alias("rate"))


def judged(urls: DataFrame, url_col: str = "url", rules: list[tuple[str, str, str]] = RULES,
           sample: int = SAMPLE_URLS) -> DataFrame:
    """``urls`` with ``_host``, ``_path``, ``_rule``, ``_verdict`` and ``_score`` (probability of block by the trees).

    A rule's verdict is final and labels its urls; the trees learn from about ``sample`` of them, chosen by hash, and
    decide the rest. If only one verdict occurs among the labelled urls it is given to all; without any it is allow. A null
    url has empty host and path and is judged like an empty one. Extra columns stay.
    """
    known = urls.columns
    rows = urls.withColumn("_u", F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    host, path, query = parts(F.col("_u"))
    rows = rows.select("*", host.alias("_host"), path.alias("_path"), query.alias("_query"))
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    rows = rows.select("*", rule.alias("_rule"), verdict.alias("_by_rule"))
    totals = {r["_by_rule"]: r["count"] for r in rows.where("_by_rule IS NOT NULL").groupBy("_by_rule").count().collect()}
    keep = [*known, "_host", "_path", "_rule"]
    if len(totals) < 2:
        only = next(iter(totals), "allow")
        return rows.select(*keep, F.coalesce("_by_rule", F.lit(only)).alias("_verdict"), F.lit(None).cast("double").alias("_score"))
    every = sum(totals.values())
    base = totals["block"] / every
    rows = lexical(rows)
    labelled = rows.where("_by_rule IS NOT NULL").withColumn("label", (F.col("_by_rule") == "block").cast("double"))
    rates = {k: checked_broadcast(written(suffix_rates(labelled, k, base), "suffixes")) for k in ("_suffix", "_domain")}

    def featured(df: DataFrame) -> DataFrame:
        for k, name in (("_suffix", "_f_suffix_rate"), ("_domain", "_f_domain_rate")):
            df = df.join(rates[k].withColumnRenamed("rate", name), k, "left").fillna({name: base})
        return df

    # each verdict has its own sample, in proportion and of at least one url
    part = None
    for verdict, n in sorted(totals.items()):
        one = hash_sample(labelled.where(F.col("_by_rule") == verdict), F.col("_u"), max(sample * n // every, 1), n)
        part = one if part is None else part.unionByName(one)
    part = part.select("_suffix", "_domain", "label", *FEATURES[:-2])
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    train = vectors.transform(written(featured(part).select("label", *FEATURES), "labelled")).select("label", "_features")
    trees = GBTClassifier(featuresCol="_features", labelCol="label", predictionCol="_blocked", maxIter=TREES,
                          maxDepth=DEPTH, seed=1)
    model = trees.setProbabilityCol("_p").setRawPredictionCol("_raw").fit(train)
    scored = model.transform(vectors.transform(featured(rows)))
    by_trees = F.when(F.col("_blocked") == 1.0, "block").otherwise("allow")
    return scored.select(*keep, F.coalesce("_by_rule", by_trees).alias("_verdict"), vector_to_array("_p")[1].alias("_score"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of each row of ``pages``."""
    rows = judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return rows.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                       F.col("_verdict").alias("verdict"), F.col("_score").alias("score"))
