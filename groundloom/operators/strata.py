"""Strata statistics, sample sizes, stratified samples and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundloom.scale import attach, first_by_hash, number_by_hash, shuffle_key


def class_histogram(px: DataFrame, cat: str = "cat") -> DataFrame:
    """Pixels per class."""
    return px.where(F.col(cat).isNotNull()).groupBy(cat).agg(F.count(F.lit(1)).alias("pixel_ct"))


def histogram_summary(hist: DataFrame, cat: str = "cat") -> DataFrame:
    """One row: total pixels, smallest and largest class, number of classes."""
    return hist.agg(F.sum("pixel_ct").alias("total_area"), F.min(cat).alias("category_min"),
                    F.max(cat).alias("category_max"), F.count(cat).alias("n_categories"))


def consolidate(strata: DataFrame, absence: Sequence[int], presence: Sequence[int], cat: str = "cat",
                names: Sequence[str] = ("Absence", "Presence")) -> DataFrame:
    """Classes folded into absence 0 and presence 1, with pixel count, share in percent and source classes."""
    binary = (F.when(F.col(cat).isin(list(absence)), 0).when(F.col(cat).isin(list(presence)), 1))
    sums = (strata.where(F.col(cat).isin([*absence, *presence])).groupBy(binary.alias(cat))
            .agg(F.sum("pixel_ct").alias("pixel_ct")))
    total = sums.agg(F.sum("pixel_ct").alias("_total"))
    joined = sums.join(F.broadcast(total))                      # one row
    is_absence = F.col(cat) == 0
    return joined.select(
        cat, "pixel_ct", F.bround(F.col("pixel_ct") * 100 / F.col("_total"), 3).alias("pct_area"),
        F.when(is_absence, names[0]).otherwise(names[1]).alias("class_name"),
        F.when(is_absence, ",".join(map(str, absence))).otherwise(",".join(map(str, presence))).alias("source_classes"))


def _lookup(values: Mapping[int, float], cat: str) -> Column:
    """Value by class id from a small set of settings."""
    col = F.lit(None)
    for k, v in values.items():
        col = F.when(F.col(cat) == k, F.lit(v)).otherwise(col)
    return col


def size_manual(strata: DataFrame, sizes: Mapping[int, int], cat: str = "cat") -> DataFrame:
    """Given sample size per class."""
    return strata.withColumn("nh_adjusted", _lookup(sizes, cat).cast("int"))


def size_required(strata: DataFrame, required: Mapping[int, float], share: Mapping[int, float],
                  cat: str = "cat") -> DataFrame:
    """Required number over the share expected to be of the class, rounded half to even."""
    return strata.withColumn("nh_adjusted", F.rint(_lookup(required, cat).cast("double")
                                                   / _lookup(share, cat).cast("double")).cast("int"))


def z_score(confidence: float) -> float:
    """Two-sided standard normal quantile."""
    return NormalDist().inv_cdf(1 - (1 - confidence) / 2)


def size_stehman_foody(strata: DataFrame, moe: float, confidence: float, minimum: int,
                       accuracy: float | Mapping[int, float], cat: str = "cat") -> DataFrame:
    """Sample size per class from the margin of error of its accuracy."""
    p = _lookup(accuracy, cat).cast("double") if isinstance(accuracy, Mapping) else F.lit(float(accuracy))
    z = z_score(confidence)
    return (strata.withColumn("p", p)
            .withColumn("nh", (F.lit(z * z) * F.col("p") * (1 - F.col("p")) / (moe * moe)).cast("int"))
            .withColumn("nh_adjusted", F.greatest("nh", F.lit(minimum))))


def size_olofsson(strata: DataFrame, moe: float, confidence: float, minimum: int, target: int,
                  accuracy: Mapping[int, float], cat: str = "cat") -> DataFrame:
    """Sample size from the target standard error of the class of interest, shared out by area."""
    rows = (strata.withColumn("qh", _lookup(accuracy, cat).cast("double"))
            .withColumn("wh", F.col("pct_area") / 100)
            .withColumn("SDh", F.sqrt(F.col("qh") * (1 - F.col("qh"))))
            .withColumn("SDh_x_wh", F.col("SDh") * F.col("wh")))
    totals = rows.agg(F.sum("SDh_x_wh").alias("_sd"),
                      F.max(F.when(F.col(cat) == target, F.col("pct_area"))).alias("_pct"))
    se = F.lit(float(moe)) * (F.col("_pct") / 100 / z_score(confidence))
    return (rows.join(F.broadcast(totals))                      # one row
            .withColumn("nh", (F.col("wh") * F.pow(F.col("_sd") / se, F.lit(2))).cast("int"))
            .withColumn("nh_adjusted", F.greatest("nh", F.lit(minimum))).drop("_sd", "_pct"))


def scale_for_training(strata: DataFrame, proportion: float) -> DataFrame:
    """Sample enlarged so that the reference part is ``proportion`` of it."""
    if not 0.01 <= proportion <= 1:
        raise ValueError("the reference sample is between 1% and all of the sample")
    return strata.withColumn("nh_adjusted", (F.col("nh_adjusted") / F.lit(float(proportion))).cast("int"))


def distribute_sample(binary: DataFrame, multi: DataFrame, absence: Mapping[int, float],
                      presence: Mapping[int, float], cat: str = "cat") -> DataFrame:
    """Binary sample sizes shared out to the classes by weight, truncated."""
    for weights in (absence, presence):
        if abs(sum(weights.values()) - 1) > 1e-9:
            raise ValueError("the weights of a group must add up to 1")
    weights = {**absence, **presence}
    group = F.when(F.col(cat).isin(list(absence)), 0).when(F.col(cat).isin(list(presence)), 1)
    wanted = multi.withColumn("_bin", group).where(F.col("_bin").isNotNull())
    sized = attach(wanted, binary.select(F.col(cat).alias("_bin"), "nh_adjusted"), ["_bin"])
    share = (F.col("nh_adjusted") * _lookup(weights, cat).cast("double")).cast("int")
    return sized.withColumn("nh_final", share).drop("_bin", "nh_adjusted")


def fill_categories(strata: DataFrame, cat: str = "cat", size: str = "nh_final") -> DataFrame:
    """Every class id from the smallest to the largest, with size 0 where it is absent."""
    span = strata.agg(F.min(cat).alias("_a"), F.max(cat).alias("_b"))
    ids = span.select(F.explode(F.sequence("_a", "_b")).alias(cat))
    return ids.join(strata, cat, "left").withColumn(size, F.coalesce(F.col(size), F.lit(0)).cast("int"))


def stratified_sample(px: DataFrame, sizes: DataFrame, seed: int, ident: Sequence[str], cat: str = "cat",
                      size: str = "nh_final") -> DataFrame:
    """Seeded random sample with the wanted number per class, all pixels of a class that has fewer."""
    keyed = px.withColumn("_key", shuffle_key(seed, *ident))
    return first_by_hash(keyed, cat, "_key", ident, sizes, size).drop("_key")


def shuffle_and_number(df: DataFrame, seed: int, ident: Sequence[str], start: int = 0, out: str = "PLOTID") -> DataFrame:
    """Seeded random order with consecutive numbers."""
    return number_by_hash(df.withColumn("_key", shuffle_key(seed, *ident)), "_key", ident, out, start).drop("_key")


def train_val_test_split(df: DataFrame, shares: tuple[float, float, float], seed: int, ident: Sequence[str]) -> DataFrame:
    """Seeded split with exact sizes; training and validation truncated, the rest is the test part."""
    if abs(sum(shares) - 1) >= 1e-9:
        raise ValueError("the shares must add up to 1")
    totals = df.agg(F.count(F.lit(1)).alias("_n"))
    placed = shuffle_and_number(df, seed, ident, 0, "_pos").join(F.broadcast(totals))     # one row
    n_train = F.floor(F.col("_n") * float(shares[0]))
    n_val = F.floor(F.col("_n") * float(shares[1]))
    usage = (F.when(F.col("_pos") < n_train, "train").when(F.col("_pos") < n_train + n_val, "validate")
             .otherwise("map_reference/test"))
    return placed.withColumn("usage", usage).drop("_pos", "_n")


def split_counts(df: DataFrame, col: str = "usage") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
