"""Labels by several labelers: reshaping, consensus and agreement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundloom.functions.cells import NO_CONSENSUS, check_exclusive, recode
from groundloom.operators.tables import rename_cols
from groundloom.scale import attach

# Fixed value: leading part of the merged labeler columns.
LABELER_PREFIX = "ceo-survey-user"


def merge_labelers(votes: DataFrame, by: Sequence[str], labelers: Sequence[str], labeler: str = "labeler",
                   vote: str = "vote", keep: Sequence[str] = (), prefix: str = LABELER_PREFIX) -> DataFrame:
    """One row per point of the first labeler, one column per labeler.

    Points that the first labeler did not see are left out, as in a chain of left joins, but
    one aggregation does it all.
    """
    base = F.col(labeler) == labelers[0]
    cols = [F.max(F.when(F.col(labeler) == who, F.col(vote))).alias(f"{prefix}{i}")
            for i, who in enumerate(labelers, start=1)]
    kept = [F.max(F.when(base, F.col(c))).alias(c) for c in keep]
    merged = votes.groupBy(*by).agg(F.bool_or(base).alias("_base"), *kept, *cols)
    return merged.where("_base").drop("_base")


def long_votes(wide: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Labeler columns back to one row per vote."""
    cells = F.array(*[F.struct(F.lit(c).alias("labeler"), F.col(f"`{c}`").alias("vote")) for c in cols])
    return wide.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*")


def vote_mode(votes: DataFrame, by: Sequence[str], vote: str = "vote") -> DataFrame:
    """Per point the most frequent vote (the smallest on a tie), its share and the number of votes.

    Missing votes do not count; a point without any vote gets NULL, 0 and 0.
    """
    per_label = votes.groupBy(*by, vote).agg(F.count(vote).alias("_n"))
    kind = dict(votes.dtypes)[vote]
    if kind in ("tinyint", "smallint", "int"):       # number and label in one long, which a hash aggregation can hold
        best = F.max(F.when(F.col("_n") > 0, F.shiftleft("_n", 32) + (F.lit(0x7FFFFFFF) - F.col(vote).cast("bigint"))))
        number, label = F.shiftright("_best", 32), (F.lit(0x7FFFFFFF) - F.col("_best").bitwiseAND(F.lit(0xFFFFFFFF))).cast(kind)
    else:
        best = F.max(F.when(F.col("_n") > 0, F.struct(F.col("_n").alias("n"), (-F.col(vote)).alias("neg"))))
        number, label = F.col("_best.n"), -F.col("_best.neg")
    agg = per_label.groupBy(*by).agg(best.alias("_best"), F.sum("_n").alias("count"))
    return agg.select(*by, label.alias("class"), F.coalesce(F.try_divide(number, F.col("count")), F.lit(0.0)).alias("confidence"),
                      "count")


def consensus(votes: DataFrame, by: Sequence[str], n_labelers: int, vote: str = "vote", strict: bool = True) -> DataFrame:
    """Points with a usable consensus label.

    Dropped are points whose share does not exceed one labeler's worth. With a single labeler
    that would drop every point; ``strict=False`` keeps them then.
    """
    modes = vote_mode(votes, by, vote).where(F.col("class").isNotNull())
    if n_labelers == 1 and not strict:
        return modes
    return modes.where(F.col("confidence") > 1.0 / n_labelers)


def label_mode_flag(votes: DataFrame, by: Sequence[str], vote: str = "vote") -> DataFrame:
    """Most frequent label of each point, -9999 where two or more labels tie for it."""
    per_label = (votes.where(F.col(vote).isNotNull()).groupBy(*by, vote).agg(F.count(F.lit(1)).alias("_n")))
    top = F.max(F.struct(F.col("_n").alias("n"), (-F.col(vote)).alias("neg")))
    low = F.max(F.struct(F.col("_n").alias("n"), F.col(vote).alias("pos")))
    both = per_label.groupBy(*by).agg(top.alias("_t"), low.alias("_l"))
    single = -F.col("_t.neg") == F.col("_l.pos")
    return both.select(*by, F.when(single, F.col("_l.pos")).otherwise(F.lit(NO_CONSENSUS)).alias("mode_label"))


def agreement_by_class(modes: DataFrame) -> DataFrame:
    """Mean confidence per consensus class."""
    return modes.groupBy("class").agg(F.avg("confidence").alias("mean_confidence"))


def labelers_list(df: DataFrame, col: str = "email") -> DataFrame:
    return df.select(col).distinct()


def process_labels(df: DataFrame, rename: Mapping[str, str], classes: Sequence[str], codes: Mapping[str, int],
                   keys: Sequence[str], keep: Sequence[str] = ("Lat", "Lon"), label: str = "labeler") -> DataFrame:
    """Survey rows to coded labels: check that one class is chosen, rename, recode, keep the needed columns.

    ``classes`` are the names after renaming; all files can go through it as one table.
    """
    old = [k for k, v in rename.items() if v in classes]
    checked = df.withColumns(check_exclusive(old))
    renamed = rename_cols(checked, rename)
    coded = renamed.withColumn("_label", recode(classes, codes))
    return coded.select(*keys, *keep, F.col("_label").alias(label))


def class_mean_impute(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Missing numbers become the mean of their class."""
    means = df.groupBy(by).agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    filled = attach(df, means, [by], "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(f"_m{i}")) for i, c in enumerate(cols)}).select(*df.columns)


def confusion_matrix(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """Rows predicted 0 and 1, columns actual 0 and 1; always two rows, also if a class was never predicted."""
    def cell(p: int, a: int) -> Column:
        return F.count_if((F.col(pred) == p) & (F.col(actual) == a)).alias(f"actual_{a}")

    counts = df.agg(*[F.struct(F.lit(p).alias("predicted"), cell(p, 0), cell(p, 1)).alias(f"p{p}") for p in (0, 1)])
    return counts.select(F.explode(F.array("p0", "p1")).alias("r")).select("r.*")


def overall_accuracy(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """Share of all rows predicted right."""
    right = F.count_if(F.col(pred) == F.col(actual))
    return df.agg((right / F.count(F.lit(1))).alias("accuracy"))
