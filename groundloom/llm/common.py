"""Helpers shared by the operators: work tables, checked broadcasts, row keys, connected classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.session import work_path

LOOKUP_ROWS = 100_000
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands texts to Python in Arrow batches of 4 MB.

    The usual limit of 64 MB is held several times over by every task, in the executor and in its Python process. A limit
    that the session's owner has set stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES) in ("67108864b", "64m", "64MB"):
        conf.set(BATCH_BYTES, "4m")
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: what follows does not depend on lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, max_rows: int = LOOKUP_ROWS) -> DataFrame:
    """A written lookup of short rows, marked for broadcast only if it has at most ``max_rows`` rows.

    A larger one is joined by a shuffle, in which Spark splits skewed keys.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hash_sample(rows: DataFrame, of: Column, wanted: int, total: int | None = None) -> DataFrame:
    """About ``wanted`` of the rows, chosen by the hash of ``of``; of a table with rows at least those of the least hash.

    All 63 bits of the hash are compared, so the share may be as small as the table is large.
    """
    place = F.xxhash64(of).bitwiseAND(F.lit((1 << 63) - 1))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).first()
    return rows.where(place <= hash_limit(wanted, seen["n"] if total is None else total, seen["least"] or 0))


def hash_limit(wanted: int, total: int, least: int = 0) -> int:
    """The largest of the 63-bit hashes that about ``wanted`` of ``total`` rows do not exceed, but no less than ``least``."""
    return max(min((wanted << 63) // max(total, 1), (1 << 63) - 1), least)


def text_key(text: Column) -> Column:
    """16-byte key of a text; null for null."""
    return F.unhex(F.md5(text))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of each node of an undirected graph; label is the least node of its connected class.

    Every round takes the least label among the neighbours and then the label of that label, so long chains
    shorten quickly. Rounds are tables in the shared folder; hot nodes are combined before the shuffle.
    """
    both = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                   .unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node"))
                .agg(F.min("label").alias("near")))
        better = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                  F.least("label", "near").alias("label"))
        of = better.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = written(better.join(of, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("old <> label").isEmpty():
            return labels


def same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality on ``cols``."""
    out = F.lit(True)
    for c in cols:
        out = out & left[c].eqNullSafe(right[c])
    return out
