"""Shards by extendible hashing: a bucket of a hash prefix is split on one more bit until it fits the byte limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import written

SHARD_BYTES = 32 << 20
DIGITS_PER_ROUND = 5                     # hexadecimal: 20 bits, so at most 2^20 buckets are summed at a time
BITS = 4 * DIGITS_PER_ROUND
ADDRESS_DIGITS = 80


def address(id_: Column, text: Column) -> Column:
    """Hexadecimal address of a row: hash of the id, then of the text, then random digits drawn once for the row.

    The later digits matter only if rows of one id together exceed a shard: equal ids are told apart by their text, equal
    rows by chance. Null counts as empty.
    """
    return F.concat(F.md5(F.coalesce(id_.cast("string"), F.lit(""))), F.md5(F.coalesce(text, F.lit(""))),
                    F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 17, 16))


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """(id, shard, depth, n_bytes) of each row of ``docs``: ``shard`` is the prefix of ``depth`` bits of its bucket.

    A bucket is split as long as its texts have more than ``limit`` bytes of UTF-8; only the halves of such a bucket get
    the next bit. A single row above the limit is a shard of its own. Each round sums the bytes per prefix of 20 more
    bits and reads off from these sums how deep each bucket goes; only rows of buckets that are still too large go on.
    The addresses are a written table, so a task that runs again finds the same ones.
    """
    rows = docs.select(F.col(id_col).alias("doc"), address(F.col(id_col), F.col(text_col).cast("string")).alias("address"),
                       F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"))
    rows = written(rows, "addresses").withColumn("outer", F.lit(""))
    out = None
    for done in range(0, ADDRESS_DIGITS, DIGITS_PER_ROUND):
        rows = rows.withColumn("leaf", F.conv(F.substring("address", done + 1, DIGITS_PER_ROUND), 16, 10).cast("bigint"))
        leaves = written(rows.groupBy("outer", "leaf").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")), "leaves")
        levels = leaves.select("*", F.explode(F.sequence(F.lit(0), F.lit(BITS))).alias("d"))
        levels = levels.withColumn("at", F.expr(f"shiftright(leaf, {BITS} - d)"))
        fitting = (levels.groupBy("outer", "d", "at").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
                   .where((F.col("b") <= limit) | (F.col("n") == 1)).select("outer", "d", "at"))
        depth = levels.join(fitting, ["outer", "d", "at"]).groupBy("outer", "leaf").agg(F.min("d").alias("d"))
        directory = written(leaves.select("outer", "leaf").join(depth, ["outer", "leaf"], "left"), "directory")
        found = rows.join(directory, ["outer", "leaf"])
        bits = F.lpad(F.conv(F.expr(f"shiftright(leaf, {BITS} - coalesce(d, {BITS}))").cast("string"), 10, 2),
                      F.coalesce(F.col("d"), F.lit(BITS)), F.lit("0"))
        found = found.withColumn("shard", F.concat("outer", bits))
        fits = found.where("d IS NOT NULL").select("doc", "shard", F.length("shard").alias("depth"), "n_bytes")
        out = fits if out is None else out.unionByName(fits)
        if directory.where("d IS NULL").isEmpty():
            return out.withColumnRenamed("doc", id_col)
        rows = found.where("d IS NULL").select("doc", "address", "n_bytes", F.col("shard").alias("outer"))
    rest = rows.select("doc", F.col("outer").alias("shard"), F.length("outer").alias("depth"), "n_bytes")
    return out.unionByName(rest).withColumnRenamed("doc", id_col)


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of each row of ``documents``."""
    return shards(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))


OP8_SQL = f"""
WITH v AS (SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 10)) AS BIGINT) AS a,
  coalesce(strlen(text), 0) AS n_bytes FROM documents),
l AS (SELECT doc_id, n_bytes, d, a >> (40 - d) AS k FROM v, (SELECT unnest(range(0, 41)) AS d)),
s AS (SELECT d, k FROM l GROUP BY d, k HAVING sum(n_bytes) <= {SHARD_BYTES} OR count(*) = 1),
f AS (SELECT doc_id, n_bytes, min(d) AS d, max_by(k, -d) AS k FROM l JOIN s USING (d, k) GROUP BY doc_id, n_bytes)
SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE lpad(bin(k), CAST(d AS INTEGER), '0') END AS shard, CAST(d AS INTEGER) AS depth,
  CAST(n_bytes AS BIGINT) AS n_bytes FROM f
"""
