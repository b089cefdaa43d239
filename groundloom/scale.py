"""Joins, numbering and quantiles that stay balanced when one key holds much of the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from groundloom.session import checkpointed

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
MAX_GROUP_ROWS = 2_000_000
HOT_KEY_ROWS = 5_000_000
SALTS = 64


def _bytes_of(value: Column, kind: DataType) -> Column:
    """About how many bytes a value takes; texts and lists by their length, structs by their fields."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (StringType, BinaryType, ArrayType, StructType, MapType)):
            each = F.transform(value, lambda x: _bytes_of(x, kind.elementType).cast("bigint"))
            return F.coalesce(F.aggregate(each, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)) + 8
        return F.coalesce(F.size(value), F.lit(0)) * 8 + 8
    if isinstance(kind, MapType):
        return (_bytes_of(F.map_keys(value), ArrayType(kind.keyType))
                + _bytes_of(F.map_values(value), ArrayType(kind.valueType)))
    if isinstance(kind, StructType):
        return sum((_bytes_of(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows that take at most about ``max_bytes`` bytes together."""
    row = sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0))
    n, size = df.select(row.cast("bigint").alias("_size")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum("_size")).first()
    return n <= max_rows and (size or 0) <= max_bytes


def dealt(df: DataFrame, work: Column, per_task: int) -> DataFrame:
    """The rows dealt over as many tasks as they have ``work`` in all, ``per_task`` each.

    A table of few bytes is read by one task, however much its rows grow into in the next step.
    """
    tasks = math.ceil((df.agg(F.sum(work)).first()[0] or 0) / per_task)
    return df.repartition(tasks) if tasks > 1 else df


def shuffled_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join that shuffles both sides, whatever sizes Spark expects of them.

    It expects them from the bytes of the files read. Where steps make many rows of a table of few bytes, a side that is far
    too large for the driver would be broadcast.
    """
    return left.join(right.hint("merge"), list(on), how)


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """Equi join that spreads every key of ``big`` over ``salts`` tasks.

    ``small`` is repeated once per salt. The salt is a hash of the row, so a task that runs
    again routes its rows as before. Valid for inner, left, left_semi and left_anti.
    """
    on = list(on)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]),
                                          F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return shuffled_join(left, right, [*on, "_salt"], how).drop("_salt")


def skew_join(big: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner",
              hot_rows: int = HOT_KEY_ROWS, salts: int = SALTS) -> DataFrame:
    """Equi join of two large tables in which only the keys with many rows in ``big`` are salted.

    A key counts as hot above ``hot_rows`` rows, so there are few of them. Without any it is an
    ordinary shuffle join. Valid for inner, left, left_semi and left_anti.
    """
    on = list(on)
    hot = checkpointed(big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*on))
    if hot.isEmpty():
        return shuffled_join(big, other, on, how)
    hot = F.broadcast(hot)                                  # at most rows of big / hot_rows
    usual = shuffled_join(big.join(hot, on, "left_anti"), other, on, how)
    return usual.unionByName(salted_join(big.join(hot, on, "left_semi"), other.join(hot, on, "left_semi"),
                                         on, how, salts))


def attach(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
           max_rows: int = BROADCAST_ROWS, derived: bool = True, few_rows_each: bool = False) -> DataFrame:
    """Join a lookup (per class, frame, tile or point) onto a large table.

    The lookup is counted. Within ``max_rows`` and ``BROADCAST_BYTES`` it is broadcast, so ``big`` is not shuffled; above
    that both sides are shuffled and hot keys salted. A ``derived`` lookup is written once
    before, so that counting it does not compute it twice. With ``few_rows_each`` every key occurs a few times in
    ``big``, as pixels do, and hot keys are not looked for.
    """
    if derived:
        small = checkpointed(small)
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), list(on), how)
    return shuffled_join(big, small, on, how) if few_rows_each else skew_join(big, small, on, how)


def shuffle_key(seed: int, *cols: str) -> Column:
    """A reproducible random order: MD5 of the seed and the identifying columns."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def number_by_hash(df: DataFrame, key: str, ties: Sequence[str], out: str = "pos",
                   start: int = 0) -> DataFrame:
    """Consecutive numbers in the order of the hexadecimal hash ``key``, without a global sort.

    Rows are counted per hash prefix (at most 16^4 of them, which bounds the broadcast), the
    counts become offsets, and each prefix is numbered by itself.
    """
    rows = df.withColumn("_prefix", F.substring(key, 1, 4))
    counts = rows.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_prefix", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_prefix").orderBy(key, *ties)
    return (rows.join(F.broadcast(offsets), "_prefix")
            .withColumn(out, F.row_number().over(within) + F.col("_off") + F.lit(start - 1).cast("bigint"))
            .drop("_prefix", "_off"))


def first_by_hash(df: DataFrame, by: str, key: str, ties: Sequence[str], sizes: DataFrame,
                  size_col: str) -> DataFrame:
    """The first n rows of each ``by`` value in hash order, n taken from ``sizes``.

    A histogram over 16^5 hash prefixes gives the last prefix each class needs. All rows of the prefixes before it are
    taken; within it as many as are still wanted. Rows are ranked per class and prefix, so a class that wants very many
    rows is spread over many tasks.
    """
    rows = df.withColumn("_prefix", F.substring(key, 1, 5))
    hist = rows.groupBy(by, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (hist.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
            .join(F.broadcast(sizes.select(by, F.col(size_col).cast("bigint").alias("_size")))
                  if is_small(sizes) else sizes.select(by, F.col(size_col).cast("bigint").alias("_size")), by)
            .where("_before < _size")
            .groupBy(by).agg(F.max("_prefix").alias("_cut"), (F.max("_size") - F.max("_before")).alias("_left")))
    picked = attach(rows, cuts, [by]).where("_prefix <= _cut")
    rank = Window.partitionBy(by, "_prefix").orderBy(key, *ties)
    return (picked.withColumn("_rank", F.row_number().over(rank)).where("_prefix < _cut OR _rank <= _left")
            .drop("_prefix", "_cut", "_left", "_rank"))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """Per key, the running total ``upto`` of ``weight`` in ``order`` and the key's ``total``.

    Range partitioning on keys and order splits a large key over many tasks; the partition sums
    then give every piece its offset. (keys, order) must identify a row.
    """
    keys, order = list(keys), list(order)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = checkpointed(df.repartitionByRange(parts, *keys, *order)
                          .withColumn("_piece", F.spark_partition_id()))
    sums = pieces.groupBy(*keys, "_piece").agg(F.sum(weight).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_piece",
                          F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
                          F.sum("_sum").over(Window.partitionBy(*keys)).alias("total"))
    inside = (Window.partitionBy(*keys, "_piece").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (attach(pieces, offsets, [*keys, "_piece"])
            .withColumn("upto", F.sum(weight).over(inside) + F.col("_before"))
            .drop("_piece", "_before"))


def ranked_quantiles(df: DataFrame, keys: list[str], value: str, probs: Sequence[float],
                     names: Sequence[str]) -> DataFrame:
    """Exact quantiles per group, ranked over many tasks; ``value`` has no NULLs."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_w"))
    ranks = running_totals(counts, keys, [value], "_w")
    aggs = []
    for p, name in zip(probs, names):
        at = F.lit(float(p)) * (F.col("total") - 1)

        def pick(pos: Column) -> Column:
            return F.max(F.when((pos < F.col("upto")) & (pos >= F.col("upto") - F.col("_w")), F.col(value)))

        low, high = pick(F.floor(at)), pick(F.ceil(at))
        aggs.append((low + F.max(at - F.floor(at)) * (high - low)).alias(name))
    return ranks.groupBy(*keys).agg(*aggs)


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                      names: Sequence[str], max_group: int = MAX_GROUP_ROWS) -> DataFrame:
    """Exact quantiles per group with linear interpolation, NULLs left out.

    Groups of at most ``max_group`` rows use the built-in ``percentile``. Larger groups are
    ranked over many tasks instead, so none has to fit into one.
    """
    keys = list(keys)
    vals = df.where(F.col(value).isNotNull()).select(*keys, value)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.percentile(value, float(p)).alias(n) for p, n in zip(probs, names)])

    large = checkpointed(vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                         .where(F.col("_n") > max_group).select(*keys))
    if large.isEmpty():
        return plain(vals)
    return plain(attach(vals, large, keys, "left_anti")).unionByName(
        ranked_quantiles(attach(vals, large, keys, "left_semi"), keys, value, probs, names))
