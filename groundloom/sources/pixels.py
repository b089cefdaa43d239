"""Pixel tables as Parquet, one folder per tile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 512


def write_pixel_table(df: DataFrame, path: str, keys: Sequence[str] = ("h", "v"), mode: str = "overwrite",
                      rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write a stack or prediction by tile, band order kept.

    A tile goes to several files of whole pixel rows, so a large tile is not one task, and the
    row ranges in the file statistics let a reader skip files.
    """
    band = F.floor(F.col("pr") / F.lit(float(rows_per_file)))
    (df.repartition(*keys, band).sortWithinPartitions(*keys, "pr", "pc")
     .write.mode(mode).partitionBy(*keys).parquet(path))


def read_pixel_table(spark: SparkSession, path: str, bands: Sequence[str] | None = None,
                     keys: Sequence[str] = ("h", "v")) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*keys, "pr", "pc", *bands) if bands else df
