"""Point, label and shot tables as delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_points(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """Delimited text with a header and a declared schema; quoted fields may hold the delimiter."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("escape", '"')
            .option("nullValue", "NA").csv(path))


def format_floats(df: DataFrame, float_format: str = "%f") -> DataFrame:
    return df.select(*[F.when(F.col(c).isNotNull(), F.format_string(float_format, c)).alias(c)
                       if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def write_points(df: DataFrame, path: str, float_format: str | None = "%f", mode: str = "errorifexists") -> None:
    """Delimited text with a header and without an index; floats in a fixed format."""
    out = format_floats(df, float_format) if float_format else df
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)
