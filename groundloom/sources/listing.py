"""Tables of files and of submitted jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_catalog(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, name and length of the files under a prefix; their contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
             .load(path))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def read_catalog_json(spark: SparkSession, path: str, value_schema: str, key: str = "job_id",
                      by_line: bool = False) -> DataFrame:
    """Job table from JSON that maps a job id to its parameters: one document per file or per line."""
    docs = spark.read.text(path, wholetext=not by_line)
    jobs = docs.select(F.explode(F.from_json("value", f"map<string, struct<{value_schema}>>")).alias(key, "_p"))
    return jobs.select(key, "_p.*")
