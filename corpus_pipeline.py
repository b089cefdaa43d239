"""From raw documents to token counts: quality, near-duplicates, benchmark passages, secrets, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm import bpe, decontam, neardup, quality, secrets
from groundloom.llm.common import table, written


def drop_faulty(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably of low quality or toxic go.

    A document without label, site or text is judged by what there is; a null or empty text has only its length as evidence.
    Very long texts are read whole. Repeated rows get the same decision, as do ties at the limit, which go. An empty table
    stays empty. Extra columns stay as they are.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one of least id, of equal ids the one of least text hash.

    Rows that repeat id and text are one document. Documents with a null text all stay; equal empty or short texts are
    one class. Very long texts are compared whole. An empty table stays empty. Extra columns stay as they are.
    """
    return neardup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go.

    Null and empty texts have no words and stay, as does everything if there are no items. Very long texts are searched
    whole. Rows that agree in id and text, null ids too, share their decision. An empty table stays empty. Extra columns stay.
    """
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; ``n_chars``, which the documents have, follows.

    No row goes. A null text stays null, with a null count, and an empty one empty. Very long texts are searched whole,
    overlapping spans are replaced once, and repeated rows change alike. An empty table stays empty. Extra columns stay.
    """
    clean = secrets.redacted(docs, secrets.model_scores(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of what is left.

    One row for each row, repeated ones too; null and empty texts have no tokens and the digests of an empty text. Very
    long texts are encoded whole. An empty table gives an empty result. Extra columns are not read.
    """
    return bpe.encode(docs, bpe.public_vocabulary(), digests=True)


STAGES = [
    ("quality", drop_faulty),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("bpe", encode_texts),
]

#: The classifier, the signatures and the merges can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over all documents; each stage's result is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
