"""Line dedup: normalised lines are exploded and hashed, documents are counted per hash, and lines of a hash that enough
documents share are dropped everywhere but in the first of these documents. Texts are put together again by position.

The counting and the flags work on 16-byte hashes; the texts themselves are shuffled once, only to meet their dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import checked_broadcast, table, written

LEAST_CHARS = 10
LEAST_DOCS = 2
# The white space that is stripped from a line.
BLANKS = " \t\n\x0b\x0c\r"
HOT_DOCS = 1_000_000
SALTS = 64


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, other characters as they are. Plain ASCII takes the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _hashes(value: Column, tag: str) -> list[Column]:
    """128 bits of hash in two numbers, the second with a seed of its own."""
    return [F.xxhash64(value).alias(f"{tag}1"), F.xxhash64(F.lit(0x5EED), value).alias(f"{tag}2")]


def hashed_lines(rows: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc, t1, t2, pos, k1, k2) of every line of ``rows`` (doc, text, t1, t2) whose key is long enough."""
    lines = rows.select("doc", "t1", "t2", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = lines.select("doc", "t1", "t2", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= least_chars).select("doc", "t1", "t2", "pos", *_hashes(F.col("key"), "k"))


def dropped_positions(rows: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
                      hot_docs: int = HOT_DOCS) -> DataFrame:
    """(doc, t1, t2, dropped): the ascending positions of the lines that each text loses; texts that lose none are absent.

    Lines of the hashes that more than ``hot_docs`` documents share are dealt over ``SALTS`` tasks per hash.
    """
    lines = hashed_lines(rows, least_chars)
    nameless = F.max(F.col("doc").isNull().cast("int"))            # rows without id: one document, the last
    owned = written(lines.groupBy("k1", "k2").agg((F.count_distinct("doc") + nameless).alias("n"), F.min("doc").alias("keeper"))
                    .where((F.col("n") >= least_docs) & F.col("keeper").isNotNull()), "shared_lines")
    hot = checked_broadcast(owned.where(F.col("n") > hot_docs).select("k1", "k2", F.lit(SALTS).alias("salts")))
    dealt = (owned.join(hot, ["k1", "k2"], "left")
             .select("k1", "k2", "keeper", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")))
    salted = (lines.join(hot, ["k1", "k2"], "left")
              .withColumn("salt", F.pmod(F.xxhash64("doc", "t1"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts"))
    lost = salted.join(dealt, ["k1", "k2", "salt"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return (lost.select("doc", "t1", "t2", "pos").groupBy("doc", "t1", "t2")
            .agg(F.sort_array(F.collect_set("pos")).alias("dropped")))


def kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped positions (ascending), cut out stretch by stretch."""
    stretches = F.transform(F.sequence(F.lit(0), F.size(dropped)), lambda j: F.slice(
        lines, F.coalesce(F.get(dropped, j - 1), F.lit(-1)) + 2,
        F.coalesce(F.get(dropped, j), F.size(lines)) - F.coalesce(F.get(dropped, j - 1), F.lit(-1)) - 1))
    return F.flatten(stretches)


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least_chars: int = LEAST_CHARS,
                least_docs: int = LEAST_DOCS, hot_docs: int = HOT_DOCS) -> DataFrame:
    """(id_col, n_lines, n_dropped, kept): each text without the lines that an earlier document has.

    A line's key is the line without white space at its ends, A-Z lower-cased. A key of at least ``least_chars`` characters
    that at least ``least_docs`` documents hold loses all its lines except in the document of least id; there all stay.
    Null and empty texts are one empty line. Rows of one id are one document, whose texts are treated alike; repeated rows give
    repeated results. Rows without id are one document that comes after all others. A text may have any length; other
    columns are not read, whatever their names. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), text.alias("text")).select("doc", "text", *_hashes(F.col("text"), "t"))
    lost = dropped_positions(rows, least_chars, least_docs, hot_docs)
    lost = lost.withColumnsRenamed({"doc": "of", "t1": "x1", "t2": "x2"})
    both = rows.join(lost, F.col("doc").eqNullSafe(F.col("of")) & (F.col("t1") == F.col("x1")) & (F.col("t2") == F.col("x2")), "left")
    lines = F.split("text", "\n")
    return both.select(
        F.col("doc").alias(id_col), F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(kept_lines(lines, F.col("dropped")), "\n"))
        .alias("kept"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and a digest of what is kept, for each row of ``documents``."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= {LEAST_CHARS} GROUP BY key
      HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
f AS (SELECT k.*, coalesce(s.keeper <> k.doc_id, false) AS lost FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""
