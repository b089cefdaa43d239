"""Benchmark decontamination by a prefix-filtered set join of word shingles, verified over item-sized windows.

An item's windows are its runs of ``WINDOW`` words (the whole item if it is shorter). A window is a set of positioned
shingles of ``SHINGLE`` words. Shingles are ordered by rarity in the documents; since a window has to be contained
whole, a prefix of one shingle, its rarest, is necessary, and only that one is joined. A joined pair gives the place where
the window would begin, which has to lie inside the document (length and position bound), and is then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import in_small_batches, text_key, written
from groundloom.llm.words import Words, runs, slices, text_bytes

WINDOW = 10
SHINGLE = 3
FILTER_BITS = 22


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, size, words, token, shift): each distinct window of each item with each of its shingles.

    ``token`` is the hash of the shingle that begins ``shift`` words after the window's begin. Shingles have ``SHINGLE``
    words, fewer only if the item has fewer. Items without words have no window.
    """
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                words = Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                names = ["item", "size", "words", "token", "shift"]
                out: dict[str, list] = {n: [] for n in names}
                for r in range(words.rows):
                    a, b = words.first[r], words.first[r + 1]
                    size = min(WINDOW, b - a)
                    item = batch.column(0)[lo + r].as_py()
                    for begin in range(a, b - size + 1) if size else ():
                        text = words.texts(begin, begin + size)
                        tokens = runs(words.hash[begin:begin + size], min(SHINGLE, size)).view(np.int64)
                        for shift, token in enumerate(tokens.tolist()):
                            for n, v in zip(names, (item, size, text, token, shift)):
                                out[n].append(v)
                    if len(out["token"]) > 100_000:
                        yield windows_batch(out, batch.schema.field(0).type)
                        out = {n: [] for n in names}
                yield windows_batch(out, batch.schema.field(0).type)

    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"item {kind}, size int, words array<string>, token bigint, shift int").distinct()


def windows_batch(out: dict[str, list], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int32(), pa.list_(pa.string()), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def token_filter(tokens: DataFrame) -> np.ndarray:
    """Bitmap of hashed tokens, 2^FILTER_BITS bits whatever the number of tokens. It lets only too much through."""
    slots = tokens.select(F.shiftrightunsigned("token", 64 - FILTER_BITS).alias("slot"))
    rows = (slots.groupBy(F.expr("shiftright(slot, 6)").alias("at"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits"))
            .collect())                                         # at most 2^(FILTER_BITS - 6) rows
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for r in rows:
        out[r["at"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


def candidate_words(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(doc, key, n_words, spans) per row of ``docs`` (doc, text, key).

    ``spans`` holds the places where a shingle passes the filter: each span is a stretch of words, long enough on either
    side for any window, with its first position and the shingles (position, token) in it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    kind = docs.schema["doc"].dataType.simpleString()
    span_type = pa.struct([("begin", pa.int64()), ("words", pa.list_(pa.string())),
                           ("at", pa.list_(pa.int64())), ("token", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                words = Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                places, tokens = [], []
                for size in sizes:
                    keys = runs(words.hash, size)
                    slot = keys >> np.uint64(64 - FILTER_BITS)
                    bit = (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)
                    at = np.flatnonzero(bit)
                    at = at[at + size <= words.first[words.row[at] + 1]]
                    places.append(at)
                    tokens.append(keys[at].view(np.int64))
                at, token = np.concatenate(places), np.concatenate(tokens)
                order = np.argsort(at, kind="stable")
                at, token = at[order], token[order]
                row = words.row[at]
                cut = np.ones(len(at), bool)
                cut[1:] = (row[1:] != row[:-1]) | (at[1:] - at[:-1] > 2 * WINDOW)
                edges = np.append(np.flatnonzero(cut), len(at))
                spans: list[list] = [[] for _ in range(words.rows)]
                for i, j in zip(edges[:-1], edges[1:]):
                    r = row[i]
                    base = words.first[r]
                    a = max(at[i] - WINDOW, base)
                    b = min(at[j - 1] + WINDOW, words.first[r + 1])
                    spans[r].append({"begin": a - base, "words": words.texts(a, b), "at": at[i:j] - base, "token": token[i:j]})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array(np.diff(words.first), pa.int64()), pa.array(spans, pa.list_(span_type))],
                    ["doc", "key", "n_words", "spans"])

    return in_small_batches(docs.select("doc", "text", "key")).mapInArrow(
        run, f"doc {kind}, key binary, n_words bigint, "
             "spans array<struct<begin:bigint,words:array<string>,at:array<bigint>,token:array<bigint>>>")


def occurrences(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (doc, key, n_words) of ``docs``, and every occurrence of a window (doc, key, item, begin, size).

    ``key`` is the hash of the text: rows with the same id and text are one document and share their occurrences.
    Nulls, empty and wordless texts and items have no words. The texts are read once; what the filter lets through
    is a written table. Rarity is counted over all documents.
    """
    windows = written(item_windows(items, item_id, item_text), "windows")
    sizes = [r[0] for r in windows.select(F.least("size", F.lit(SHINGLE)).alias("n")).distinct().collect()]  # 1 to SHINGLE
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).cast("string").alias("text"))
    rows = rows.withColumn("key", text_key(F.col("text")))
    found = written(candidate_words(rows, token_filter(windows.select("token").distinct()), sorted(sizes) or [SHINGLE]),
                    "candidates")
    spans = found.where(F.size("spans") > 0).select("doc", "key", "n_words", F.explode("spans").alias("s"))
    spans = spans.select("doc", "key", "n_words", "s.*").distinct()
    places = spans.select("doc", "key", "n_words", "begin", "words",
                          F.explode(F.arrays_zip("at", "token")).alias("p")).select(
        "doc", "key", "n_words", F.col("p.at").alias("at"), F.col("p.token").alias("token"),
        F.greatest(F.col("p.at") - F.lit(WINDOW - 1), "begin").alias("from"), F.col("begin"), "words")
    near = places.select("doc", "key", "n_words", "at", "token", "from",
                         F.slice("words", (F.col("from") - F.col("begin") + 1).cast("int"),
                                 F.lit(2 * WINDOW)).alias("near"))
    rarity = spans.select(F.explode("token").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # a shingle that no document has excludes its window
    ranked = (windows.join(rarity, "token", "left")
              .groupBy("item", "size", "words")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shift", "token")).alias("rarest")))
    prefixes = ranked.where("rarest.n > 0").select("item", "size", "words", "rarest.token", "rarest.shift")
    joined = near.join(prefixes, "token").withColumn("start", F.col("at") - F.col("shift"))
    fits = joined.where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    whole = fits.where(F.slice("near", (F.col("start") - F.col("from") + 1).cast("int"), F.col("size")) == F.col("words"))
    return found.select("doc", "key", "n_words"), whole.select("doc", "key", "item", F.col("start").alias("begin"), "size")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window. Extra columns of either table are not read.
    """
    rows, hits = occurrences(docs, items, doc_id, doc_text, item_id, item_text)
    hits = written(hits, "occurrences")
    words = (hits.select("doc", "key", F.explode(F.sequence("begin", F.col("begin") + F.col("size") - 1)).alias("at"))
             .distinct().groupBy("doc", "key").agg(F.count(F.lit(1)).alias("n_hit")))
    found = (hits.select("doc", "key", F.col("item").cast("string").alias("item")).distinct().groupBy("doc", "key")
             .agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items")))
    both = words.join(found, words["doc"].eqNullSafe(found["doc"]) & words["key"].eqNullSafe(found["key"])).select(
        words["doc"], words["key"], "n_hit", "n_items", "items")
    return (rows.join(both, rows["doc"].eqNullSafe(both["doc"]) & rows["key"].eqNullSafe(both["key"]), "left")
            .select(rows["doc"].alias(doc_id), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                    F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def uncontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any occurrence of a window, with all their columns."""
    _, hits = occurrences(docs, items, doc_id, doc_text)
    bad = written(hits.select("doc", "key").distinct(), "contaminated")
    same = docs[doc_id].eqNullSafe(bad["doc"]) & text_key(docs[doc_text].cast("string")).eqNullSafe(bad["key"])
    return docs.join(bad, same, "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of each row of ``documents`` with items of ``benchmark``."""
    folder = sf_dir.rstrip("/")
    return contamination(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

OP6_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, len(s) AS k, s FROM (
  SELECT item_id, unnest([w[j:j + least({WINDOW}, len(w)) - 1] FOR j IN range(1, len(w) - least({WINDOW}, len(w)) + 2)]) AS s
  FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
p AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS j FROM d, sizes WHERE len(w) >= k),
hit AS (SELECT p.doc_id, win.item_id, p.j, p.k FROM p JOIN win ON win.k = p.k AND win.s = p.w[p.j:p.j + p.k - 1]),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS pos FROM hit) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
