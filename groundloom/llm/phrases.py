"""Phrase collocations by marginalising from the top order.

At each word position a window of ``ORDER`` words, filled up with empty words at the end of its piece, is counted. Only these
longest windows come from the texts; the counts of shorter phrases are ROLLUP sums over prefixes of the windows, since each
occurrence of a phrase begins exactly one window.

A window also ends before a phrase that is too rare to matter: a phrase that occurs ``least`` times has parts that occur as
often, so hashes of phrases of two, then three words are counted first, and what they rule out is left empty. Equal hashes only
add counts, so nothing is ruled out wrongly, and sums that reach ``least`` are those of the whole windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundloom.llm.common import in_small_batches, table, written
from groundloom.llm.words import _lower, _power_table, mix, runs, slices, text_bytes

ORDER = 4
LEAST_COUNT = 30
TOP = 2000
SCALE = 2_000_000
COVERED_PERCENT = 80
SALTS = 256
HASH_BITS = 40
LEAST_FILTER, MOST_FILTER = 16, 28            # bits of a filter's slot numbers: 8 KB to 32 MB
BITS_PER_PHRASE = 16

_ends_piece = np.zeros(256, bool)
_ends_piece[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_in_word = ~_ends_piece
_in_word[[0x20, 0x09]] = False


class Positions:
    """Words of consecutive texts with their row, piece, hash and text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        low = _lower[data]
        word = _in_word[low]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        start = np.flatnonzero(word & (~before | edge[:-1]))
        end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.row = np.searchsorted(offsets, start, "right") - 1
        self.piece = np.cumsum(_ends_piece[low])[start] + self.row if len(start) else self.row
        up, down = _power_table(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        self.hash = mix((sums[end] - sums[start]) * down[start] ^ langs[self.row])
        self.packed, self.ends = low[word], np.append(0, np.cumsum(end - start))

    def texts(self) -> pa.Array:
        """All words, and an empty one at the end."""
        ends = np.append(self.ends, self.ends[-1])
        return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.packed))

    def keys(self, size: int) -> np.ndarray:
        """Hash of the phrase of ``size`` words from each word, as long as there are words."""
        return runs(self.hash, size) >> np.uint64(64 - HASH_BITS)

    def possible(self, size: int, filters: list[np.ndarray]) -> np.ndarray:
        """Whether a phrase of ``size`` words of one piece begins at each word, and no part of it is ruled out."""
        ok = np.ones(len(self.row), bool)
        for k in range(2, size + 1):
            longer = np.zeros(len(ok), bool)
            n = max(len(ok) - k + 1, 0)
            longer[:n] = ok[:n] & ok[1:n + 1] & (self.piece[:n] == self.piece[k - 1:])
            if k - 2 < len(filters):
                at = np.flatnonzero(longer)
                longer[at] = passes(filters[k - 2], self.keys(k)[at])
            ok = longer
        return ok


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys >> np.uint64(HASH_BITS - (len(bits) * 64).bit_length() + 1)
    return ((bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def positions(batch: pa.RecordBatch) -> Iterator[tuple[Positions, int, int]]:
    """The words of a batch (lang, text) in slices of rows."""
    data, offsets = text_bytes(batch.column(1))
    codes = batch.column(0).dictionary_encode()
    seeds = np.array([int.from_bytes(str(v).encode("utf-8")[-64:], "big") % (1 << 61) for v in codes.dictionary.to_pylist()] or [0], np.uint64)
    langs = mix(seeds)[codes.indices.to_numpy(zero_copy_only=False)] if len(codes) else np.zeros(0, np.uint64)
    for lo, hi in slices(offsets):
        yield Positions(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], langs[lo:hi]), lo, hi


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return in_small_batches(docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")))


def frequent_filter(texts: DataFrame, size: int, filters: list[np.ndarray], least: int) -> np.ndarray:
    """Bitmap of the hashes of phrases of ``size`` words that occur ``least`` times. It grows with their number up to 32 MB;
    beyond that it lets more through."""
    shared = texts.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, _, _ in positions(batch):
                at = np.flatnonzero(words.possible(size, shared.value))
                key, n = np.unique(words.keys(size)[at], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    counted = texts.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    keys = written(counted.where(F.col("n") >= least).select("key"), "frequent")
    bits = min(max((keys.count() * BITS_PER_PHRASE).bit_length(), LEAST_FILTER), MOST_FILTER)
    slots = keys.select(F.shiftright("key", HASH_BITS - bits).alias("slot"))
    rows = (slots.groupBy(F.shiftright("slot", 6).alias("at"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")).toArrow())   # at most 2^(bits - 6) rows
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def windows(texts: DataFrame, filters: list[np.ndarray]) -> DataFrame:
    """(lang, w1 … w4, n): the windows that begin at the words, counted per slice. Missing words are empty."""
    shared = texts.sparkSession.sparkContext.broadcast(filters)
    cols = [f"w{k}" for k in range(1, ORDER + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, lo, _ in positions(batch):
                n = len(words.row)
                if not n:
                    continue
                codes = words.texts().dictionary_encode()
                code = codes.indices.to_numpy()
                lang = batch.column(0).dictionary_encode()
                lead = {"lang": pa.array(lang.indices.to_numpy()[lo + words.row])}
                for k, c in enumerate(cols):
                    there = np.append(words.possible(k + 1, shared.value)[:n - k], np.zeros(min(k, n), bool))
                    lead[c] = pa.array(code[np.where(there, np.minimum(np.arange(n) + k, n), n)])
                found = pa.table({**lead, "n": pa.array(np.ones(n, np.int64))}).group_by(["lang", *cols], use_threads=False).aggregate([("n", "sum")])
                shown = codes.dictionary.cast(pa.string())
                yield pa.RecordBatch.from_arrays([
                    lang.dictionary.take(found["lang"].combine_chunks()), *[shown.take(found[c].combine_chunks()) for c in cols],
                    found["n_sum"].combine_chunks()], ["lang", *cols, "n"])

    return texts.mapInArrow(run, "lang string, " + ", ".join(f"{c} string" for c in cols) + ", n bigint")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, size, words, f) that occur ``least`` times, and the words (lang, n) of each language.

    The longest phrases are the full windows themselves; ROLLUP gives the shorter ones and the totals.
    """
    texts, filters = _texts(docs, text_col, lang_col), []
    for size in range(2, ORDER):
        filters.append(frequent_filter(texts, size, filters, least))
    cols = [f"w{k}" for k in range(1, ORDER + 1)]
    full = written(windows(texts, filters).groupBy("lang", *cols).agg(F.sum("n").alias("f")), "windows")
    level = F.grouping_id()
    sums = full.rollup("lang", *cols[:-1]).agg(F.sum("f").alias("f"), level.alias("level"))
    sums = written(sums.where(((F.col("f") >= least) & (F.col("level") < 2 ** (ORDER - 1) - 1))
                              | (F.col("level") == 2 ** (ORDER - 1) - 1)), "prefixes")
    parts = [full.where((F.col("f") >= least) & (F.col(cols[-1]) != "")).select(
        "lang", F.lit(ORDER).alias("size"), F.array(*cols).alias("words"), "f")]
    for size in range(1, ORDER):
        gone = 2 ** (ORDER - 1 - size) - 1                     # bits of the columns that are summed away
        parts.append(sums.where((F.col("level") == gone) & (F.col(cols[size - 1]) != "")).select(
            "lang", F.lit(size).alias("size"), F.array(*cols[:size]).alias("words"), "f"))
    phrases = parts[0]
    for p in parts[1:]:
        phrases = phrases.unionByName(p)
    return phrases, sums.where(F.col("level") == 2 ** (ORDER - 1) - 1).select("lang", F.col("f").alias("n"))


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def cut_scores(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, k, l, r, score) of each candidate (phrase of two words or more) at its lowest-scoring cut."""
    known = phrases.select("lang", F.array_join("words", " ").alias("part"), "f")
    many = phrases.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = many.select("lang", F.array_join("words", " ").alias("phrase"), "size", F.col("f").alias("a"), "k",
                       F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    both = (cuts.join(known.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    exact = F.expr(f"CAST(a AS decimal(20,0)) * {SCALE} div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    scored = both.withColumn("score", exact.cast("bigint"))
    best = scored.groupBy("lang", "phrase", "size", "a").agg(
        F.array_min(F.collect_list(F.struct("score", "k", "l", "r"))).alias("cut"))       # a list of at most ORDER - 1
    return best.select("lang", "phrase", "size", "a", "cut.k", "cut.l", "cut.r", "cut.score")


def covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, f): the count of the most frequent longer candidate that holds each phrase of two words or more."""
    spans = [(size, begin, length) for size in range(3, ORDER + 1) for length in range(2, size)
             for begin in range(1, size - length + 2)]
    parts = F.array(*[F.when(F.col("size") == size, F.array_join(F.slice("words", begin, length), " "))
                      for size, begin, length in spans])
    held = phrases.where("size > 2").select("lang", F.explode(parts).alias("phrase"), "f").where("phrase IS NOT NULL")
    return held.groupBy("lang", "phrase").agg(F.max("f").alias("f"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to four words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and into words at blanks and tabs. A phrase
    with ``a`` >= ``least`` occurrences is a candidate; its score is the least over its cuts of 2,000,000 a / (l + r), rounded
    down (ties to the first cut). Candidates inside a longer one with at least 80 % of their occurrences go. The order is score,
    occurrences (both descending) and the phrase. Null texts are empty, a null language is ``und``. Ids are not read,
    so a repeated row counts again; a text may have any length. Extra columns are not read, whatever their names. An empty table
    gives an empty result. The report of ``top`` rows is ranked in two steps, so a language is not sorted in one task.
    """
    phrases, totals = phrase_counts(docs, text_col, lang_col, least)
    phrases = written(phrases, "phrases")
    held = covered(phrases)
    scored = cut_scores(phrases)
    free = (scored.join(held, ["lang", "phrase"], "left")
            .where(F.col("f").isNull() | (_wide("f") * 100 < _wide("a") * COVERED_PERCENT)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = free.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return salted.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS id, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
w AS (SELECT id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, len(s) AS size, s, count(*) AS f FROM (
        SELECT lang, unnest([w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)]) AS s FROM w, range(1, {ORDER + 1}) AS ks(k) WHERE len(w) >= k)
      GROUP BY lang, s),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE size = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE size >= 2 AND f >= {LEAST_COUNT}),
cut AS (SELECT c.lang, c.s, c.f AS a, k, x.f AS l, y.f AS r, CAST({SCALE} * CAST(c.f AS HUGEINT) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, size)) AS k FROM c) AS c
        JOIN g AS x ON x.lang = c.lang AND x.s = c.s[1:k] JOIN g AS y ON y.lang = c.lang AND y.s = c.s[k + 1:]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
held AS (SELECT lang, s, max(f) AS f FROM (
           SELECT lang, f, unnest([x[b:b + m - 1] FOR b IN range(1, size - m + 2)]) AS s
           FROM (SELECT lang, f, size, s AS x, unnest(range(2, size)) AS m FROM c WHERE size > 2)) GROUP BY lang, s),
free AS (SELECT best.* FROM best LEFT JOIN held USING (lang, s) WHERE held.f IS NULL OR CAST(held.f AS HUGEINT) * 100 < CAST(best.a AS HUGEINT) * {COVERED_PERCENT}),
ranked AS (SELECT lang, array_to_string(s, ' ') AS phrase, a, l, r, score,
             row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(s, ' ')) AS rank FROM free)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
