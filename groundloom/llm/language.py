"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound from its letters' vectors, each rotated by its place, by
multiplication; a text is the bundle (sum) of its 3-grams, a language the bundle of its texts. A text gets the language
whose prototype has the greatest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import in_small_batches
from groundloom.llm.words import mix

DIMENSIONS = 1024
SEED = 7
SLICE_CHARS = 600_000
SLICE_TEXTS = 256
GRAMS_AT_ONCE = 8_192
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """(number of points, dimensions) random signs that depend on the code point alone."""
    words = np.arange(dimensions // 64, dtype=np.uint64)
    bits = mix(mix(points.astype(np.uint64)[:, None] + np.uint64(SEED)) + words[None, :] * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def profiles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """(number of texts, dimensions) bundles of the n-grams of the lower-cased letters; a gap between words is one space.

    Only n-grams around a letter count, so none reaches into another text. A text without letters has a zero bundle.
    """
    low = [t.lower() for t in texts]
    flat = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    letter = letter_table()[flat]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    points, row = np.where(letter, flat, 32)[keep], np.append(0, row)[keep]
    out = np.zeros((len(texts), dimensions), np.float32)
    inside = np.flatnonzero(points[1:-1] != 32) + 1
    if not len(inside):
        return out
    used, at = _numbered(points, 0x110000)
    n = len(used)
    code, of = (at[inside - 1] * n + at[inside]) * n + at[inside + 1], row[inside]
    grams, gram = _numbered(code, n ** 3)
    vectors = letter_vectors(used, dimensions)
    turned = [np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1), vectors]
    for begin in range(0, len(grams), GRAMS_AT_ONCE):
        part = grams[begin:begin + GRAMS_AT_ONCE]
        bound = turned[0][part // (n * n)] * turned[1][part // n % n] * turned[2][part % n]
        here = slice(None) if len(grams) <= GRAMS_AT_ONCE else (gram >= begin) & (gram < begin + len(part))
        count = np.bincount(of[here] * len(part) + (gram[here] - begin), minlength=len(texts) * len(part))
        out += count.reshape(len(texts), len(part)).astype(np.float32) @ bound.astype(np.float32)
    return out


def _numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value among them."""
    if limit > 1 << 23:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(limit, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    at, part, size = 0, [], 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        if part and (size + len(text) > SLICE_CHARS or len(part) == SLICE_TEXTS):
            yield at, part
            at, part, size = i, [], 0
        part.append(text)
        size += len(text)
    if part:
        yield at, part


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm == 0, 1, norm)


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes from rows (text, lang); null languages teach nothing.

    Every text counts with the same length. A task sums its texts per language before anything is shuffled, so a frequent
    language costs no more; a language is one row of ``dimensions`` numbers at the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.asarray(batch.column(1).to_pylist(), object)
            for at, texts in _parts(batch.column(0)):
                unit = _unit(profiles(texts, dimensions))
                here = langs[at:at + len(texts)]
                for lang in set(here):
                    sums[lang] = sums.get(lang, 0) + unit[here == lang].sum(axis=0, dtype=np.float64)
        if sums:
            places = np.tile(np.arange(dimensions, dtype=np.int32), len(sums))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(sums), dimensions)), pa.array(places), pa.array(np.concatenate(list(sums.values())))],
                ["lang", "place", "value"])

    rows = (in_small_batches(labelled).where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
            .mapInArrow(run, "lang string, place int, value double")
            .groupBy("lang", "place").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v"))
            .orderBy("lang").collect())
    names = [r["lang"] for r in rows]
    return names, _unit(np.array([[x["value"] for x in r["v"]] for r in rows]).reshape(len(rows), dimensions))


def identify(docs: DataFrame, names: list[str], vectors: np.ndarray, text_col: str = "text") -> Column:
    """struct<lang, score> of a text: the language of greatest cosine (of equal ones the first by name) and that cosine,
    0 at least. A null text and a text without a letter is ``und`` with score 0; so is any text if nothing was learned."""
    in_small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast((names, vectors.astype(np.float32)))

    def run(column: pa.Array) -> pa.Array:
        names, vectors = shared.value
        langs, scores = [], []
        for _, texts in _parts(column):
            found = profiles(texts, vectors.shape[1] if len(names) else DIMENSIONS)
            some = found.any(axis=1)
            if not len(names):
                langs += [UNKNOWN] * len(texts)
                scores += [0.0] * len(texts)
                continue
            cosine = _unit(found) @ vectors.T
            best = cosine.argmax(axis=1)
            langs += [names[b] if s else UNKNOWN for b, s in zip(best, some)]
            scores += np.where(some, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0).astype(float).tolist()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return F.arrow_udf(run, "lang string, score double")(F.col(text_col).cast("string"))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each row of ``documents``, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    names, vectors = prototypes(docs.where(~held_out).select("text", "lang"))
    return docs.select("doc_id", held_out.alias("held_out"), identify(docs, names, vectors).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
