"""Quality classifier: evidence of the document itself, combined with what is known of its host and path.

Two faults are told apart, low quality and toxicity. The evidence for low quality is the text's most telling measure of
style (symbols, capitals, repetition, length), since one fault is enough. The evidence for toxicity is the amount and
density of telling words, judged by how often labelled documents of that amount and density are toxic; for this, every
labelled document is measured with words learned from the other half, and any other text with the words of either half. All are
rates with a beta prior, which for a bin of style or an amount and density is the rate of the nearest ones, so those that the
labels hardly show or never show get what their neighbours say. The rate of a site comes from an empirical Bayes hierarchy: a path is
shrunk toward its host, a host toward all documents, with strengths estimated from the spread of the rates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import checked_broadcast, hash_sample, in_small_batches, table, written
from groundloom.llm.words import Words, mix, shingles, slices, text_bytes

SAMPLE_LABELS = 20_000     # labelled documents, about, on which the evidence is fitted
PREFIXES = (4, 5)          # characters of a word's beginning; whole words are features as well
PRIOR_DOCS = 4.0           # weight, in documents, of the wider rate in the rate of a word or measure
NEAR_DOCS = 16             # documents, at least, of the nearest bins that make the prior of a bin
NEAR_WEIGHT = 2.0          # weight of that prior, in documents; a bin's own few documents say more than its neighbours
TELLING = 0.4              # a word below this rate of toxic documents says nothing
STYLES, STYLE_BINS = 7, 64                 # measures of style, and bins of each
DENSITIES, AMOUNTS = 32, 6                 # bins of the density and the amount of telling words; the last ones are open
FAULTS = ("low", "toxic")


def word_features(words: Words) -> np.ndarray:
    """(number of words, number of features) hashes of each word and its beginnings."""
    columns = [words.hash]
    for n in PREFIXES:
        end = words.prefix_end(n)
        columns.append(np.where(end < words.end, mix(words.span_hash(words.start, end) + np.uint64(n)), words.hash))
    return np.stack(columns, axis=1)


def style_features(words: Words, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, measures) bin numbers of the measures of style; every text has one bin of each measure."""
    rows = words.rows
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1)
    number = np.diff(words.first)
    per_word = np.maximum(number, 1)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row_of[mask], minlength=rows)

    upper = (data >= 65) & (data <= 90)
    odd = np.zeros(256, bool)
    odd[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
    again = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    repeats = np.bincount(words.row[1:][again], minlength=rows)
    row, _, n = shingles(words, 3)
    distinct = np.bincount(row, minlength=rows)
    runs_ = np.bincount(row, weights=n, minlength=rows)
    measures = [
        np.log2(1 + 64 * count(odd[data]) / per_word),
        np.log2(1 + 64 * count(data == ord("|")) / per_word),
        np.log2(1 + 64 * count(data == ord("!")) / per_word),
        8 * count(upper) / size,
        10 * repeats / per_word,
        10 * distinct / np.maximum(runs_, 1),
        np.log2(1 + number),
    ]
    return np.stack([m.astype(np.int64) for m in measures], axis=1)


def style_keys(bins: np.ndarray) -> np.ndarray:
    return (np.arange(bins.shape[1]) * 1000 + np.minimum(bins, STYLE_BINS - 1)).astype(np.int64)


def _sliced(column: pa.Array) -> Iterator[tuple[int, int, Words, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(column)
    for lo, hi in slices(offsets):
        part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        yield lo, hi, Words(part, at), part, at


def _copy_key(column: pa.Array) -> pa.Array:
    """A key that near copies of a text mostly share: the least hash of its shingles."""
    out = np.zeros(len(column), np.uint64)
    for lo, hi, words, _, _ in _sliced(column):
        row, key, _ = shingles(words, 3)
        first = np.searchsorted(row, np.arange(words.rows))
        has = np.diff(words.first) > 0
        out[lo:hi][has] = key[first[has]]
    return pa.array(out.view(np.int64))


class Telling:
    """Sorted hashes of telling words and word beginnings with their log-odds of toxicity."""

    def __init__(self, keys: np.ndarray, odds: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.odds = keys[order], odds[order]

    def amounts(self, words: Words, features: np.ndarray) -> np.ndarray:
        """Cell number of each text: the amount of telling words, and their density, both in powers of two."""
        total = np.zeros(words.rows)
        if len(self.keys) and len(words.hash):
            at = np.minimum(np.searchsorted(self.keys, features), len(self.keys) - 1)
            odds = np.where(self.keys[at] == features, self.odds[at], 0.0).max(axis=1)
            total = np.bincount(words.row, weights=odds, minlength=words.rows)
        density = 1000 * total / np.maximum(np.diff(words.first), 1)
        return (np.minimum(np.log2(1 + density), DENSITIES - 1).astype(np.int64) * 100
                + np.minimum(np.log2(1 + total), AMOUNTS - 1).astype(np.int64))


class Evidence:
    """What was learned: telling words of either half, log-odds of each of their cells, and log-odds of each bin of style."""

    def __init__(self, telling: list[Telling], cells: dict[int, float], styles: dict[int, float], base: dict[str, float]):
        self.telling, self.base = telling, base
        self.cells, self.styles = _columns(cells), _columns(styles)

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds by which the text itself shifts the odds of low quality and of toxicity."""
        low, toxic = np.zeros(len(column)), np.zeros(len(column))
        for lo, hi, words, data, offsets in _sliced(column):
            low[lo:hi] = _known(self.styles, style_keys(style_features(words, data, offsets))).max(axis=1)
            features = word_features(words)
            # the cells were counted with the words of one half, so they are looked up with these
            toxic[lo:hi] = np.mean([_known(self.cells, t.amounts(words, features)) for t in self.telling], axis=0)
        return low, toxic


def _columns(known: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(sorted(known), np.int64), np.array([known[k] for k in sorted(known)], float)


def _known(known: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Value of each key, 0 for those that are not there."""
    if not len(known[0]):
        return np.zeros(keys.shape)
    at = np.minimum(np.searchsorted(known[0], keys), len(known[0]) - 1)
    return np.where(known[0][at] == keys, known[1][at], 0.0)


def _near_rates(n: np.ndarray, bad: np.ndarray, base: float) -> np.ndarray:
    """Rate of each bin of a line or a grid, seen or not. Its prior is the rate of the nearest other bins, taken by distance until they
    have ``NEAR_DOCS`` documents, whose own prior is ``base``."""
    places = np.indices(n.shape).reshape(n.ndim, -1)
    flat_n, flat_bad = n.ravel(), bad.ravel()
    out = np.empty(n.size)
    for i in range(n.size):
        distance = np.abs(places - places[:, i:i + 1]).sum(axis=0)
        docs = np.bincount(distance, weights=flat_n)[1:].cumsum()
        far = min(int(np.searchsorted(docs, NEAR_DOCS)) + 1, len(docs))
        near = (distance > 0) & (distance <= far)
        prior = (flat_bad[near].sum() + PRIOR_DOCS * base) / (flat_n[near].sum() + PRIOR_DOCS)
        out[i] = (flat_bad[i] + NEAR_WEIGHT * prior) / (flat_n[i] + NEAR_WEIGHT)
    return out.reshape(n.shape)


def _evidence(keys: np.ndarray, n: np.ndarray, bad: np.ndarray, width: int, shape: tuple[int, int], base: float,
              rows_apart: bool) -> dict[int, float]:
    """Log-odds of every key ``width * row + column`` of a grid of ``shape``, of which some were counted. ``rows_apart``: a row has no
    neighbours in other rows."""
    counts = np.zeros((2, *shape))
    counts[0, keys // width, keys % width], counts[1, keys // width, keys % width] = n, bad
    if not counts[0].any():
        return {}
    rates = np.stack([_near_rates(*row, base) for row in counts.swapaxes(0, 1)]) if rows_apart else _near_rates(*counts, base)
    odds = _logit(rates) - _logit(base)
    return {int(width * r + c): float(odds[r, c]) for r, c in np.ndindex(*shape)}


def _logit(p):
    return np.log(p / (1 - p))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """(text, low, toxic, copy) of about ``sample`` labelled documents, chosen by the hash of the id, one of each group of copies."""
    chosen = hash_sample(labels, F.col("doc"), sample)
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    rows = rows.join(checked_broadcast(written(chosen, "chosen")), "doc")
    key = F.arrow_udf(_copy_key, "bigint")
    # of copies the one of least id
    one = rows.withColumn("copy", key("text")).groupBy("copy", "low", "toxic").agg(F.min_by("text", F.struct("doc", "text")).alias("text"))
    return written(one, "labelled")


def fit(sample: DataFrame) -> Evidence:
    """Evidence from labelled texts (text, low, toxic, copy). Counts are combined in each task before they are shuffled;
    what reaches the driver is bounded by the sample."""
    sample = sample.select("text", *[F.coalesce(f, F.lit(0)).alias(f) for f in FAULTS],
                           F.pmod(F.col("copy"), F.lit(2)).cast("int").alias("fold"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, toxic, fold = (np.asarray(batch.column(i)) for i in (1, 2, 3))
            for lo, hi, words, data, offsets in _sliced(batch.column(0)):
                features = word_features(words)
                row = np.repeat(words.row, features.shape[1])
                order = np.lexsort((row, features.ravel()))
                key, row = features.ravel()[order], row[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
                key, row = key[new].view(np.int64), row[new]
                for half in (0, 1):
                    here = fold[lo:hi][row] == half
                    yield _counted(half, key[here], toxic[lo:hi][row[here]])
                keys = style_keys(style_features(words, data, offsets))
                yield _counted(2, keys.ravel(), np.repeat(low[lo:hi], keys.shape[1]))

    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in FAULTS]).first()
    base = {f: ((totals[f] or 0) + 0.5) / (totals["n"] + 1.0) for f in FAULTS}
    sums = sample.mapInArrow(counts, "kind int, key bigint, n bigint, bad bigint")
    sums = sums.groupBy(F.col("kind") == 2, "key").agg(*[F.sum(F.when(F.col("kind") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}")
                                                         for k in (0, 1, 2) for c in ("n", "bad")])
    most = F.greatest(*[(F.expr(b) + PRIOR_DOCS * base["toxic"]) / (F.expr(n) + PRIOR_DOCS)
                        for n, b in (("n0", "bad0"), ("n1", "bad1"), ("n0 + n1", "bad0 + bad1"))])
    kept = sums.where((F.col("n2") > 0) | (most >= TELLING)).toPandas()
    word, style = kept[kept.n2 == 0], kept[kept.n2 > 0]

    def telling(n, bad) -> Telling:
        rate = (bad + PRIOR_DOCS * base["toxic"]) / (n + PRIOR_DOCS)
        some = (rate >= TELLING).to_numpy(bool)
        return Telling(word.key.to_numpy(np.int64).view(np.uint64)[some], (_logit(rate) - _logit(base["toxic"])).to_numpy(float)[some])

    halves = [telling(word.n1, word.bad1), telling(word.n0, word.bad0)]
    other = sample.sparkSession.sparkContext.broadcast(halves)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, fold = (np.asarray(batch.column(i)) for i in (2, 3))
            for lo, hi, words, _, _ in _sliced(batch.column(0)):
                features = word_features(words)
                cell = np.where(fold[lo:hi] == 0, other.value[0].amounts(words, features), other.value[1].amounts(words, features))
                yield _counted(0, cell, toxic[lo:hi])

    cells = (sample.mapInArrow(measured, "kind int, key bigint, n bigint, bad bigint")
             .groupBy("key").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).toPandas())
    return Evidence(halves, _evidence(*_counts(cells.key, cells.n, cells.bad), 100, (DENSITIES, AMOUNTS), base["toxic"], False),
                    _evidence(*_counts(style.key, style.n2, style.bad2), 1000, (STYLES, STYLE_BINS), base["low"], True), base)


def _counts(*columns) -> list[np.ndarray]:
    return [c.to_numpy(np.int64) for c in columns]


def _counted(kind: int, keys: np.ndarray, bad: np.ndarray) -> pa.RecordBatch:
    unique, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    sums = np.bincount(at, weights=bad, minlength=len(unique)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(unique), kind, np.int32)), pa.array(unique),
                                       pa.array(n.astype(np.int64)), pa.array(sums)], ["kind", "key", "n", "bad"])


def _strength(groups: DataFrame, fault: str) -> tuple[float, float]:
    """Overall rate, and the weight in documents of the prior that the spread of the groups' rates implies (by moments)."""
    n, bad = F.col("n"), F.col(fault)
    t = groups.agg(F.sum(n).alias("n"), F.sum(bad).alias("bad"), F.count(F.lit(1)).alias("k"), F.sum(n * n).alias("nn"),
                   F.sum(bad * bad / n).alias("s")).first()
    if not t["n"]:
        return 0.0, 1.0
    rate = t["bad"] / t["n"]
    within = rate * (1 - rate)
    spread = t["s"] - t["n"] * rate * rate - (t["k"] - 1) * within
    room = t["n"] - t["nn"] / t["n"]
    if spread <= 0 or room <= 0 or within == 0:
        return rate, 1e4
    return rate, float(np.clip(within * room / spread - 1, 1.0, 1e4))


def site_rates(marked: DataFrame) -> DataFrame:
    """(host, path, low, toxic): posterior rates per path of the labelled documents (host, path, low, toxic).

    Every label counts; a task combines its documents before the shuffle, so a hot host costs nothing extra.
    """
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(F.coalesce(f, F.lit(0))).alias(f) for f in FAULTS]]
    paths = written(marked.groupBy("host", "path").agg(*sums), "paths")
    hosts = written(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", *FAULTS)]), "hosts")
    tops = hosts
    lows = paths
    for f in FAULTS:
        rate, weight = _strength(hosts, f)
        tops = tops.withColumn(f"host_{f}", (F.col(f) + weight * rate) / (F.col("n") + weight))
        _, weight = _strength(paths, f)
        lows = lows.withColumn(f"weight_{f}", F.lit(weight))
    tops = tops.select(F.col("host").alias("of"), *[f"host_{f}" for f in FAULTS])
    joined = lows.join(tops, F.col("host").eqNullSafe(F.col("of")))
    return joined.select("host", "path", *[((F.col(f) + F.col(f"weight_{f}") * F.col(f"host_{f}"))
                                            / (F.col("n") + F.col(f"weight_{f}"))).alias(f) for f in FAULTS])


def judged(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
           sample: int = SAMPLE_LABELS) -> DataFrame:
    """``docs`` with ``_q_low`` and ``_q_toxic``, the posterior probabilities of the two faults.

    ``labels`` has ``id_col``, ``quality`` (0: low) and ``toxic`` (1: toxic); of several labels of one document the worst
    counts, a null label says nothing. Unlabelled sites, null hosts and paths have the overall rate or their own
    null group. A null or empty text has only its length as evidence. Without labels nothing is faulty.
    """
    docs = in_small_batches(docs)
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc")).agg(
        F.max(F.when(F.col("quality") == 0, 1).when(F.col("quality").isNotNull(), 0)).alias("low"),
        F.max(F.when(F.col("toxic") == 1, 1).when(F.col("toxic").isNotNull(), 0)).alias("toxic"))
    marks = written(marks, "marks")
    evidence = fit(labelled(docs, marks, id_col, text_col, sample))
    shared = docs.sparkSession.sparkContext.broadcast(evidence)

    def of(column: pa.Array) -> pa.Array:
        low, toxic = shared.value.of(column)
        return pa.StructArray.from_arrays([pa.array(low), pa.array(toxic)], ["low", "toxic"])

    places = docs.select(F.col(id_col).alias("doc"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    sites = site_rates(places.join(marks, "doc")).select(F.col("host").alias("_q_host"), F.col("path").alias("_q_path"),
                                                         F.col("low").alias("_q_site_low"), F.col("toxic").alias("_q_site_toxic"))
    sites = checked_broadcast(written(sites, "sites"))
    scored = docs.withColumn("_q", F.arrow_udf(of, "low double, toxic double")(F.col(text_col).cast("string")))
    joined = scored.join(sites, host.cast("string").eqNullSafe(F.col("_q_host"))
                         & path.cast("string").eqNullSafe(F.col("_q_path")), "left")
    out = {}
    for f in FAULTS:
        prior = F.coalesce(F.col(f"_q_site_{f}"), F.lit(evidence.base[f]))
        prior = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
        out[f"_q_{f}"] = 1 / (1 + F.exp(-(F.ln(prior / (1 - prior)) + F.col(f"_q.{f}"))))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], *[v.alias(k) for k, v in out.items()])


REJECT = 0.5


def accepted(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are probably neither of low quality nor toxic."""
    rows = judged(docs, labels, host, path, id_col, text_col)
    return rows.where((F.col("_q_low") < REJECT) & (F.col("_q_toxic") < REJECT)).drop("_q_low", "_q_toxic")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the faults and the decision for each row of ``documents``; host is the source, path the language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = judged(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return rows.select("doc_id", F.col("_q_low").alias("p_low"), F.col("_q_toxic").alias("p_toxic"),
                       ((F.col("_q_low") < REJECT) & (F.col("_q_toxic") < REJECT)).alias("kept"))
