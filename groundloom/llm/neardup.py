"""Near-duplicate classes by ProbMinHash over weighted word shingles, banding and exact verification.

Two texts are linked if the probability Jaccard similarity of their shingles of ``SIZE`` words, weighted by how often they
occur, is at least ``THRESHOLD``; a class is a connected set of links. The similarity of sets with equal weights is the plain
Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import checked_broadcast, components, in_small_batches, text_key, written
from groundloom.llm.words import Words, mix, runs, shingles, slices, text_bytes

SIZE = 5
THRESHOLD = 0.8
BANDS = 30            # a pair at the threshold shares no band with probability (1 - 0.8^5)^30 = 7e-6
BAND_ROWS = 5
HUB_YIELD = 0.1       # hub rounds go on while at least this share of the compared pairs is linked
SLOTS = 1 << 16       # counters of the rarity order, whatever the data
EARLIER = 4           # earlier shingles by which a pair that has met before is seen


def prob_minhash(row: np.ndarray, key: np.ndarray, weight: np.ndarray, rows: int, k: int, seed: int = 1) -> np.ndarray:
    """(rows, k) winning elements. Positions of two rows agree with the probability Jaccard similarity of their weights.

    Each element is a Poisson process of rate ``weight`` whose arrivals hit random positions; a position keeps the element
    that arrives first. An element stops as soon as it is later than every position of its row. Rows without elements
    keep zeros.
    """
    first = np.full(rows * k, np.inf)
    winner = np.zeros(rows * k, np.uint64)
    time = np.zeros(len(key))
    weight = weight.astype(float)
    state = mix(key + np.uint64(seed))
    step = np.uint64(0x9E3779B97F4A7C15)
    while len(key):
        state = state + step
        random = mix(state)
        time = time - np.log(((random >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / weight
        spot = ((mix(random ^ step) >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        at = row * k + spot.astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        winner[at[won]] = key[won]
        used = np.flatnonzero(np.bincount(row, minlength=rows))
        last = np.full(rows, np.inf)
        last[used] = first.reshape(rows, k)[used].max(axis=1)
        going = time < last[row]
        row, key, weight, time, state = row[going], key[going], weight[going], time[going], state[going]
    return winner.reshape(rows, k)


def probability_jaccard(a: dict[str, np.ndarray] | tuple, b: tuple) -> float:
    """Similarity of two weighted sets, each (sorted keys, weights): the sum over common keys d of
    1 / sum_e max(x_e / x_d, y_e / y_d). Two empty sets have 0."""
    (ka, xa), (kb, xb) = a, b
    keys = np.union1d(ka, kb)
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, ka)] = xa
    y[np.searchsorted(keys, kb)] = xb
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    ratio, at = np.unique(x[both] / y[both], return_inverse=True)
    total = np.array([np.maximum(x, r * y).sum() for r in ratio])
    return float((x[both] / total[at]).sum())


def band_keys(docs: DataFrame, size: int = SIZE, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """(doc, node, bands) of rows (doc, text, node); ``bands`` is null for texts without words."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                words = Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                row, key, count = shingles(words, size)
                sign = prob_minhash(row, key, count, words.rows, bands * band_rows)
                flat = runs(sign.ravel(), band_rows)[::band_rows].reshape(words.rows, bands)
                flat = mix(flat + np.arange(bands, dtype=np.uint64))
                values = pa.array(flat.ravel().view(np.int64), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(words.rows + 1) * bands, pa.int32()), values)
                none = pa.array(np.diff(words.first) == 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.compute.if_else(none, pa.scalar(None, lists.type), lists)], ["doc", "node", "bands"])

    return in_small_batches(docs.select("doc", "text", "node")).mapInArrow(run, f"doc {kind}, node binary, bands array<bigint>")


def linked(pairs: DataFrame, texts: DataFrame, size: int = SIZE, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose texts are at least ``threshold`` similar, each compared exactly and by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = text_bytes(batch.column(2)), text_bytes(batch.column(3))
            for lo, hi in slices(left[1] + right[1]):
                sides = []
                for data, offsets in (left, right):
                    words = Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    row, key, count = shingles(words, size)
                    sides.append((key, count, np.searchsorted(row, np.arange(words.rows + 1))))
                for i in range(hi - lo):
                    a, b = [(key[at[i]:at[i + 1]], count[at[i]:at[i + 1]]) for key, count, at in sides]
                    keep[lo + i] = probability_jaccard(a, b) >= threshold
            yield batch.select([0, 1]).filter(pa.array(keep))

    of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a binary, b binary")


def prefix_pairs(texts: DataFrame, size: int = SIZE, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of rows (node, text, label) with different labels that may be linked; no linked pair is missing.

    Shingles are ordered by how rare they are (counted per hash slot; any fixed order is right, a rare first one is quick).
    The similarity is at most the share of either text's weight that lies in common shingles. So the rarest shingles of a
    text, as many as weigh more than 1 - threshold, hold the first common one, and linked texts meet there. Let w and w' be
    the weights of the two texts, u and u' what lies before that shingle and is not common, e and e' the weight of repeated
    occurrences. The greater counts of the common shingles sum up to p <= min(w - u + e', w' - u' + e), and the similarity
    is at most p / (w + w' - p). Passages that very many texts share come last in the order and bring nobody together;
    copies of one text that differ in many other places fail the bound. Where one of the last few shingles before is common
    as well, the pair has met there already and is left out.
    """
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, _, row, key, _ in _shingled(batch.column(0), size):
                count += np.bincount((key >> np.uint64(48)).astype(np.int64), minlength=SLOTS)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used])], ["slot", "n"])

    counted = (texts.select("text").mapInArrow(slots, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
               .collect())                                                    # at most SLOTS rows
    rarity = np.zeros(SLOTS, np.int64)
    for r in counted:
        rarity[r["slot"]] = r["n"]
    shared = texts.sparkSession.sparkContext.broadcast(rarity)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, row, key, n in _shingled(batch.column(2), size):
                order = np.lexsort((key, shared.value[(key >> np.uint64(48)).astype(np.int64)], row))
                row, key, n = row[order], key[order], n[order].astype(float)
                first = np.searchsorted(row, np.arange(hi - lo))
                before = np.cumsum(n) - n
                total = np.bincount(row, weights=n, minlength=hi - lo)
                share = (before - before[first[row]]) / total[row] if len(row) else before
                keep = share <= 1 - threshold + 1e-9
                extra = total - np.bincount(row, minlength=hi - lo)
                row, key, total, rest = row[keep], key[keep].view(np.int64), total[row[keep]], (total[row] * (1 - share))[keep]
                extra = extra[row].astype(float)
                place = np.arange(len(row)) - np.searchsorted(row, row)
                number = np.minimum(place, EARLIER)
                back = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + 1
                earlier = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(number)), pa.int32()),
                                                   pa.array(key[np.repeat(np.arange(len(row)), number) - back]))
                at = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(key), pa.array(total), pa.array(rest),
                     pa.array(extra), earlier], ["node", "label", "token", "weight", "rest", "extra", "earlier"])

    tokens = written(texts.select("node", "label", "text").mapInArrow(
        prefixes, "node binary, label binary, token bigint, weight double, rest double, extra double, earlier array<bigint>"), "prefixes")
    left, right = tokens.alias("x"), tokens.alias("y")
    p = F.least(F.expr("x.rest + y.extra"), F.expr("y.rest + x.extra"))
    bound = p >= F.lit(threshold - 1e-9) * (F.expr("x.weight + y.weight") - p)
    both = F.expr("x.token = y.token AND x.node < y.node AND x.label <> y.label AND NOT arrays_overlap(x.earlier, y.earlier)")
    return left.join(right, both & bound).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _shingled(column: pa.Array, size: int) -> Iterator[tuple]:
    data, offsets = text_bytes(column)
    for lo, hi in slices(offsets):
        yield (lo, hi, *shingles(Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]), size))


def links(docs: DataFrame, size: int = SIZE, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc, node, bands), verified links (a, b) and labels (node, label) of ``docs`` (doc, text, node).

    ``node`` is the hash of the text, so equal texts are one node from the start. A bucket is a band value that several
    nodes share. In rounds every bucket compares its members with one of them, its hub; members that are already in the
    hub's class need no comparison. The hub is the member that shares the most band values with others, which among
    copies of one text is the text they were made from; later hubs come in turn from outside the first one's class and from
    any class. The rounds end when they hardly link anything. The members of buckets that then still hold several classes
    are joined by ``prefix_pairs``, which misses no link. A pair inside one class could not change the classes.
    """
    rows = written(band_keys(docs, size), "bands")
    nodes = written(rows.where(F.col("bands").isNotNull()).groupBy("node").agg(F.first("bands").alias("bands")), "nodes")
    entries = nodes.select(F.explode("bands").alias("band"), "node")
    shared = written(entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = written(entries.join(shared, "band"), "members")
    degrees = written(members.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    members = members.select("band", "node")
    wanted = checked_broadcast(degrees.select("node"), 1_000_000)
    texts = written(docs.select("node", "text").join(wanted, "node", "left_semi").dropDuplicates(["node"]), "texts")
    labels = degrees.select("node", "degree", F.col("node").alias("label"), F.lit(False).alias("used"))
    found = tested = None
    turn, going = 0, True
    while True:
        placed = members.join(labels, "node")
        rank = F.struct("degree", "node")
        top = placed.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                         F.max_by("label", rank).alias("top_label")).where("lo <> hi")
        open_ = written(placed.join(top.select("band", "top_label"), "band"), "open")
        if open_.isEmpty():
            break
        if going:
            free = open_ if turn == 0 else open_.where("NOT used" + (" AND label <> top_label" if turn % 2 else ""))
            hubs = free.groupBy("band").agg(F.max_by(F.struct("node", "label"), rank).alias("hub"))
            hubs = written(hubs.select("band", F.col("hub.node").alias("hub"), F.col("hub.label").alias("hub_label")), "hubs")
            pairs = open_.join(hubs, "band").where("label <> hub_label")
            pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
            was_hub = hubs.select(F.col("hub").alias("node")).distinct().withColumn("now", F.lit(True))
            labels = labels.join(was_hub, "node", "left").select("node", "degree", "label", (
                F.col("used") | F.coalesce("now", F.lit(False))).alias("used"))
        else:
            pairs = prefix_pairs(texts.join(open_.select("node", "label").distinct(), "node"), size, threshold)
        pairs = pairs.distinct() if tested is None else pairs.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        new = written(linked(pairs, texts, size, threshold), "links")
        number = new.count()
        found = new if found is None else found.unionByName(new)
        if number:
            joined = components(found).withColumnRenamed("label", "joined")
            labels = labels.join(joined, "node", "left").select("node", "degree", F.coalesce("joined", "label").alias("label"), "used")
        labels = written(labels, "labels")
        if not going:
            break
        turn, going = turn + 1, number >= HUB_YIELD * max(pairs.count(), 1)
    labels = labels.select("node", "label")
    return rows, found, labels


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
            threshold: float = THRESHOLD) -> DataFrame:
    """(doc, node, class_key) for every row of ``docs``: rows with one ``class_key`` are near-duplicates.

    Equal texts, also empty or wordless ones, are one class. A null text is a class of its own (null ``class_key``).
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    rows, _, labels = links(rows.withColumn("node", text_key(F.col("text"))), size, threshold)
    rows = rows.select("doc", "node")
    return rows.join(labels, "node", "left").select("doc", "node", F.coalesce("label", "node").alias("class_key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, class_size, kept) for every row of ``docs``.

    ``class_id`` is the least id in the class (null if all are null). The row with it is ``kept``: the class's
    representative; rows that repeat its id and text share the mark. Rows with a null text are classes of their own. Extra columns are not read.
    """
    rows = written(classes(docs, id_col, text_col), "classes")
    keyed = rows.where(F.col("class_key").isNotNull())
    heads = keyed.groupBy("class_key").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "node")).alias("best"),
                                           F.count(F.lit(1)).alias("class_size"))
    # the join is the last step of its stage, so that a class with very many rows can be split
    all_ = keyed.join(heads, "class_key").select(
        F.col("doc").alias(id_col), F.col("best.doc").alias("class_id"), "class_size",
        (F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("node") == F.col("best.node"))).alias("kept"))
    alone = rows.where(F.col("class_key").isNull()).select(F.col("doc").alias(id_col), F.col("doc").alias("class_id"),
                                                           F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("kept"))
    return all_.unionByName(alone)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with all its columns: the one of least id, of equal ids the one of least text hash.

    Rows that repeat id and text are one document, of which one row stays. Rows with a null text all stay.
    """
    rows = written(classes(docs, id_col, text_col), "classes")
    groups = rows.where(F.col("class_key").isNotNull()).groupBy("doc", "node", "class_key").agg(F.count(F.lit(1)).alias("n"))
    best = groups.groupBy("class_key").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "node")).alias("best"))
    marked = written(groups.join(best, "class_key").select(
        "doc", "node", "n", (F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("node") == F.col("best.node"))).alias("stays"))
        .where("NOT stays OR n > 1"), "marked")
    mark = "_node"
    while mark in {c.lower() for c in docs.columns}:
        mark += "_"
    keyed = docs.withColumn(mark, text_key(F.col(text_col).cast("string")))

    def pick(part: DataFrame, how: str) -> DataFrame:
        part = checked_broadcast(part, 1_000_000)
        return keyed.join(part, keyed[id_col].eqNullSafe(part["doc"]) & keyed[mark].eqNullSafe(part["node"]), how)

    out = pick(marked.select("doc", "node"), "left_anti")
    repeated = marked.where("stays").select("doc", "node")
    if not repeated.isEmpty():
        out = out.unionByName(pick(repeated, "left_semi").dropDuplicates([id_col, mark]))
    return out.drop(mark)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, its size and whether it is the kept row, for each row of ``documents``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
