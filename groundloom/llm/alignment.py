"""Alignment of the tokens of two tokenizers, by interval coalescing.

The tokens of both tokenizers are intervals of bytes of the same text. Sorted by start, with the running maximum of their ends, a
new group begins where a start reaches that maximum: there a token of either side ends. All A-B pairs of a group are
linked. Tasks align whole Arrow slices at once in numpy; counts of linked id pairs over the corpus are Spark aggregations.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.bpe import byte_characters, public_vocabulary
from groundloom.llm.common import checked_broadcast, in_small_batches, table, written

# Fixed value of the byte-level vocabulary's format: the pieces of a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SLICE_CHARS = 250_000
PAIR_BLOCK = 1 << 20
BROADCAST_PAIRS = 2_000_000


class ByteTokens:
    """Byte-level BPE of a ``tokenizers`` file, encoded by the ``tiktoken`` library; special strings in a text are plain text.

    That library takes ranks for ids, which holds if the bytes come first and then the merges in order; other files are refused.
    """

    def __init__(self, spec: bytes):
        import tiktoken

        read = json.loads(spec)
        of = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        special = {t["content"]: t["id"] for t in read.get("added_tokens", [])}
        ranks = {b"".join([of[c] for c in token]): i for token, i in read["model"]["vocab"].items() if token not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
        order = [read["model"]["vocab"][a + b] for a, b in merges]
        if order != sorted(order) or read.get("normalizer") or read["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level vocabulary in the order of its merges")
        self.encoding = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in [*ranks.items(), *[(t.encode("utf-8"), i) for t, i in special.items()]]:
            self.bytes[i] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceTokens:
    """BPE with byte fallback of the ``sentencepiece`` library, which puts a space before the text by itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                      for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


def coalesce(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the intervals by start, and the group of each in that order (from 0)."""
    order = np.lexsort((end, start))
    first = start[order]
    reached = np.maximum.accumulate(end[order])
    cut = np.ones(len(order), bool)
    cut[1:] = first[1:] >= reached[:-1]
    return order, np.cumsum(cut) - 1


class Aligned:
    """Groups of the tokens of some texts.

    ``group`` and ``token`` of each side, by position; ``doc`` and the numbers of A and B tokens of each group.
    """

    def __init__(self, ids: tuple[list[list[int]], list[list[int]]], lengths: tuple[np.ndarray, np.ndarray], sizes: list[int]):
        begin = np.append(0, np.cumsum(np.array(sizes, np.int64)))
        self.token, start, end = [], [], []
        for side, width in zip(ids, lengths):
            token = np.fromiter(chain.from_iterable(side), np.int64, sum(map(len, side)))
            stop = np.cumsum(width[token])
            self.token.append(token)
            end.append(stop)
            start.append(stop - width[token])
        self.n = [np.array([len(one) for one in side], np.int64) for side in ids]
        na = len(self.token[0])
        order, group = coalesce(np.concatenate(start), np.concatenate(end))
        of = np.empty(len(order), np.int64)
        of[order] = group
        self.group = [of[:na], of[na:]]
        groups = int(group[-1]) + 1 if len(group) else 0
        self.count = [np.bincount(g, minlength=groups) for g in self.group]
        first = np.searchsorted(self.group[0], np.arange(groups))
        self.doc = np.searchsorted(begin, start[0][first], "right") - 1 if groups else np.zeros(0, np.int64)

    def links(self, docs: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, A id * width + B id, number of links) of each linked pair of ids, a range of documents at a time.

        Equal ids of a group are counted before the pairs are formed, so a long run of one token costs no square.
        """
        sides = []
        for token, group in zip(self.token, self.group):
            key, n = np.unique(group * width + token, return_counts=True)
            sides.append((key // width, key % width, n))
        (ga, a, na), (gb, b, nb) = sides
        first = np.searchsorted(gb, np.arange(len(self.doc) + 1))
        fan = np.diff(first)[ga]                                # B ids that meet each A id
        doc = self.doc[ga]
        ends = np.cumsum(fan)
        stops = np.searchsorted(doc, np.arange(docs), "right")  # entries of each document
        at, entry = 0, 0
        while at < docs:                                        # documents of about PAIR_BLOCK pairs together
            base = ends[entry - 1] if entry else 0
            until = int(np.searchsorted(ends, base + PAIR_BLOCK, "right"))
            upto = max(int(np.searchsorted(stops, until, "right")), at + 1)
            last = int(stops[upto - 1])
            pairs, counts, owners = [], [], []
            for i, j in self._blocks(ends, entry, last):
                reps = np.repeat(np.arange(i, j), fan[i:j])
                other = np.arange(len(reps)) - np.repeat(np.cumsum(fan[i:j]) - fan[i:j], fan[i:j]) + first[ga[reps]]
                key = a[reps] * width + b[other]
                p, d, c = summed(key, doc[reps], na[reps] * nb[other])
                pairs, owners, counts = [*pairs, p], [*owners, d], [*counts, c]
                if len(pairs) > 1:
                    p, d, c = summed(np.concatenate(pairs), np.concatenate(owners), np.concatenate(counts))
                    pairs, owners, counts = [p], [d], [c]
            if pairs:
                yield owners[0], pairs[0], counts[0]
            at, entry = upto, last

    @staticmethod
    def _blocks(ends: np.ndarray, i: int, last: int) -> Iterator[tuple[int, int]]:
        while i < last:
            base = ends[i - 1] if i else 0
            j = min(max(int(np.searchsorted(ends, base + PAIR_BLOCK, "right")), i + 1), last)
            yield i, j
            i = j

    def written(self, decimal: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each text.

        ``decimal`` has the digits of each id of a side in a row, filled up with 0, with room for the mark behind them.
        """
        before = [np.cumsum(self.count[1]) - self.count[1], np.cumsum(self.count[0])]     # tokens of the other side that come first
        place = [np.arange(len(t)) + b[g] for t, b, g in zip(self.token, before, self.group)]
        mark = np.full(len(place[0]) + len(place[1]), ord(","), np.uint8)
        out = np.zeros((len(mark), decimal[0].shape[1]), np.uint8)
        for p, t, d, g, m in zip(place, self.token, decimal, self.group, "|;"):
            out[p] = d[t]
            mark[p[np.append(g[1:] != g[:-1], True)] if len(p) else p] = ord(m)
        width = (out > 0).sum(1)
        out[np.arange(len(out)), width] = mark
        stop = np.cumsum(width + 1)
        flat = out[out > 0].tobytes()
        ends = np.append(0, stop)[np.append(0, np.cumsum(self.n[0] + self.n[1]))].tolist()
        return [flat[i:max(j - 1, i)] for i, j in zip(ends, ends[1:])]


def decimals(size: int) -> np.ndarray:
    """The digits of each number below ``size`` in a row of bytes, with at least one 0 behind them."""
    width = len(str(size)) + 1
    return np.frombuffer(b"".join([str(i).encode().ljust(width, b"\0") for i in range(size)]), np.uint8).reshape(size, width)


def summed(pair: np.ndarray, doc: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts summed over equal (document, pair)."""
    order = np.lexsort((pair, doc))
    pair, doc, count = pair[order], doc[order], count[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return pair[at], doc[at], np.add.reduceat(count, at) if len(at) else count


def _slices(column: pa.Array) -> Iterator[list[str]]:
    part, size = [], 0
    for value in column:
        part.append(value.as_py() or "")
        size += len(part[-1])
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", id_col: str = "doc_id",
          digests: bool = False) -> DataFrame:
    """(row, id_col, n_a, n_b, n_groups, n_links, groups, pairs) of each row of ``docs``, as a written table.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` with the ids of both sides in order (its SHA-256 with ``digests``; empty without
    tokens). ``pairs`` holds each linked (A id * size of B + B id) once, with its number of links. ``row`` numbers
    the rows. A text is aligned only if the tokens of both sides spell a space and the text; null and empty texts have
    no tokens. A text may be of any length: pairs are formed in blocks. Extra columns are not read.
    The vocabularies are files of a few MB, read by the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        shared = spark.sparkContext.broadcast((f.read(), g.read()))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    pair_type = pa.struct([("pair", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = ByteTokens(shared.value[0]), PieceTokens(shared.value[1])
        lengths = tuple(np.array([len(b) for b in s.bytes], np.int64) for s in sides)
        width = max(len(s.bytes) for s in sides)
        decimal = tuple(decimals(width)[:len(s.bytes)] for s in sides)
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(2)):
                ids = tuple(s.encode(texts) for s in sides)
                spelled = [(" " + t).encode("utf-8") if t else b"" for t in texts]
                for i, want in enumerate(spelled):
                    if not want or any(b"".join(map(s.bytes.__getitem__, one[i])) != want for s, one in zip(sides, ids)):
                        ids[0][i], ids[1][i], spelled[i] = [], [], b""
                found = Aligned(ids, lengths, [len(t) for t in spelled])
                n = len(texts)
                links = np.bincount(found.doc, found.count[0] * found.count[1], minlength=n).astype(np.int64)
                groups = [hashlib.sha256(g).hexdigest() if g and digests else g.decode() for g in found.written(decimal)]
                done = 0
                for doc, pair, count in [*found.links(n, width), (np.array([n - 1]), np.zeros(0, np.int64), np.zeros(0, np.int64))]:
                    upto = int(doc[-1]) + 1                     # texts after the last without pairs come with the next range
                    if upto <= done:
                        continue
                    offsets = np.searchsorted(doc[:len(pair)], np.arange(done, upto + 1))
                    items = pa.StructArray.from_arrays([pa.array(pair, pa.int64()), pa.array(count, pa.int64())], fields=list(pair_type))
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(at + done, upto - done), batch.column(1).slice(at + done, upto - done),
                        pa.array(found.n[0][done:upto]), pa.array(found.n[1][done:upto]),
                        pa.array(np.bincount(found.doc, minlength=n)[done:upto].astype(np.int64)), pa.array(links[done:upto]),
                        pa.array(groups[done:upto], pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)],
                        ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])
                    done = upto
                at += n

    found = in_small_batches(rows).mapInArrow(
        run, f"row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
             "pairs array<struct<pair:bigint,links:bigint>>")
    return written(found, "aligned").withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): in how many rows each pair of ids is linked, and whether no other pair of its A id has more."""
    counts = written(aligned.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    a_id = F.expr(f"pair div {width}")
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))                     # at most one row per A id
    return counts.join(F.broadcast(most), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def consistency(aligned: DataFrame, width: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of each row with links: the links whose pair is the commonest of its A id, and the pairs' counts.

    A table of at most ``broadcast_pairs`` pairs (three short columns) is broadcast, a larger one is joined by a shuffle.
    """
    counts = checked_broadcast(written(pair_counts(aligned, width), "pair_counts"), broadcast_pairs)
    each = aligned.select("row", F.inline("pairs")).join(counts, "pair")
    return each.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("links") * F.col("n")).alias("count_sum"))


def aligned_tokens(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", id_col: str = "doc_id",
                   digests: bool = False, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each row of ``docs``; see :func:`align`.

    Each row counts as a document of its own, repeated rows and rows without id too. An empty table gives an empty result.
    """
    width = pair_width(a_path, b_path)
    found = align(docs, a_path, b_path, text_col, id_col, digests)
    sums = consistency(found, width, broadcast_pairs)
    return found.drop("pairs").join(sums, "row", "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups")


def pair_width(a_path: str, b_path: str) -> int:
    """The factor that packs two ids into one number: the larger of both vocabularies."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        return max(len(ByteTokens(f.read()).bytes), len(PieceTokens(g.read()).bytes))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of byte_bpe_50k and piece_bpe_32k tokens for each row of ``documents``."""
    out = aligned_tokens(table(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_50k.json"),
                         public_vocabulary("piece_bpe_32k.model"), digests=True)
    return out.withColumnRenamed("groups", "groups_sha256")
