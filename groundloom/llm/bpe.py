"""Byte-pair encoding and decoding of whole texts with a public vocabulary, by batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import in_small_batches

# Fixed values of the vocabulary's format: pieces of a text, and the end mark of a word.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

PIECES_PER_ROUND = 20_000
KNOWN_PIECES = 100_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b) if b in shown else chr(spare))
        spare += b not in shown
    return out


class Vocabulary:
    """Arrays of a merge vocabulary. Pairs of symbols are keys left * size + right, sorted, with rank and result."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * self.size
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.decimal = [str(i) for i in range(self.size)]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        result = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.result = keys[order], order, result[order]
        marks = byte_characters()
        self.inner = np.array([ids[m] for m in marks], np.int64)
        self.final = np.array([ids[m + WORD_END] for m in marks], np.int64)
        self.split_special = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or "(?!)")
        self.pieces = regex.compile(PIECES)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each non-empty piece.

        The symbols of all pieces lie in one array. In each round every piece merges its pair of lowest rank,
        wherever it stands in it; pieces without a known pair leave.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.final[raw[ends - 1]]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        none = len(self.keys)
        done_symbols, done_piece = [], []
        while len(symbols):
            pair = symbols[:-1] * self.size + symbols[1:]
            at = np.searchsorted(self.keys, pair)
            at[at == none] = 0
            known = (self.keys[at] == pair) & (piece[:-1] == piece[1:])
            rank = np.append(np.where(known, self.rank[at], none), none)
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            sizes = np.diff(np.append(first, len(piece)))
            best = np.minimum.reduceat(rank, first)
            alive = best < none
            if not alive.all():
                stays = np.repeat(alive, sizes)
                done_symbols.append(symbols[~stays])
                done_piece.append(piece[~stays])
                symbols, piece, rank = symbols[stays], piece[stays], rank[stays]
                at = np.append(at, 0)[stays]
                best, sizes = best[alive], sizes[alive]
                if not len(symbols):
                    break
            else:
                at = np.append(at, 0)
            merge = rank == np.repeat(best, sizes)
            if (merge[1:] & merge[:-1]).any():      # a symbol paired with itself: from the left, every other one
                place = np.arange(len(merge))
                begin = np.maximum.accumulate(np.where(merge & ~np.append(False, merge[:-1]), place, 0))
                merge &= (place - begin) % 2 == 0
            symbols = np.where(merge, self.result[at], symbols)
            keep = np.append(True, ~merge[:-1])
            symbols, piece = symbols[keep], piece[keep]
        if not done_symbols:
            return []
        symbols, piece = np.concatenate(done_symbols), np.concatenate(done_piece)
        order = np.argsort(piece, kind="stable")
        flat = symbols[order].tolist()
        stops = np.cumsum(np.bincount(piece, minlength=len(pieces))).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def parts(self, text: str) -> Iterator[str | int]:
        """Pieces of a text, and the ids of special tokens where their strings stand."""
        at = 0
        for m in self.split_special.finditer(text):
            yield from self._plain(text[at:m.start()])
            yield self.special[m.group()]
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # lower case goes character by character, without the final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pieces.findall(text.lower())

    def encode_texts(self, texts: list[str], known: dict[str, list[int]]) -> list[list[int]]:
        """Ids of each text. ``known`` keeps the ids of pieces between calls and is emptied when it is large."""
        parts = [list(self.parts(t)) for t in texts]
        fresh = list({p for ps in parts for p in ps if p.__class__ is str and p not in known})
        if len(known) + len(fresh) > KNOWN_PIECES:
            known.clear()
            fresh = list({p for ps in parts for p in ps if p.__class__ is str})
        for i in range(0, len(fresh), PIECES_PER_ROUND):
            chunk = fresh[i:i + PIECES_PER_ROUND]
            known.update(zip(chunk, self.encode_pieces([p.encode("utf-8") for p in chunk])))
        out = []
        for ps in parts:
            ids: list[int] = []
            for p in ps:
                if p.__class__ is str:
                    ids += known[p]
                else:
                    ids.append(p)
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: the vocabulary has no decoder of its own."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def _texts(column: pa.Array, limit: int = 1_000_000) -> Iterator[list[str]]:
    part, size = [], 0
    for value in column:
        text = value.as_py() or ""
        part.append(text)
        size += len(text)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", id_col: str = "doc_id",
           digests: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids, decoded) of each row of ``docs``; ``digests`` gives their SHA-256 instead.

    The vocabulary is read once by the driver (a file of a few MB, whatever the data) and broadcast. Each task goes
    through its texts in slices of about a million characters, so memory does not grow with the table.
    A null text is an empty text: no tokens. Other columns are not read, so their names and nulls do not matter;
    repeated rows give repeated results.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = Vocabulary(shared.value), {}
        decimal = vocabulary.decimal
        for batch in batches:
            at = 0
            for texts in _texts(batch.column(1)):
                ids = vocabulary.encode_texts(texts, known)
                columns = [batch.column(0).slice(at, len(texts)), pa.array([len(x) for x in ids], pa.int64())]
                at += len(texts)
                if digests:
                    columns.append(pa.array([sha(" ".join([decimal[i] for i in x])) for x in ids], pa.string()))
                    columns.append(pa.array([sha(vocabulary.decode(x)) for x in ids], pa.string()))
                else:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    columns.append(pa.array([vocabulary.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", *[f.split()[0] for f in fields.split(", ")]])

    return in_small_batches(source).mapInArrow(run, f"id {id_type}, n_tokens bigint, {fields}").withColumnRenamed("id", id_col)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text, for each row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return encode(docs, public_vocabulary(), digests=True)
