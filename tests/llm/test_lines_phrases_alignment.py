"""Line dedup, collocations and token alignment against brute force and on odd tables."""

import collections
import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from groundloom.llm import alignment, lines, phrases
from groundloom.llm.bpe import byte_characters, public_vocabulary

LONG = "\n".join(["one and the same long line", "a line of its own %d", "short"] * 4_000)
LONG = "\n".join(s % i if "%d" in s else s for i, s in enumerate(LONG.split("\n")))
ROWS = [(1, "Alpha beta gamma\n\n  one and the SAME long line\t\nshort", "en"), (2, "one and the same long line\nalpha BETA gamma \nx", "en"),
        (2, "one and the same long line\nalpha BETA gamma \nx", "en"), (3, None, None), (4, "", "de"), (5, LONG, "en"),
        (6, "ünïcödé lïne hérè\n\nÜNÏCÖDÉ lïne hérè", "fr"), (7, "ünïcödé lïne hérè", None),
        (None, "one and the same long line\nonly without an id", "en"), (None, "only without an id\n\x0b\x0c", "en"), (8, "\n\n\n", "en"),
        (9, "only here, only here\nonly here, only here", "en")]
SCHEMA = "doc_id bigint, text string, lang string"


def crowded(df):
    for name in "doc pos key line k1 t1 salt keeper row id pair n f w1 w2 a l r phrase score words level size of dropped".split():
        df = df.withColumn(name, F.lit(None).cast("int"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return crowded(spark.createDataFrame(ROWS, SCHEMA))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_lines(rows, least_docs=2):
    holders = collections.defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[lower(line.strip(lines.BLANKS))].add(i)
    out = []
    for i, text, *_ in rows:
        all_ = (text or "").split("\n")

        def lost(line):
            key = lower(line.strip(lines.BLANKS))
            ids = holders[key]
            named = [x for x in ids if x is not None]
            return len(key) >= 10 and len(ids) >= least_docs and bool(named) and i != min(named)

        kept = [x for x in all_ if not lost(x)]
        out.append((i, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


@pytest.mark.parametrize("least_docs,hot_docs", [(2, 1_000_000), (2, 1), (3, 1_000_000)])
def test_lines_by_brute_force(docs, least_docs, hot_docs):
    got = lines.dedup_lines(docs, least_docs=least_docs, hot_docs=hot_docs).collect()
    assert collections.Counter(map(tuple, got)) == brute_lines(ROWS, least_docs)


def test_lines_of_nothing(docs):
    assert lines.dedup_lines(docs.limit(0)).collect() == []


def brute_phrases(rows, least, top):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            counts.update((lang or "und", tuple(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    held = collections.defaultdict(int)
    for (lang, p), f in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                held[lang, p[i:i + k]] = max(held[lang, p[i:i + k]], f)
    out = collections.defaultdict(list)
    for (lang, p), a in candidates.items():
        if held[lang, p] and 100 * held[lang, p] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


@pytest.mark.parametrize("least,top", [(2, 2000), (3, 7)])
def test_phrases_by_brute_force(spark, least, top):
    rng = random.Random(5)
    vocabulary = ["new", "york", "City", "of", "the", "é", "1-2", "Zürich"]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", ", ", ".\n"]) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "de", None])) for i in range(40)] + ROWS[:5] + ROWS[6:]
    got = phrases.collocations(crowded(spark.createDataFrame(rows, SCHEMA)), least=least, top=top).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, least, top)


def test_phrases_of_nothing_and_long_texts(docs):
    assert phrases.collocations(docs.limit(0)).collect() == []
    got = {r["phrase"]: r["a"] for r in phrases.collocations(docs).collect() if r["lang"] == "en"}
    assert got["one and the same"] == 4_004 and got["the same long line"] == 4_004


def test_scores_beyond_64_bits(spark):
    big = 5 * 10 ** 13
    rows = [("en", 1, ["a"], 2 * big), ("en", 1, ["b"], 3 * big), ("en", 2, ["a", "b"], big)]
    got = phrases.cut_scores(spark.createDataFrame(rows, "lang string, size int, words array<string>, f bigint")).first()
    assert (got["score"], got["l"], got["r"]) == (2_000_000 * big // (5 * big), 2 * big, 3 * big)


def test_coalescing_splits_where_both_end():
    # A ends at 2, 5, 6, 9 and B at 1, 5, 9: groups end at 5 and 9
    start, end = np.array([0, 2, 5, 6, 0, 1, 5]), np.array([2, 5, 6, 9, 1, 5, 9])
    order, group = alignment.coalesce(start, end)
    of = dict(zip(order.tolist(), group.tolist()))
    assert [of[i] for i in range(7)] == [0, 0, 1, 1, 0, 0, 1]


def brute_alignment(rows):
    a = Tokenizer.from_file(public_vocabulary("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_vocabulary("piece_bpe_32k.model"))
    byte = {c: i for i, c in enumerate(byte_characters())}
    width = max(a.get_vocab_size(), b.vocab_size())
    found, counts = [], collections.Counter()
    for _, text, *_ in rows:
        text = text or ""
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spelled = [[bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]],
                   [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids[1])]]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            found.append(((0, 0), []))
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        groups, at = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            upto = [e.index(cut) + 1 for e in ends]
            groups.append([side[i:j] for side, i, j in zip(ids, at, upto)])
            at = upto
        found.append(((len(ids[0]), len(ids[1])), groups))
        counts.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    best = collections.Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (i, *_), (n, groups) in zip(rows, found):
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        out.append((i, *n, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)))
    assert width == alignment.pair_width(public_vocabulary("byte_bpe_50k.json"), public_vocabulary("piece_bpe_32k.model"))
    return collections.Counter(out)


TEXTS = ["Tokenizers disagree, e.g. about counterrevolutionaries!", "<|endoftext|> and <s> are plain </s> text", "spell ▁ this", "ﬁne ligature",
         "日本語のテキスト 😀😀 ünïcödé", "   many   blanks \n\n\t and tabs  ", "x" * 5_000 + " " + "1234567890" * 300, "\u0000 zero", "é combining"]


@pytest.mark.parametrize("broadcast_pairs", [2_000_000, 0])
def test_alignment_by_brute_force(spark, broadcast_pairs):
    rows = ROWS[:5] + ROWS[6:] + [(100 + i, t, "en") for i, t in enumerate(TEXTS)]
    got = alignment.aligned_tokens(crowded(spark.createDataFrame(rows, SCHEMA)), public_vocabulary("byte_bpe_50k.json"),
                                   public_vocabulary("piece_bpe_32k.model"), broadcast_pairs=broadcast_pairs).collect()
    assert collections.Counter(map(tuple, got)) == brute_alignment(rows)


def test_pairs_are_the_same_in_small_blocks(monkeypatch):
    sides = (alignment.ByteTokens(open(public_vocabulary("byte_bpe_50k.json"), "rb").read()),
             alignment.PieceTokens(open(public_vocabulary("piece_bpe_32k.model"), "rb").read()))
    texts = ["", *TEXTS[:2], "", "y" * 3_000 + "z", TEXTS[4], ""]
    ids = tuple(s.encode(texts) for s in sides)
    ids[0][0], ids[0][3], ids[0][6] = [], [], []
    lengths = tuple(np.array([len(b) for b in s.bytes]) for s in sides)
    found = alignment.Aligned(ids, lengths, [len((" " + t).encode()) if t else 0 for t in texts])

    def pairs():
        return [tuple(x) for part in found.links(len(texts), 60_000) for x in zip(*(p.tolist() for p in part))]

    whole = pairs()
    monkeypatch.setattr(alignment, "PAIR_BLOCK", 7)
    assert pairs() == whole and len({p[:2] for p in whole}) == len(whole)


def test_alignment_of_nothing_and_long_texts(docs):
    paths = public_vocabulary("byte_bpe_50k.json"), public_vocabulary("piece_bpe_32k.model")
    assert alignment.aligned_tokens(docs.limit(0), *paths).collect() == []
    got = {r["doc_id"]: r for r in alignment.aligned_tokens(docs, *paths, digests=True).collect()}
    assert got[5]["n_groups"] > 10_000 and len(got[5]["groups"]) == 64
    assert tuple(got[3])[1:] == tuple(got[4])[1:] == (0, 0, 0, 0, 0, 0, "")
