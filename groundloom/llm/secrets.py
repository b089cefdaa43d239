"""Secrets in whole texts: fixed patterns, and character Markov models that tell random strings from identifiers.

Only DataFrame functions work here. The two models are transition counts over ``ALPHABET``; a token is a secret if the
random model explains it clearly better than the identifier model. Both are trained from samples labelled by the patterns:
what a pattern has found is random, letters-only names are ordinary.
"""

from __future__ import annotations

import random as chance

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.llm.common import hash_sample

SAMPLE_DOCS = 20_000      # documents, about, from which labelled strings are taken
LEAST_MEAN = 0.5          # log-likelihood ratio per transition
LEAST_TOTAL = 10.0
BACK_OFF = 20.0

# The three patterns that find secrets by their form, with head and value as groups 1 and 2, and least length.
PATTERNS = {
    "assign": (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
               r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 12),
    "access": (r"()(AKIA[A-Z0-9]+)", 18),
    "hex": (r"()([0-9a-f]{16,})", 16),
}
KINDS = [*PATTERNS, "random"]
# The least length of a token or part of one: that of the shortest secret that a pattern takes. The totals alone cannot decide
# it, since ordinary names have no digits and a number of two digits has more than LEAST_TOTAL.
TOKEN_LENGTH = min(least for _, least in PATTERNS.values())
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
TOKEN = rf"()([A-Za-z0-9+/_=-]{{{TOKEN_LENGTH},}})"
PART = rf"()([A-Za-z0-9+]{{{TOKEN_LENGTH},}})"
NAME = r"(?<![A-Za-z0-9+/_=.-])[A-Za-z_]{8,}(?![A-Za-z0-9+/_=.-])"
# A universally unique identifier names a thing and is no secret.
NAMES_A_THING = r"()((?<![0-9a-fA-F-])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F-]))"
_MARK = "\u0001"
CHUNK = 128                  # matches or spans that are gathered one by one; lists of lists hold the rest


def matches(text: Column, pattern: str, passes) -> Column:
    """array<struct<start, stop, value>> of the matches, from the left without overlap, whose value ``passes``.

    The work is linear in the text: lists are built ``CHUNK`` matches at a time, the beginnings of chunks from their lengths.
    The matches are set off by a mark (which no pattern matches, and which the text is freed of) and the pieces between
    marks are measured in turn, in code points. ``start`` to ``stop`` is the whole match, ``value`` its second group.
    """
    clean = F.translate(text, _MARK, "\u0002")
    pieces = F.split(F.regexp_replace(clean, F.lit(pattern), F.lit(f"{_MARK}$1{_MARK}$2{_MARK}")), _MARK)
    turns = F.expr("CAST(array() AS array<struct<start:int,stop:int,value:string>>)")

    def step(acc: Column, i: Column, p: Column) -> Column:
        start = acc["at"] + F.length(F.get(p, i * 3))
        value = F.get(p, i * 3 + 2)
        stop = start + F.length(F.get(p, i * 3 + 1)) + F.length(value)
        one = F.struct(start.alias("start"), stop.alias("stop"), value.alias("value"))
        return F.struct(stop.alias("at"), F.when(passes(value), F.concat(acc["found"], F.array(one)))
                        .otherwise(acc["found"]).alias("found"))

    def measured(p: Column) -> Column:
        count = ((F.size(p) - 1) / 3).cast("int")
        chunks = F.ceil(count / CHUNK).cast("int")
        # where each chunk of matches begins
        begins = F.when(chunks == 1, F.array(F.lit(0))).otherwise(F.aggregate(
            F.sequence(F.lit(0), chunks - 2), F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(
                F.element_at(acc, -1) + F.aggregate(F.slice(p, c * (3 * CHUNK) + 1, F.lit(3 * CHUNK)), F.lit(0),
                                                    lambda n, s: n + F.length(s))))))
        return _once(begins, lambda at: F.flatten(F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.aggregate(
            F.sequence(c * CHUNK, F.least(c * CHUNK + (CHUNK - 1), count - 1)),
            F.struct(F.get(at, c).alias("at"), turns.alias("found")), lambda acc, i: step(acc, i, p), lambda acc: acc["found"]))))

    return F.when(text.rlike(pattern), _once(pieces, measured)).otherwise(turns)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def base_matches(text: Column) -> list[Column]:
    def long_enough(least: int):
        return lambda value: F.length(value) >= least

    return [matches(text, pattern, long_enough(least)).alias(kind) for kind, (pattern, least) in PATTERNS.items()]


def place(c: Column) -> Column:
    """Place of a character in the alphabet from 1 on, 0 for any other."""
    return F.instr(F.lit(ALPHABET), c)


def ordinary_numbers(count: int = 600, seed: int = 7) -> list[str]:
    """Ordinary strings with digits, made by rule: dates and times, telephone and account numbers, versions, numbered names, paths."""
    rng = chance.Random(seed)

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    words = "report final draft version article section chapter room user item page photo image data copy part index".split()
    out = []
    for _ in range(count):
        day = (rng.randint(1950, 2035), rng.randint(1, 12), rng.randint(1, 28))
        clock = (rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59))
        word, other, year = rng.choice(words), rng.choice(words), str(day[0])
        out += ["%04d-%02d-%02d" % day, "%04d%02d%02d" % day, "%04d/%02d/%02d" % day, "%04d%02d%02d%02d%02d%02d" % (*day, *clock),
                "%04d-%02d-%02dT%02d" % (*day, clock[0]), "+" + digits(rng.randint(9, 13)), "978-" + digits(1) + "-" + digits(5) + "-" + digits(4),
                digits(rng.randint(4, 16)), f"{digits(3)}-{digits(3)}-{digits(4)}", f"{word}{year}{other}", f"{word}_{year}_{digits(2)}",
                f"{word}-{digits(3)}", f"{word}/{other}/{digits(rng.randint(4, 12))}", f"{word}{digits(2)}"]
    return out


def model_scores(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratio, random against ordinary, of each character transition.

    A transition's rate is drawn toward the rate of its second character by ``BACK_OFF`` transitions.

    The labelled strings come from about ``sample_docs`` documents chosen by the hash of their text, and from
    :func:`ordinary_numbers`, as the names that the documents show have no digits. The result has
    (len(ALPHABET) + 1)^2 entries whatever the data; without samples all are 0 and no span is added.
    """
    n = len(ALPHABET) + 1
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chosen = hash_sample(docs.select(text.alias("text")), F.col("text"), sample_docs)
    values = F.flatten(F.array(*[F.transform(m, lambda s: s["value"]) for m in base_matches(F.col("text"))]))
    found = chosen.select(values.alias("random"), F.regexp_extract_all("text", F.lit(NAME), F.lit(0)).alias("ordinary"))
    strings = found.select(F.explode(F.col("random")).alias("s"), F.lit(1).alias("label")).unionByName(
        found.select(F.explode(F.col("ordinary")).alias("s"), F.lit(0).alias("label")))
    pairs = strings.select("label", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("s") - 1),
        lambda i: place(F.substring("s", i, F.lit(1))) * n + place(F.substring("s", i + 1, F.lit(1))))).alias("pair"))
    counts = np.zeros((2, n * n))
    for r in pairs.groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n")).collect():      # at most 2 n^2 rows
        counts[r["label"], r["pair"]] += r["n"]
    if not counts.sum(axis=1).all():
        return np.zeros(n * n)
    where = {c: i + 1 for i, c in enumerate(ALPHABET)}
    for s in ordinary_numbers():
        for a, b in zip(s, s[1:]):
            counts[0, where[a] * n + where[b]] += 1
    rates = counts.reshape(2, n, n)
    single = rates.sum(axis=1, keepdims=True) + 0.5
    single /= single.sum(axis=2, keepdims=True)
    rates = np.log((rates + BACK_OFF * single) / (rates.sum(axis=2, keepdims=True) + BACK_OFF))
    return (rates[1] - rates[0]).ravel()


def likelihood_ratio(value: Column, scores: np.ndarray) -> Column:
    """Sum of the transition scores of a string."""
    n = len(ALPHABET) + 1
    known = F.lit(scores)
    chars = F.split(value, "")
    return F.aggregate(
        chars, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(place(c).alias("last"), F.when(acc["last"] < 0, 0.0).otherwise(
            acc["sum"] + F.get(known, acc["last"] * n + place(c))).alias("sum")),
        lambda acc: acc["sum"])


def find_secrets(docs: DataFrame, scores: np.ndarray, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: array<struct<start, kind_no, kind, stop>> of all spans, by start and kind.

    Kinds are those of ``PATTERNS`` and ``random``: a token of at least ``TOKEN_LENGTH`` characters, or else a part of as many
    between / = _ -, that the random model prefers and that no span found by a pattern covers; the two may overlap. A null text is empty and has no span. Existing columns stay;
    a clash with ``out`` or an internal name (beginning with ``_sec_``) is an error of the caller.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def random(value: Column) -> Column:
        ratio = likelihood_ratio(value, scores)
        return (ratio >= LEAST_TOTAL) & (ratio >= LEAST_MEAN * (F.length(value) - 1))

    rows = docs.select("*", text.alias("_sec_text"))
    rows = rows.select("*", *[m.alias(f"_sec_{k}") for k, m in zip(PATTERNS, base_matches(F.col("_sec_text")))],
                       matches(F.col("_sec_text"), TOKEN, random).alias("_sec_random"),
                       matches(F.col("_sec_text"), PART, random).alias("_sec_part"),
                       matches(F.col("_sec_text"), NAMES_A_THING, lambda value: F.lit(True)).alias("_sec_at_plain"))
    spans = {k: _of_kind(f"_sec_{k}", no, k) for no, k in enumerate(KINDS)}
    parts = _of_kind("_sec_part", len(PATTERNS), KINDS[-1])
    rows = rows.select("*", *[s.alias(f"_sec_at_{k}") for k, s in spans.items()], parts.alias("_sec_parts"))
    # a secret at the end of an ordinary path or name is found as a part
    whole = _uncovered("_sec_at_random", [*(f"_sec_at_{k}" for k in PATTERNS), "_sec_at_plain"])
    part = _uncovered("_sec_parts", [*(f"_sec_at_{k}" for k in KINDS), "_sec_at_plain"])
    rows = rows.select("*", F.sort_array(F.concat(*[f"_sec_at_{k}" for k in PATTERNS], whole, part)).alias(out))
    return rows.drop("_sec_text", "_sec_part", "_sec_parts", "_sec_at_plain", *[f"_sec_{k}" for k in KINDS], *[f"_sec_at_{k}" for k in KINDS])


def _uncovered(spans: str, by: list[str]) -> Column:
    """The spans that none of the lists ``by`` covers. Each list is in order without overlaps, so only the last that does
    not begin later can cover a span; it is found by halving."""
    def covered(m: Column, b: str) -> Column:
        steps = F.floor(F.log2(F.size(b))).cast("int")
        upto = F.aggregate(F.sequence(F.lit(0), steps), F.lit(0), lambda n, k: F.when(
            F.get(b, n + F.call_function("shiftleft", F.lit(1), steps - k) - 1)["start"] <= m["start"],
            n + F.call_function("shiftleft", F.lit(1), steps - k)).otherwise(n))
        return F.when(F.size(b) > 0, F.coalesce(F.get(b, upto - 1)["stop"] >= m["stop"], F.lit(False))).otherwise(False)

    def free(m: Column) -> Column:
        out = ~covered(m, by[0])
        for b in by[1:]:
            out = out & ~covered(m, b)
        return out

    return F.filter(spans, free)


def _of_kind(column: str, no: int, kind: str) -> Column:
    return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"),
                                                  F.lit(kind).alias("kind"), s["stop"].alias("stop")))


def redacted(docs: DataFrame, scores: np.ndarray, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in the text replaced by ``mark`` (overlapping spans by one); null stays null."""
    columns = docs.columns
    rows = find_secrets(docs, scores, text_col, "_sec_spans")
    spans, none = F.col("_sec_spans"), F.expr("CAST(array() AS array<string>)")
    start = F.struct(F.lit(0).alias("at"), none.alias("parts"))

    def chunk(acc: Column, c: Column) -> Column:
        some = F.slice(spans, c * CHUNK + 1, F.lit(CHUNK))
        first = acc["at"]
        last = F.element_at(some, -1)["start"]                # spans are in order of their start
        here = F.substring(F.col(text_col), first + 1, F.greatest(last - first, F.lit(0)))

        def step(a: Column, s: Column, text: Column) -> Column:
            gap = F.substring(text, a["at"] - first + 1, s["start"] - a["at"])
            return F.struct(F.greatest(a["at"], s["stop"]).alias("at"),
                            F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(gap, F.lit(mark))))
                            .otherwise(a["parts"]).alias("parts"))

        done = _once(here, lambda text: F.aggregate(some, F.struct(first.alias("at"), none.alias("parts")),
                                                    lambda a, s: step(a, s, text)))
        return _once(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["parts"], F.array(F.array_join(d["parts"], ""))).alias("parts")))

    joined = F.aggregate(F.sequence(F.lit(0), F.ceil(F.size(spans) / CHUNK).cast("int") - 1), start, chunk, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(F.col(text_col), acc["at"] + 1, F.length(F.col(text_col)))))
    new = F.when(F.size("_sec_spans") == 0, F.col(text_col)).otherwise(joined)
    return rows.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns])


def listed(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["stop"].cast("string"))), ",")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the pattern spans, their digest and the list of all spans, for each row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs, model_scores(docs)).drop("text")
    base = F.filter("spans", lambda s: s["kind_no"] < len(PATTERNS))

    def number(no: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind_no"] == no)).cast("bigint")

    return found.select("doc_id", *[number(no).alias(f"n_{k}") for no, k in enumerate(PATTERNS)],
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        number(len(PATTERNS)).alias("n_random"))
