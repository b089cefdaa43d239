"""Document fingerprints by consistent weighted sampling, with DataFrame functions alone.

The terms of a text are its pairs of neighbouring lower-cased words, weighted by how often they occur. For each of
``SAMPLES`` samples a term has r and c from Gamma(2, 1) and b from [0, 1), all taken from its hash. With the weight w,
t = floor(ln w / r + b), and the sample is the (term, t) of least c exp(-r (t - b + 1)). Two texts agree in a sample with the
probability of their generalised Jaccard similarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundloom.llm.common import written

SAMPLES = 32
ROWS_PER_RANGE = 256
MAX_RANGES = 1 << 16
DIGITS = 4
NO_TERMS = "0" * (SAMPLES * DIGITS)
_STEP = 0x9E3779B97F4A7C15


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` needs it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def weighted_terms(text: Column) -> Column:
    """array<struct<term, weight>> of the distinct word pairs of a text, by hash; the first word counts with a blank before it.

    The hashes are sorted and the places counted at which a new one begins, so the work is that of a sort however long
    the text is. A text without words gives an empty array.
    """
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def pairs(w: Column) -> Column:
        return F.sort_array(F.transform(w, lambda x, i: F.xxhash64(F.when(i == 0, "").otherwise(F.get(w, i - 1)), x)))

    def counted(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return _bound(begins, lambda b: F.transform(b, lambda at, j: F.struct(
            F.get(s, at).alias("term"), (F.coalesce(F.get(b, j + 1), F.size(s)) - at).alias("weight"))))

    none = F.expr("CAST(array() AS array<struct<term:bigint,weight:int>>)")
    return _bound(words, lambda w: F.when(F.size(w) == 0, none).otherwise(_bound(pairs(w), counted)))


def _key(number: int) -> Column:
    value = (number * _STEP) & ((1 << 64) - 1)
    return F.lit(value - (1 << 64) if value >> 63 else value)


def samples(term: Column, weight: Column, log_weight: Column, count: int = SAMPLES) -> list[Column]:
    """For each sample a number whose least over the terms has the sampled (term, t) in its lower 32 bits.

    With e1 and e2 from Exp(1), r = e1 + e2 is from Gamma(2, 1) and b = e1 / r from [0, 1), independent of each other. So
    r (1 - b) is e2 = -ln u, and the value c u exp(-r t) needs no logarithm of u while t is 0, as it is at weight 1. The
    order is that of the square root, which leaves small values, the least of many terms, enough steps.
    """
    out = []
    for k in range(count):
        tag = term.bitwiseXOR(_key(2 * k + 1))
        one = F.xxhash64(tag)
        part = F.lit(0x1FFFFF)
        u = (F.shiftrightunsigned(one, 42) + 0.5) * 2.0 ** -22
        c = -F.ln((F.shiftrightunsigned(one, 21).bitwiseAND(part) + 0.5) * (one.bitwiseAND(part) + 0.5) * 2.0 ** -42)
        e1 = -F.ln((F.shiftrightunsigned(F.xxhash64(term.bitwiseXOR(_key(2 * k + 2))), 11) + 0.5) * 2.0 ** -53)
        r = e1 - F.ln(u)
        t = F.floor((log_weight + e1) / r)

        light = weight == 1
        value = c * u * F.when(light, 1.0).otherwise(F.exp(-r * t))
        mark = tag + F.when(light, F.lit(0).cast("bigint")).otherwise(t.bitwiseAND(F.lit(0xFFFFF)) * 0x9E3779B1)
        place = (F.sqrt(value) * 2.0 ** 28).cast("bigint")
        out.append(F.shiftleft(place, 32).bitwiseOR(mark.bitwiseAND(F.lit(0xFFFFFFFF))))
    return out


def digits(least: Column) -> Column:
    return F.lower(F.substring(F.hex(least.bitwiseAND(F.lit(0xFFFF)) + 0x10000), 2, DIGITS))


def likeness(a: Column, b: Column) -> Column:
    """Share of the samples in which two fingerprints agree, which estimates the generalised Jaccard similarity."""
    same = [F.when(F.substring(a, 1 + DIGITS * k, DIGITS) == F.substring(b, 1 + DIGITS * k, DIGITS), 1).otherwise(0)
            for k in range(SAMPLES)]
    return sum(same[1:], same[0]) / F.lit(float(SAMPLES))


def fingerprints(rows: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, fingerprint) of each row. If ``rows`` is partitioned by some of ``keys``, nothing is shuffled.

    The keys identify a row. The samples of a text are least values over its terms, combined as the terms appear.
    """
    terms = rows.select(*keys, F.inline_outer(weighted_terms(F.col(text_col)))).withColumn("lw", F.ln(F.col("weight")))
    least = terms.groupBy(*keys).agg(*[F.min(s).alias(f"s{k}")
                                        for k, s in enumerate(samples(F.col("term"), F.col("weight"), F.col("lw")))])
    joined = F.concat(*[digits(F.col(f"s{k}")) for k in range(SAMPLES)])
    return least.select(*keys, F.coalesce(joined, F.lit(NO_TERMS)).alias("fingerprint"))


def placed(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``part``, the number of the range of ``order`` that the row is in.

    The limits are approximate quantiles, at most ``MAX_RANGES`` of them, and are searched by halving. Null comes first.
    """
    count = rows.count()
    ranges = min(max(count // ROWS_PER_RANGE, 1), MAX_RANGES)
    if ranges == 1:
        return rows.withColumn("part", F.lit(0))
    at = [i / ranges for i in range(1, ranges)]
    limits = rows.agg(F.percentile_approx(order, at, 10 * ranges).alias("q")).first()["q"] or []
    limits = sorted(set(limits))
    known = F.from_json(F.lit(str(limits)), "array<bigint>")
    jumps = F.array(*[F.lit(1 << i) for i in reversed(range(len(limits).bit_length()))] or [F.lit(0)])
    below = F.aggregate(jumps, F.lit(0), lambda n, jump: F.when(
        F.get(known, n + jump - 1) <= F.col(order), n + jump).otherwise(n))
    return rows.withColumn("part", below)


def neighbours(rows: DataFrame, parts: DataFrame, value: str, within: list[str], out: str) -> DataFrame:
    """``rows`` (with ``part``) with ``out``: ``value`` of the next row by (part, within); after the last comes the first.

    ``parts`` has each part with the ``value`` of its first row; at the end of a part the next part's first row is next.
    """
    ring = Window.orderBy("part")                              # one row per part, of which the number is bounded
    turn = parts.select("part").withColumn("next_part", F.coalesce(F.lead("part").over(ring),
                                                                   F.min("part").over(Window.partitionBy(F.lit(1)))))
    after = turn.join(parts.select(F.col("part").alias("next_part"), F.col(value).alias("_after")), "next_part").drop("next_part")
    inside = Window.partitionBy("part").orderBy(*within)
    return (rows.withColumn("_next", F.lead(value).over(inside)).withColumn("_last", F.lead(F.lit(1)).over(inside).isNull())
            .join(after, "part", "left")
            .withColumn(out, F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_next")))
            .drop("_next", "_after", "_last"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, and how alike it is to that and to the next document's.

    The edited text has the last half of the characters replaced by the first as many (or all) of the next document, by
    ascending id (null first, equal ids by the hash of the text); after the last comes the first. A null text is empty. Texts
    without terms have the fingerprint ``NO_TERMS``. Repeated rows follow one another; extra columns are not read.
    The ids, which are numbers, are cut into ranges; each range is shuffled, ordered and fingerprinted in one place.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = placed(docs.select(F.col(id_col).alias("doc"), text.alias("text")), "doc").withColumn("h", F.xxhash64("text"))
    heads = rows.groupBy("part").agg(F.min(F.struct(F.col("doc").isNotNull().alias("some"), "doc", "h")).alias("m"))
    heads = written(heads.select("part", F.col("m.doc").alias("head"), F.col("m.h").alias("head_h")), "heads")
    firsts = rows.join(F.broadcast(heads), ["part"]).where(
        F.col("doc").eqNullSafe(F.col("head")) & (F.col("h") == F.col("head_h"))).select("part", "text").dropDuplicates(["part"])
    firsts = written(firsts, "firsts")
    order = [F.col("doc").asc_nulls_first(), F.col("h")]
    chain = neighbours(rows, firsts, "text", order, "next")
    chain = chain.withColumn("rn", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
                      F.substring(F.col("next"), F.lit(1), half))
    both = chain.select("part", "rn", "doc", "text", edited.alias("edited"))
    # what is said of a document travels with its key: the texts are shuffled once only
    either = both.select("part", "rn", "doc", F.length("text").cast("bigint").alias("n_chars"), F.explode(F.array(
        F.struct(F.lit(None).cast("binary").alias("sha"), F.col("text").alias("t")),
        F.struct(F.unhex(F.sha2("edited", 256)).alias("sha"), F.col("edited").alias("t")))).alias("v"))
    found = fingerprints(either.select("part", "rn", "doc", "n_chars", "v.sha", "v.t"), ["part", "rn", "doc", "n_chars", "sha"], "t")
    all_ = written(found.groupBy("part", "rn", "doc", "n_chars").agg(
        F.lower(F.hex(F.max("sha"))).alias("edited_sha256"),
        F.max(F.when(F.col("sha").isNull(), F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("sha").isNotNull(), F.col("fingerprint"))).alias("edited_fingerprint")), "fingerprints")
    chain = neighbours(all_, all_.where("rn = 1").select("part", "fingerprint"), "fingerprint", [F.col("rn")], "next")
    return chain.select(F.col("doc").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each row of ``documents`` and of its edited text."""
    return edited_fingerprints(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
