"""Samples at any size, texts made of secrets, pages of many blocks and unclosed tags, columns named like features."""

import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from groundloom.llm import blocks, common, secrets, urls

DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def test_a_sample_never_vanishes(spark):
    for total in (10, 10 ** 9, 10 ** 12, 3 * 10 ** 16):
        limit = common.hash_limit(20_000, total)
        assert limit >= (1 << 63) - 1 if total <= 20_000 else abs(limit / 2 ** 63 * total / 20_000 - 1) < 0.01
    same = spark.range(5_000).select(F.lit("one text").alias("text"))
    assert common.hash_sample(same, F.col("text"), 10).count() == 5_000          # of a single text at least that
    many = spark.range(100_000).select(F.col("id").cast("string").alias("text"))
    assert abs(common.hash_sample(many, F.col("text"), 2_000).count() - 2_000) < 300
    assert common.hash_sample(many.limit(0), F.col("text"), 10).count() == 0


@pytest.fixture(scope="module")
def scores(spark):
    return secrets.model_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_random_strings_are_told_from_ordinary_ones(spark, scores):
    rng = random.Random(3)
    hidden = ["".join(rng.choice(DIGITS) for _ in range(rng.randint(16, 40))) for _ in range(300)]
    plain = ["20240115123456", "+4917612345678", "978-3-16148-4100", "2024-01-15T12", "report2023final", "com/article/123456789012",
             "https://example.com/2023/05/article-12345.html", "internationalization", "some_long_identifier_name",
             *[str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(50)], *secrets.ordinary_numbers(20, seed=99)]
    rows = [(f"see {s} here", 1) for s in hidden] + [(f"see {s} here", 0) for s in plain]
    found = secrets.find_secrets(spark.createDataFrame(rows, "text string, y int"), scores).select(
        "y", F.exists("spans", lambda s: s["kind"] == "random").alias("random"), (F.size("spans") > 0).alias("any")).collect()
    assert sum(r["any"] for r in found if r["y"]) >= 0.95 * len(hidden)
    hits = [r["y"] for r in found if r["random"]]
    assert sum(hits) >= 0.95 * len(hits) and len(hits) > 200


def test_a_text_made_of_secrets(spark, scores):
    rng = random.Random(4)
    keys = ["%016x" % rng.getrandbits(64) for _ in range(3_000)]
    docs = spark.createDataFrame([(1, " ".join(keys)), (2, "a" + " key=" * 50 + "b")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(docs, scores).collect()}
    assert [(s["start"], s["stop"]) for s in found[1]] == [(17 * i, 17 * i + 16) for i in range(3_000)]
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(docs, scores).collect()}
    assert clean[1] == " ".join(["[SECRET]"] * 3_000) and clean[2] == "a" + " key=" * 50 + "b"


def test_columns_named_like_features(spark, scores):
    rows = spark.createDataFrame([("http://a.org/x", 1, "p"), (None, None, None), ("https://b.net/" + "y/" * 20_000, 3, "q")],
                                 "url string, length int, depth string").withColumns({c: F.lit(7) for c in ("label", "rate", "entropy", "digits", "text_")})
    pages = rows.unionByName(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url").withColumns(
        {c: F.lit(None).cast(t) for c, t in rows.dtypes if c != "url"}))
    got = urls.judged(pages)
    assert got.columns[:len(rows.columns)] == rows.columns and got.count() == pages.count()
    odd = rows.withColumns({"text": F.col("url"), "at": F.lit(1), "found": F.lit(2), "hex": F.lit(3)})
    assert secrets.find_secrets(odd, scores).columns == [*odd.columns, "spans"]


def test_pages_longer_than_a_training_window(spark):
    def page(i):
        menu = "".join(f"<li>Menu {k}</li>" for k in range(40))
        body = "".join(f"<p>Paragraph {k} of text {i}, which tells a longer story about things that happened there.</p>" for k in range(460))
        return f"<html><body><nav><ul>{menu}</ul></nav><article>{body}</article><footer>Copyright {i}. All rights reserved.</footer></body></html>"

    pages = spark.createDataFrame([(i, page(i)) for i in range(60)], "page_id bigint, html string")
    model = blocks.fitted(pages, "page_id", "html")
    texts = [r["text"].split("\n") for r in blocks.extract(pages, model).collect()]
    assert all(not t.startswith(("Menu", "Copyright")) for text in texts for t in text)
    assert sum(map(len, texts)) >= 0.98 * 60 * 460


def test_pages_without_a_named_article_are_an_error(spark):
    pages = spark.createDataFrame([(1, "<div><p>text</p></div>"), (2, "<nav><p>menu</p></nav>")], "page_id bigint, html string")
    with pytest.raises(ValueError):
        blocks.fitted(pages, "page_id", "html")


def test_unclosed_tags_cost_no_square():
    start = time.process_time()
    found = blocks.read_blocks("<table>" + "<tr><td>cell" * 50_000)
    assert len(found) == 50_000 and found[-1][1] == ("table", "tr", "td")
    deep = blocks.read_blocks("<div class='a b'>" * 20_000 + "text")
    assert len(deep) == 1 and len(deep[0][1]) == blocks.PATH_TOKENS
    assert [b[0] for b in blocks.read_blocks("<dl><dt>a<dd>b<dt>c</dl><select><option>d<option>e</select>")] == list("abcde")
    assert time.process_time() - start < 20
