"""Every operator and stage on nulls, empty and very long texts, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from groundloom.llm import bpe, blocks, decontam, fingerprint, language, neardup, quality, secrets, sharding, urls

LONG = "word soup and " * 20_000
ROWS = [(1, "the quick brown fox jumps over the lazy dog near the river", "en", "a", 58),
        (1, "the quick brown fox jumps over the lazy dog near the river", "en", "a", 58),
        (2, None, "en", None, None), (3, "", None, "a", 0), (None, "x", "de", "b", 1), (None, None, None, None, None),
        (4, LONG, "en", "b", len(LONG)), (5, "!!! ... ---", "fr", "b", 11), (6, "Ünïcödé 😀 \u0001 text\n\tMore", "fr", "c", 24),
        (7, "the quick brown fox jumps over the lazy dog near the river", "de", "c", 58)]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that the operators use inside, and further ones
EXTRA = "node string, key string, doc string, words int, h int, part int, label string, spans string, bands int, quality int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def crowded(df):
    out = df
    for name, kind in (e.split(" ") for e in EXTRA.split(", ")):
        out = out.withColumn(name, F.lit(None).cast(kind))
    return out


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, None), (4, None, None), (None, 0, 1), (99, 0, 1), (7, 1, 1)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the"), (2, None), (3, ""), (4, "x"), (None, "...")],
                                 "item_id bigint, text string")


def lang(df):
    names, vectors = language.prototypes(df.select("text", "lang"))
    return df.select("doc_id", language.identify(df, names, vectors).alias("p"))


OPERATORS = {
    "language": lambda d, lab, it: lang(d),
    "near_duplicates": lambda d, lab, it: neardup.near_duplicates(d),
    "quality": lambda d, lab, it: quality.judged(d, lab, F.col("source"), F.col("lang")).select("doc_id", "_q_low", "_q_toxic"),
    "secrets": lambda d, lab, it: secrets.find_secrets(d.select("doc_id", "text"), secrets.model_scores(d)).drop("text"),
    "decontamination": lambda d, lab, it: decontam.contamination(d, it),
    "shards": lambda d, lab, it: sharding.shards(d, limit=100),
    "bpe": lambda d, lab, it: bpe.encode(d, bpe.public_vocabulary()),
    "fingerprints": lambda d, lab, it: fingerprint.edited_fingerprints(d),
    "urls": lambda d, lab, it: urls.judged(d.select("doc_id", F.col("text").alias("url"))),
    "main_text": lambda d, lab, it: blocks.extract(d, blocks.Labeller(), "text", "main").select("doc_id", "main"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_document(docs, labels, items, name):
    got = OPERATORS[name](crowded(docs), labels, items).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, docs, labels, items, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), items.limit(0)).collect() == []
    if name in ("quality", "decontamination"):            # those that read the second table
        assert len(OPERATORS[name](docs, labels.limit(0), items.limit(0)).collect()) == len(ROWS)


@pytest.fixture(scope="module")
def folder(spark, labels, items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{path}/labels.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, folder, name, stage):
    for rows in (docs.limit(0), crowded(docs)):
        got = stage(spark, rows, folder)
        got.collect()
        if name != "bpe":
            assert got.columns == rows.columns


def test_stage_results(spark, docs, folder):
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(["1", "2", "3", "None", "None", "4", "5", "6"])
    clean = corpus_pipeline.drop_contaminated(spark, docs, folder).collect()
    assert sorted(str(r["doc_id"]) for r in clean) == sorted(["2", "3", "None", "4", "5", "6"])


def test_defined_results(spark, docs, labels, items):
    words = {r["doc_id"]: r for r in decontam.contamination(docs, items).where("doc_id IS NOT NULL").collect()}
    assert (words[1]["n_hit"], words[1]["n_items"], words[2]["n_words"], words[4]["n_words"]) == (10, 1, 0, 60_000)
    shard = {r["doc_id"]: r for r in sharding.shards(docs, limit=100).collect()}
    assert shard[4]["n_bytes"] == len(LONG) and shard[2]["n_bytes"] == 0
    kinds = {r["doc_id"]: r["p"] for r in lang(docs).collect()}
    assert kinds[2]["lang"] == kinds[3]["lang"] == kinds[5]["lang"] == "und" and kinds[5]["score"] == 0.0
    tokens = {r["doc_id"]: r for r in bpe.encode(docs, bpe.public_vocabulary()).collect()}
    assert tokens[2]["ids"] == [] and tokens[2]["decoded"] == "" and tokens[4]["n_tokens"] >= 60_000


def test_stages_keep_columns_that_have_the_names_of_their_own(spark):
    rows = [(1, "hi there"), (2, "hi there"), (3, ""), (4, None), (None, None), (1, "hi there")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    extra = ["_key", "_node", "doc", "key", "node", "class_key"]
    docs = docs.withColumns({c: F.lit(i) for i, c in enumerate(extra)})
    items = spark.createDataFrame([("a", "hi there")], "item_id string, text string")
    kept, clean = neardup.deduplicated(docs), decontam.uncontaminated(docs, items)
    assert kept.columns == clean.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("doc_id IN (3, 4) OR doc_id IS NULL").unionByName(
        docs.where("doc_id = 1").limit(1)).collect()))
    assert sorted(map(str, clean.collect())) == sorted(map(str, docs.where("doc_id IN (3, 4) OR doc_id IS NULL").collect()))
