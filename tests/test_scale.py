"""Skew-safe joins, numbering and quantiles, with bounds set low so that the second way runs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from groundloom import scale


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": np.arange(3000), "key": np.where(rng.random(3000) < 0.4, 7, rng.integers(0, 50, 3000)),
                        "value": rng.integers(0, 400, 3000) / 8})
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_agree_with_a_plain_join(skewed, spark, how):
    small = spark.createDataFrame([(k, k * 10) for k in (1, 7, 9, 99)], "key long, extra long")
    want = sorted(skewed.join(small, "key", how).collect())
    assert sorted(scale.attach(skewed, small, ["key"], how, max_rows=2).select(*skewed.join(small, "key", how).columns).collect()) == want
    assert sorted(scale.attach(skewed, small, ["key"], how).collect()) == want
    split = scale.skew_join(skewed, small, ["key"], how, hot_rows=500, salts=4)
    assert sorted(split.select(*skewed.join(small, "key", how).columns).collect()) == want
    salted = scale.salted_join(skewed, small, ["key"], how, salts=4)
    assert sorted(salted.select(*skewed.join(small, "key", how).columns).collect()) == want


def test_broadcast_only_within_the_bound(skewed, spark):
    small = spark.createDataFrame([(k, 0) for k in range(20)], "key long, extra long")

    def plan(bound):
        return scale.attach(skewed, small, ["key"], max_rows=bound)._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(20) and "strategy=broadcast" not in plan(19)


def test_a_lookup_beyond_the_bound_is_shuffled_whatever_its_files_hold(spark):
    """Spark expects a few bytes of these tables, and would broadcast a side by itself."""
    big, small = spark.range(3000).selectExpr("id % 50 AS key", "id"), spark.range(50).selectExpr("id AS key", "id * 10 AS extra")
    assert "BroadcastHashJoin" in big.join(small, ["key"])._jdf.queryExecution().executedPlan().toString()
    for joined in (scale.attach(big, small, ["key"], max_rows=19), scale.attach(big, small, ["key"], max_rows=19, few_rows_each=True),
                   scale.skew_join(big, small, ["key"]), scale.salted_join(big, small, ["key"], salts=4)):
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(joined.select("key", "id", "extra").collect()) == sorted((i % 50, i, i % 50 * 10) for i in range(3000))


@pytest.mark.parametrize("bound", [10, 10**6])
def test_quantiles_of_large_groups(skewed, bound):
    got = scale.grouped_quantiles(skewed, ["key"], "value", [0.0, 0.3, 0.5, 1.0], ["a", "b", "c", "d"], bound).toPandas()
    want = skewed.toPandas().groupby("key").value.quantile([0.0, 0.3, 0.5, 1.0]).unstack()
    got = got.set_index("key").sort_index()
    np.testing.assert_allclose(got[["a", "b", "c", "d"]].to_numpy(), want.to_numpy(), rtol=1e-12)


def test_running_totals(skewed):
    got = scale.running_totals(skewed, ["key"], ["value", "id"], "id").toPandas().sort_values(["key", "value", "id"])
    want = got.groupby("key").id.cumsum()
    assert (got.upto == want).all() and (got.total == got.groupby("key").id.transform("sum")).all()


def test_numbering_is_a_seeded_permutation(skewed):
    def numbers(seed, parts):
        keyed = skewed.repartition(parts).withColumn("h", scale.shuffle_key(seed, "id"))
        return {r.id: r.pos for r in scale.number_by_hash(keyed, "h", ["id"], start=1).collect()}

    one = numbers(5, 3)
    assert sorted(one.values()) == list(range(1, 3001))
    assert one == numbers(5, 7) and one != numbers(6, 3)


def test_first_by_hash_takes_all_of_a_small_class(skewed, spark):
    keyed = skewed.withColumn("h", scale.shuffle_key(1, "id"))
    sizes = spark.createDataFrame([(7, 100), (8, 10_000), (9, 0)], "key long, n int")
    got = scale.first_by_hash(keyed, "key", "h", ["id"], sizes, "n")
    pdf = keyed.toPandas()
    want = set(pdf[pdf.key == 7].sort_values("h").id.head(100)) | set(pdf[pdf.key == 8].id)
    assert {r.id for r in got.collect()} == want


@pytest.mark.parametrize("n", [0, 1, 400, 401, 700, 1100, 5000])
def test_first_by_hash_where_many_rows_share_a_prefix(skewed, spark, n):
    prefix = F.concat(F.lit("0000"), F.pmod("id", F.lit(3)).cast("string"))
    keyed = skewed.withColumn("h", F.concat(prefix, scale.shuffle_key(1, "id")))
    got = scale.first_by_hash(keyed, "key", "h", ["id"], spark.createDataFrame([(7, n)], "key long, n int"), "n")
    pdf = keyed.toPandas()
    assert sorted(r.id for r in got.collect()) == sorted(pdf[pdf.key == 7].sort_values("h").id.head(n))
    assert set(got.columns) == set(keyed.columns)


@pytest.mark.parametrize("max_group", [0, 2800, 10**6])
def test_summary_of_columns_of_any_size(skewed, monkeypatch, max_group):
    from groundloom.operators import composites

    ranked = []
    monkeypatch.setattr(composites, "ranked_quantiles", lambda *a, f=scale.ranked_quantiles: ranked.append(1) or f(*a))
    px = skewed.select("id", F.when(F.col("key") != 3, F.col("value")).alias("value"), F.when(F.col("id") % 10 == 0, F.col("key"))
                       .alias("rare"), F.lit(None).cast("double").alias("none"))
    cols = ["id", "value", "rare", "none"]
    got = composites.summary_stats(px, cols, max_group).toPandas().set_index("col_name").loc[cols]
    pdf = px.toPandas().astype(float)
    assert got["count"].tolist() == pdf[cols].count().tolist() and bool(ranked) == (max_group < 3000)
    for name, want in (("mean", pdf.mean()), ("stddev", pdf.std()), ("min", pdf.min()), ("max", pdf.max()),
                       ("q25", pdf.quantile(0.25)), ("q50", pdf.quantile(0.5)), ("q75", pdf.quantile(0.75))):
        np.testing.assert_allclose(got[name].astype(float), want[cols], rtol=1e-12)
    assert composites.summary_stats(px.where("id < 0"), cols, max_group).isEmpty()


def test_is_small(skewed):
    assert scale.is_small(skewed, 3000) and not scale.is_small(skewed, 2999)
    assert skewed.where(F.lit(False)).isEmpty()


@pytest.mark.parametrize("max_group", [None, 10, 10_000])
def test_median_composite_of_large_groups(skewed, monkeypatch, max_group):
    from groundloom.operators import composites

    ranked = []
    monkeypatch.setattr(scale, "ranked_quantiles", lambda *a, f=scale.ranked_quantiles: ranked.append(1) or f(*a))
    px = skewed.withColumn("value", F.when(F.col("key") != 3, F.col("value")))
    got = composites.composite(px, ["key"], "median", max_group=max_group).toPandas().set_index("key")["value"]
    want = px.toPandas().groupby("key")["value"].median()
    pd.testing.assert_series_equal(got.sort_index(), want, check_names=False, check_index_type=False)
    assert bool(ranked) == (max_group == 10)


def test_lookup_is_sized_in_bytes(spark):
    rings = spark.range(10).select("id", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.struct(
        i.cast("double").alias("x"), F.lit(0.0).alias("y"))).alias("ring"), F.lit("name").alias("name"),
        F.create_map(F.lit("a"), F.lit(1)).alias("m"), F.lit(None).cast("array<string>").alias("none"))
    assert scale.is_small(rings, 10) and scale.is_small(rings, 10, 400_000)
    assert not scale.is_small(rings, 10, 100_000) and not scale.is_small(rings, 9)
    assert scale.is_small(rings.where("id < 0"), 0, 0)
