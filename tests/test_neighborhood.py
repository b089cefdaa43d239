"""Neighbourhood operators against plain numpy loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from groundloom.operators import neighborhood as near


def table(spark, image, name="value", **extra):
    rows, cols = np.indices(image.shape)
    pdf = pd.DataFrame({"pr": rows.ravel().astype("int32"), "pc": cols.ravel().astype("int32"), **extra})
    pdf[name] = image.ravel()
    return spark.createDataFrame(pdf)


def image_of(df, shape, name):
    out = np.full(shape, np.nan)
    pdf = df.select("pr", "pc", F.col(name).cast("double").alias("v")).toPandas()
    out[pdf.pr, pdf.pc] = pdf.v
    return out


def window(image, r, c, h):
    return image[max(0, r - h):r + h + 1, max(0, c - h):c + h + 1]


def lee_loop(image, win, looks):
    h, out = win // 2, np.full(image.shape, np.nan)
    cu, cmax = 0.523 / np.sqrt(looks), np.sqrt(1 + 2 / looks)
    for r, c in np.ndindex(image.shape):
        seen = window(image, r, c, h)
        seen = seen[~np.isnan(seen)]
        if not len(seen):
            continue
        mean, square = seen.mean(), (seen**2).mean()
        sd = 0.0 if np.isclose(square, mean**2) else np.sqrt(square - mean**2)
        ci = sd / mean if mean else np.nan
        w = 1.0 if ci <= cu else np.exp(-(ci - cu) / (cmax - ci)) if cu < ci < cmax else 0.0
        here = 0.0 if np.isnan(image[r, c]) else image[r, c]
        out[r, c] = mean * w + here * (1 - w)
    return out


@pytest.mark.parametrize("shape", [(40, 30), (300, 12), (9, 530)])
def test_lee_matches_loop_across_blocks(spark, shape):
    rng = np.random.default_rng(1)
    image = rng.gamma(1.2, 0.2, shape)
    image[rng.random(shape) < 0.15] = np.nan
    image[:4, :4] = np.nan
    image[:1, 5:9] = 0.0
    got = image_of(near.enhanced_lee(table(spark, image), 5, 2), shape, "filtered")
    np.testing.assert_allclose(got, lee_loop(image, 5, 2), rtol=1e-9, atol=1e-12)


def test_lee_by_tile_does_not_look_across(spark):
    image = np.random.default_rng(2).gamma(2.0, 1.0, (12, 8))
    df = table(spark, image).withColumn("tile", F.floor(F.col("pr") / 6))
    got = image_of(near.enhanced_lee(df, 5, 1, by=["tile"]), image.shape, "filtered")
    want = np.vstack([lee_loop(image[:6], 5, 1), lee_loop(image[6:], 5, 1)])
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_box_filter_uses_one_shuffle(spark):
    df = table(spark, np.ones((4, 4)))
    plan = near.box_filter(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("k", [1, 4, 51])
def test_box_sums_of_a_sparse_image(spark, k):
    rng = np.random.default_rng(k)
    image = rng.random((300, 40))
    absent, empty = rng.random(image.shape) < 0.4, rng.random(image.shape) < 0.2
    known = np.where(absent | empty, np.nan, image)
    rows = table(spark, image).join(table(spark, absent.astype("int32"), "absent"), ["pr", "pc"]).join(
        table(spark, empty.astype("int32"), "empty"), ["pr", "pc"])
    given = rows.where("absent = 0").select("pr", "pc", F.when(F.col("empty") == 0, F.col("value")).alias("value"), F.lit("x").alias("tile"))
    got = near.box_filter(given, k, by=["tile"]).toPandas()
    assert len(got) == (~absent).sum() and set(got.columns) == {"pr", "pc", "value", "tile", "box_sum", "box_sum_sq", "box_count"}
    for r in got.sample(200, random_state=0).itertuples():
        seen = known[max(r.pr - k // 2, 0):r.pr + k - k // 2, max(r.pc - k // 2, 0):r.pc + k - k // 2]
        assert r.box_count == (~np.isnan(seen)).sum()
        assert abs(r.box_sum - np.nansum(seen)) < 1e-9 and abs(r.box_sum_sq - np.nansum(seen**2)) < 1e-9


def test_densify_adds_missing_cells(spark):
    df = table(spark, np.arange(12.0).reshape(3, 4)).where("pr <> 1 OR pc <> 2")
    out = near.densify(df)
    assert out.count() == 12
    assert out.where("value IS NULL").select("pr", "pc").collect() == [(1, 2)]


def erode(mask, steps):
    mask = mask.copy()
    for _ in range(steps):
        padded = np.pad(mask, 1, constant_values=1)
        low = np.minimum.reduce([padded[:-2, 1:-1], padded[2:, 1:-1], padded[1:-1, :-2], padded[1:-1, 2:]])
        mask = ((mask == 1) & (low == 1)).astype(int)
    return mask


@pytest.mark.parametrize("depth", [1, 3, 70])
def test_peeling_equals_repeated_erosion(spark, depth):
    rng = np.random.default_rng(depth)
    mask = (rng.random((310, 40)) > 0.002).astype(int)
    df = table(spark, mask, "mask").withColumn("value", F.lit(1.0))
    got = image_of(near.peel_edges(df, depth), mask.shape, "value")
    np.testing.assert_array_equal(~np.isnan(got), erode(mask, depth) == 1)


def test_first_peel_is_inner_edge_and_full_image_has_none(spark):
    mask = (np.random.default_rng(5).random((20, 20)) > 0.1).astype(int)
    edge = near.inner_edges(table(spark, mask, "mask")).toPandas()
    lost = np.argwhere((mask == 1) & (erode(mask, 1) == 0))
    assert sorted(map(tuple, edge.values.tolist())) == sorted(map(tuple, lost.tolist()))
    assert near.inner_edges(table(spark, np.ones((5, 5), int), "mask")).isEmpty()


def sides_loop(mask, left_right):
    """Edge classes of one image by direct scanning; returns a dict of cells."""
    cells = [tuple(x) for x in np.argwhere((mask == 1) & (erode(mask, 1) == 0))]
    if not cells:
        return {}
    rows, cols = [r for r, _ in cells], [c for _, c in cells]
    top, bottom, left, right = min(rows), max(rows), min(cols), max(cols)

    def on_row(r, pick):
        return r, pick(c for rr, c in cells if rr == r)

    def on_col(c, pick):
        return pick(r for r, cc in cells if cc == c), c

    if on_col(left, min)[0] > on_col(right, min)[0]:
        ul, lr, ll, ur = on_row(top, min), on_row(bottom, max), on_col(left, max), on_col(right, min)
    else:
        ur, ll, ul, lr = on_row(top, max), on_row(bottom, min), on_col(left, min), on_col(right, max)
    out = {}
    for a, b in ([(ur, lr), (ul, ll)] if left_right else [(ul, ur), (ll, lr)]):
        (r0, r1), (c0, c1) = sorted((a[0], b[0])), sorted((a[1], b[1]))
        for r, c in cells:
            if left_right and r0 < r < r1 and c0 <= c <= c1 or not left_right and r0 <= r <= r1 and c0 < c < c1:
                out[r, c] = 1
    for corner in (ul, ur, lr, ll):
        out[corner] = 2
    return out


def swath(shape, slant, seed):
    rows, cols = np.indices(shape)
    at = cols - slant * rows
    mask = ((at > 4) & (at < 18) & (rows > 2) & (rows < shape[0] - 3)).astype(int)
    mask[np.random.default_rng(seed).random(shape) < 0.01] = 0
    return mask


@pytest.mark.parametrize("left_right", [True, False])
@pytest.mark.parametrize("slant", [0.4, -0.3])
def test_side_edges_and_peeling_match_loop(spark, left_right, slant):
    shape = (24, 36)
    images = {k: np.roll(swath(shape, slant, k), 6, axis=1) for k in (0, 1)}
    frames = [table(spark, m, "mask").withColumn("frame", F.lit(k)) for k, m in images.items()]
    df = frames[0].unionByName(frames[1])
    first = near.side_edges(df, left_right, by=["frame"]).collect()
    gone = near.peel_sides(df, 3, left_right, by=["frame"]).collect()
    for k, mask in images.items():
        want = sides_loop(mask, left_right)
        assert {(r.pr, r.pc): r.side for r in first if r.frame == k} == want
        left, peeled = mask.copy(), {}
        for _ in range(3):
            step = sides_loop(left, left_right)
            peeled.update(step)
            for cell in step:
                left[cell] = 0
        assert {(r.pr, r.pc): r.side for r in gone if r.frame == k} == peeled


def test_remove_edges_clears_all_layers(spark):
    mask = swath((20, 36), 0.3, 3)
    vv = np.where(mask == 1, 2.0, np.nan)
    df = table(spark, vv, "vv").withColumns({"vv": F.when(~F.isnan("vv"), F.col("vv")), "vh": F.lit(1.0),
                                             "inc": F.lit(np.pi / 4), "frame": F.lit(0)})
    out = near.remove_edges(df, ["vv", "vh", "inc"], 1, "vv", "all", "inc").toPandas()
    kept = out[out.vv.notna()]
    assert len(kept) == erode(mask, 1).sum()
    assert kept.vh.eq(1).all() and np.allclose(kept.inc, 45)
    assert out[out.vv.isna()][["vh", "inc"]].isna().all().all()


def test_densify_deals_blank_cells_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(near, "TASK_CELLS", 2_000)
    monkeypatch.setattr(near, "BLOCK_ROW", 16)
    px = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 299, 99, 2.0), ("b", 3, 40, 3.0), ("b", 3, 40, None)],
                               "frame string, pr int, pc int, value double")
    out = near.densify(px, ["frame"])
    assert out.dtypes == px.dtypes
    tasks = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(tasks) == 300 * 100 + 4 * 41 and max(tasks) < 6_000
    assert out.select("frame", "pr", "pc").distinct().count() == sum(tasks)
    assert sorted(tuple(r) for r in out.where("value is not null").collect()) == [("a", 0, 0, 1.0), ("a", 299, 99, 2.0), ("b", 3, 40, 3.0)]
