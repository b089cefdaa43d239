"""Polygon predicates and coverings against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from groundloom import scale
from groundloom.functions.geodesy import reproject, reproject_ring
from groundloom.operators import vector
from groundloom.plans import jobs
from groundloom.session import checkpointed

SCHEMA = "id long, ring array<struct<x: double, y: double>>"


def polygon(rng, cx, cy, size, star=True):
    n = rng.randint(3, 8)
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + math.cos(a) * size * (rng.uniform(0.4, 1) if star else 1),
             cy + math.sin(a) * size * (rng.uniform(0.4, 1) if star else 1)) for a in angles]


def inside(x, y, ring):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            hit = not hit
    return hit


def crossing(a, b, c, d):
    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0


def meet(p, q):
    pe, qe = list(zip(p, p[1:] + p[:1])), list(zip(q, q[1:] + q[:1]))
    return any(crossing(*e, *f) for e in pe for f in qe) or inside(*p[0], q) or inside(*q[0], p)


@pytest.fixture(scope="module")
def shapes(spark):
    rng = random.Random(4)
    first = {i: polygon(rng, rng.uniform(0, 100), rng.uniform(0, 100), 12) for i in range(60)}
    second = {i: polygon(rng, rng.uniform(0, 100), rng.uniform(0, 100), 18) for i in range(40)}
    return first, second, spark.createDataFrame(list(first.items()), SCHEMA), spark.createDataFrame(list(second.items()), SCHEMA)


@pytest.mark.parametrize("cell", [5.0, 30.0, 500.0])
def test_spatial_join_matches_brute_force(shapes, cell):
    first, second, a, b = shapes
    want = sorted((i, j) for i, p in first.items() for j, q in second.items() if meet(p, q))
    pairs = vector.spatial_join(a, b.withColumnsRenamed({"id": "other", "ring": "other_ring"}), cell)
    assert sorted((r.id, r.other) for r in pairs.select("id", "other").collect()) == want


def test_touching_and_nested_polygons_intersect(spark):
    box = [(0, 0), (0, 2), (2, 2), (2, 0)]
    cases = {"touch": [(2, 0), (2, 2), (4, 2), (4, 0)], "corner": [(2, 2), (2, 3), (3, 3), (3, 2)],
             "within": [(0.5, 0.5), (0.5, 1), (1, 1), (1, 0.5)], "apart": [(3, 0), (3, 2), (4, 2), (4, 0)]}
    def real(ring):
        return [(float(x), float(y)) for x, y in ring]

    df = spark.createDataFrame([(k, real(box), real(v)) for k, v in cases.items()],
                               "k string, a array<struct<x: double, y: double>>, b array<struct<x: double, y: double>>")
    got = {r.k: r.m for r in df.select("k", vector.intersects("a", "b").alias("m")).collect()}
    assert got == {"touch": True, "corner": True, "within": True, "apart": False}


def test_cover_cells_are_the_cells_with_their_centre_inside(shapes):
    first, _, a, _ = shapes
    got = {(r.id, r.cx, r.cy) for r in vector.cover_cells(a, 2.0, ["id"]).collect()}
    want = {(i, x, y) for i, p in first.items() for x in range(-10, 60) for y in range(-10, 60)
            if inside((x + 0.5) * 2, (y + 0.5) * 2, p)}
    assert got == want


def test_cover_area_approaches_the_exact_area(spark):
    ring = [(0.0, 0.0), (9.0, 1.0), (7.0, 8.0), (1.0, 6.0)]
    exact = abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]))) / 2
    df = spark.createDataFrame([(1, ring)], SCHEMA)
    errors = []
    for size in (1.0, 0.1, 0.02):
        area = vector.covered_area(vector.cover_runs(df, size, ["id"]), size, ["id"]).first().area
        errors.append(abs(area - exact))
    assert errors[2] < 0.02 and errors[2] <= errors[0]


def test_footprint_algebra_matches_cell_sets(shapes):
    first, second, a, b = shapes
    size = 2.0
    cover = {i: {(x, y) for x in range(-20, 70) for y in range(-20, 70) if inside((x + .5) * size, (y + .5) * size, p)}
             for i, p in first.items()}
    area = {c for q in second.values() for c in
            {(x, y) for x in range(-20, 70) for y in range(-20, 70) if inside((x + .5) * size, (y + .5) * size, q)}}
    runs = vector.dissolve(vector.cover_runs(a, size, ["id"]), ["id"])
    ratios = {(r.id, r.other): r.ratio for r in vector.overlap_ratio(runs, "id").collect()}
    want = {(i, j): len(cover[i] & cover[j]) / len(cover[i]) for i in cover for j in cover if cover[i] & cover[j]}
    assert ratios == pytest.approx(want)
    own = {r.id: r.overlap_with_aoi for r in
           vector.exclusive_overlap(runs, vector.cover_runs(b, size, []), "id", size).collect()}
    for i, cells in cover.items():
        rest = cells - set().union(*(c for j, c in cover.items() if j != i))
        assert own.get(i, 0) == pytest.approx(len(rest & area) * size**2)
    left = vector.uncovered_area(runs, vector.cover_runs(b, size, []))
    assert {(r.cx, r.cy) for r in vector.cells_of(left, []).collect()} == area - set().union(*cover.values())


def test_skimming_merges_and_drops_frames(spark):
    boxes = {(1, 10): (0, 0, 100, 100), (1, 11): (2, 0, 102, 100),      # cover each other: merged
             (1, 12): (96, 0, 196, 100), (1, 13): (100, 10, 190, 90),   # 13 lies within 12: merged too
             (1, 14): (70, 0, 120, 50),                                  # covered by 10 to 13 together: dropped
             (2, 20): (900, 900, 950, 950)}                              # outside the area
    rows = [(f"g{p}_{f}_{k}", p, f, [(b[0], b[1]), (b[0], b[3]), (b[2], b[3]), (b[2], b[1])])
            for (p, f), b in boxes.items() for k in range(2)]
    schema = "sceneName string, pathNumber int, frameNumber int, ring array<struct<x: double, y: double>>"
    granules = spark.createDataFrame([(s, p, f, [(float(x), float(y)) for x, y in r]) for s, p, f, r in rows], schema)
    aoi = spark.createDataFrame([(1, [(0.0, 0.0), (0.0, 100.0), (300.0, 100.0), (300.0, 0.0)])], SCHEMA)
    kept, frames = vector.skim_granules(aoi, granules, 2.0)
    assert {r.sceneName[:5] for r in kept.collect()} == {"g1_10", "g1_11", "g1_12", "g1_13"}
    assert kept.count() == 8
    rows = sorted(frames.collect(), key=lambda r: (r.group_id, r.position))
    got = {"-".join(str(r.frameNumber) for r in rows if r.group_id == g): (r0.num_granules, r0.overlap_with_aoi)
           for g, r0 in {r.group_id: r for r in rows}.items()}
    assert set(got) == {"10-11", "12-13"} and got["10-11"][0] == 4
    assert got["10-11"][1] == pytest.approx(96 * 100 - 26 * 50)


def test_tiles_follow_the_area(spark):
    aoi = spark.createDataFrame([(1, [(130.0, 20.0), (130.0, 480.0), (910.0, 470.0)])], SCHEMA)
    tiles = {(r.h, r.v): r for r in vector.make_tiles(aoi, 200.0).collect()}
    assert len(tiles) == 4 * 3
    assert (tiles[0, 0].xmin, tiles[0, 0].ymax) == (100.0, 500.0)
    assert tiles[0, 0].mask == 1 and tiles[3, 2].mask == 0
    snapped = vector.make_tiles(aoi, 200.0, centered=False).agg(F.min("xmin"), F.max("ymax"), F.count("h")).first()
    assert tuple(snapped) == (0.0, 600.0, 5 * 3)


def test_projection_round_trip_and_known_points(spark):
    pts = [(lon / 4, lat / 2) for lon in range(-312, -288) for lat in range(-160, 161, 8)]
    df = spark.createDataFrame([(i, float(x), float(y), float(x), float(y)) for i, (x, y) in enumerate(pts)],
                               "i long, x double, y double, x0 double, y0 double")
    there = reproject(df, "x", "y", 4326, 32618)
    back = reproject(there, "x", "y", 32618, 4326)
    worst = back.agg(F.max(F.abs(F.col("x") - F.col("x0"))), F.max(F.abs(F.col("y") - F.col("y0")))).first()
    assert max(worst) < 1e-9
    on_meridian = there.where("x0 = -75 AND y0 = 0").first()
    assert (on_meridian.x, on_meridian.y) == (pytest.approx(500000, abs=1e-6), pytest.approx(0, abs=1e-6))
    south = reproject(df.where("x0 = -75 AND y0 = -8"), "x", "y", 4326, 32718).first()
    north = there.where("x0 = -75 AND y0 = 8").first()
    assert south.y == pytest.approx(10_000_000 - north.y, abs=1e-6)
    with pytest.raises(ValueError):
        reproject(df, "x", "y", 4326, 3857)


def test_utm_tiles_cover_the_area(spark):
    corners = [(-75.3, -8.2), (-75.3, -7.6), (-74.6, -7.6), (-74.6, -8.2)]
    tiles = jobs.utm_tiles(spark.createDataFrame([(1, corners)], SCHEMA), 20_000.0).collect()
    assert {t.epsg for t in tiles} == {32718} and all(t.mask == 1 for t in tiles)
    assert all(t.xmin % 100 == 0 and t.ymax % 100 == 0 and t.xmax - t.xmin == 20_000 for t in tiles)
    pts = reproject(spark.createDataFrame(corners, "x double, y double"), "x", "y", 4326, 32718).collect()
    for p in pts:
        assert any(t.xmin <= p.x <= t.xmax and t.ymin <= p.y <= t.ymax for t in tiles)
    ring = spark.createDataFrame([(1, corners)], SCHEMA).select(reproject_ring("ring", 4326, 32718).alias("r")).first().r
    assert [(v.x, v.y) for v in ring] == [(p.x, p.y) for p in pts]


def test_scan_conversion_of_edges_matches_the_centres(spark, monkeypatch):
    """Notches, a hole, a point, a NULL ring; in one go and cut into pieces and bands of rows."""
    rng = np.random.default_rng(11)
    shapes = {1: [(0.3, 0.2), (9.7, 0.4), (9.1, 9.9), (5.0, 2.5), (0.8, 9.2)],
              2: [(0, 0), (12, 0), (12, 12), (0, 12), (0, 0), None, (3, 3), (3, 9), (9, 9), (9, 3), (3, 3), None],
              3: [(4, 4)], 4: None, 5: [(-7.5, -3.5), (40.5, -3.5), (40.5, 30.5), (-7.5, 30.5)],
              6: [tuple(map(float, p)) for p in rng.uniform(-5, 25, (9, 2))]}
    df = spark.createDataFrame([(i, r and [p and tuple(map(float, p)) for p in r]) for i, r in shapes.items()],
                               "id int, ring array<struct<x:double,y:double>>")

    def inside(ring, x, y):
        odd = False
        for p, q in zip(ring, ring[1:] + ring[:1]):
            if p and q and (p[1] > y) != (q[1] > y) and x < p[0] + (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]):
                odd = not odd
        return odd

    want = sorted((i, x, y) for i, r in shapes.items() if r for x in range(-12, 45) for y in range(-8, 35) if inside(r, x + 0.5, y + 0.5))
    for limit in (1_000_000, 50, 3):
        monkeypatch.setattr(vector, "CROSSINGS", limit)
        assert sorted(map(tuple, vector.cover_cells(df, 1.0, ["id"]).collect())) == want
    assert vector.cover_cells(df.limit(0), 1.0, ["id"]).collect() == []


def test_containment_forms_few_pairs(spark):
    """5,000 distinct frames over one place: the same result as all pairs, from a small part of them."""
    n = 5_000
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 30, n), rng.integers(0, 30, n)
    w, h = rng.integers(10, 30, n), rng.integers(10, 30, n)
    runs = spark.createDataFrame(pd.DataFrame({"frame": np.arange(n), "x": x, "y": y, "w": w, "h": h})).selectExpr(
        "frame", "explode(sequence(y, y + h - 1)) AS y", "x AS x0", "x + w - 1 AS x1")
    candidates = vector.containment_candidates(runs, "frame").count()
    got = {(r["frame"], r["other"]) for r in vector.containment(runs, "frame").collect()}
    shared = (np.clip(np.minimum.outer(x + w, x + w) - np.maximum.outer(x, x), 0, None)
              * np.clip(np.minimum.outer(y + h, y + h) - np.maximum.outer(y, y), 0, None))
    want = set(zip(*np.nonzero(shared > 0.95 * (w * h)[:, None])))
    assert got == {(int(a), int(b)) for a, b in want}
    assert candidates < 0.25 * (shared > 0).sum()


def _small_boxes(spark, n):
    return spark.range(n).coalesce(1).select("id", vector.box_ring(F.col("id") * 3, F.lit(0), F.col("id") * 3 + 4, F.lit(50)).alias("ring"))


def _tasks(df):
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


def test_polygons_of_few_bytes_are_covered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(vector, "TASK_RUNS", 100)
    counts = _tasks(vector.cover_runs(_small_boxes(spark, 40), 1.0, ["id"]))
    assert sum(counts) == 40 * 50 and max(counts) <= 400


def test_joined_polygons_are_dealt_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(vector, "TASK_POLYGONS", 4)
    other = _small_boxes(spark, 1).select(F.col("ring").alias("other_ring"), F.lit(0).alias("o"))
    joined = vector.spatial_join(_small_boxes(spark, 40).select("id", "ring"), other, 5.0)
    assert joined.rdd.getNumPartitions() >= 10
    assert sorted(r.id for r in joined.collect()) == [0, 1]


def test_containment_computes_the_runs_once(spark):
    runs = vector.dissolve(vector.cover_runs(_small_boxes(spark, 5), 1.0, ["id"]), ["id"])
    out = vector.containment(runs, "id", 0.2)
    assert "MapInArrow" in runs._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 5 + 8


def _planned(monkeypatch):
    """From now on no lookup counts as small. The function keeps a table and its plan, as those that are kept on the way."""
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpointed(df)

    for module in (vector, scale):
        monkeypatch.setattr(module, "checkpointed", kept)
    monkeypatch.setattr(scale, "is_small", lambda *_: False)
    return kept, plans


def test_merging_neighbors_broadcasts_no_runs(spark, monkeypatch):
    """Spark expects a few bytes of the runs of few polygons; no side that was not counted may be broadcast."""
    runs = vector.dissolve(vector.cover_runs(_small_boxes(spark, 5), 1.0, ["id"]), ["id"])
    want = sorted(vector.merge_neighbors(vector.containment(runs, "id", 0.2), "id", 0.2).collect())
    assert len(want) == 13
    kept, plans = _planned(monkeypatch)
    got = vector.merge_neighbors(vector.containment(runs, "id", 0.2), "id", 0.2)
    assert sorted(kept(got).collect()) == want
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_merged_frames_broadcast_no_members(spark, monkeypatch):
    members = spark.range(40).selectExpr("CONCAT('g', id % 4) AS group_id", "id AS frame")
    frames = spark.range(40).selectExpr("id AS frame", "CAST(id % 7 AS INT) AS pathNumber", "id AS frameNumber", "3 AS num_granules")
    want = sorted(vector.merged_frames(members, frames, "frame").collect())
    assert len(want) == 40 and {r.members for r in want} == {10} and {r.num_granules for r in want} == {30}
    kept, plans = _planned(monkeypatch)
    assert sorted(kept(vector.merged_frames(members, frames, "frame")).collect()) == want
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_utm_tiles_project_each_vertex_once(spark):
    aoi = spark.range(3).select(vector.box_ring(F.col("id") * 0.1 - 75, F.lit(1.0), F.col("id") * 0.1 - 74.9, F.lit(1.1)).alias("ring"))
    tiles = jobs.utm_tiles(aoi, 25_000.0)
    assert "atan2" not in tiles._jdf.queryExecution().optimizedPlan().toString().lower()
    assert tiles.where("mask = 1").count() > 0
