"""Sources, sinks and incremental jobs."""

import json
import os
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from groundloom.functions.frames import scene_map
from groundloom.operators import vector
from groundloom.operators.grids import Grid
from groundloom.operators.shots import process_shots
from groundloom.queries import streams
from groundloom.queries.base import Tables
from groundloom.sources import features, flatstack, listing, pixels, tabular
from groundloom.streaming import arrivals
from tests.test_neighborhood import table

HEADER = """ENVI
description = {{
  test}}
samples = 5
lines   = 4
bands   = 2
header offset = {offset}
data type = {code}
interleave = {layout}
byte order = {order}
map info = {{Geographic Lat/Lon, 1, 1, 100.0, 50.0, 0.5, 0.5,WGS-84}}
band names = {{
VV mean,
ndvi}}
"""


@pytest.mark.parametrize("layout", ["bsq", "bil", "bip"])
@pytest.mark.parametrize("code,kind,order", [(4, "f4", 0), (2, "i2", 1), (1, "u1", 0), (5, "f8", 1)])
def test_flat_stack_layouts(spark, tmp_path, layout, code, kind, order):
    cube = (np.arange(40).reshape(2, 4, 5) % 17).astype((">" if order else "<") + kind)
    moved = {"bsq": cube, "bil": cube.transpose(1, 0, 2), "bip": cube.transpose(1, 2, 0)}[layout]
    (tmp_path / "img").write_bytes(b"xxxx" + moved.tobytes())
    (tmp_path / "img.hdr").write_text(HEADER.format(offset=4, code=code, layout=layout, order=order))
    got = flatstack.read_flat_stack(spark, str(tmp_path / "img.hdr"), rows_per_part=3, nodata=7).toPandas()
    assert len(got) == 20 and list(got.columns) == ["pr", "pc", "vv_mean", "ndvi"]
    for band, name in zip(cube, ["vv_mean", "ndvi"]):
        want = band[got.pr, got.pc].astype(float)
        want[want == 7] = np.nan
        np.testing.assert_array_equal(got[name].astype(float), want)


def test_flat_stack_round_trip_over_several_files(spark, tmp_path):
    image = np.random.default_rng(0).normal(size=(50, 9)).astype("f4")
    image[3, 4] = np.nan
    px = table(spark, image.astype(float)).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    files = flatstack.write_flat_stack(px, str(tmp_path / "s"), Grid(10.0, 99.0, 0.25, 50, 9), ["value"], rows_per_file=16)
    assert files.count() == 4
    back = flatstack.read_flat_stack(spark, str(tmp_path / "s")).toPandas().set_index(["pr", "pc"]).value
    assert np.isnan(back[(3, 4)]) and len(back) == 450
    np.testing.assert_array_equal(back.unstack().to_numpy(), image)


def test_feature_collection_and_multipolygon(spark, tmp_path):
    square = [[[0, 0], [0, 1], [1, 1], [1, 0], [0, 0]]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a", "n": 1}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"name": "b", "n": 2},
         "geometry": {"type": "MultiPolygon", "coordinates": [square, [[[5, 5], [6, 5], [6, 7.5]]]]}}]}
    (tmp_path / "f.geojson").write_text(json.dumps(doc, indent=1))
    out = features.read_features(spark, str(tmp_path / "f.geojson"), "name: string, n: int", 4326).collect()
    assert [(r.name, len(r.ring)) for r in out] == [("a", 4), ("b", 4), ("b", 3)]
    assert out[2].ring[2] == (6.0, 7.5)
    features.write_features(spark.createDataFrame(out).drop("epsg"), str(tmp_path / "out"))
    again = features.read_features(spark, str(tmp_path / "out"), "name: string, n: int", by_line=True)
    assert sorted(again.collect()) == sorted(out)


def test_example_points_parse_quoted_fields(spark, tmp_path):
    (tmp_path / "p.csv").write_text('SampleID,user_class,my_class,longitude\n1,"forest, shrub, or grass",NA,113.5\n')
    row = tabular.read_points(spark, str(tmp_path / "p.csv"), "SampleID int, user_class string, my_class string, longitude double").first()
    assert tuple(row) == (1, "forest, shrub, or grass", None, 113.5)


def test_job_documents_and_file_catalog(spark, tmp_path):
    (tmp_path / "jobs.json").write_text(json.dumps({"j1": {"granules": ["g1"], "res": 30}, "j2": {"granules": ["g2", "g3"]}}, indent=2))
    jobs = listing.read_catalog_json(spark, str(tmp_path / "jobs.json"), "granules: array<string>, res: int")
    assert sorted(jobs.collect()) == [("j1", ["g1"], 30), ("j2", ["g2", "g3"], None)]
    files = listing.file_catalog(spark, str(tmp_path), "*.json")
    assert [(r.name, r.length) for r in files.collect()] == [("jobs.json", os.path.getsize(tmp_path / "jobs.json"))]


def test_pixel_table_is_pruned_by_tile(spark, tmp_path):
    px = table(spark, np.arange(64.0).reshape(8, 8)).withColumns({"h": F.floor(F.col("pc") / 4).cast("int"), "v": F.lit(0)})
    pixels.write_pixel_table(px, str(tmp_path / "t"))
    one = pixels.read_pixel_table(spark, str(tmp_path / "t"), ["value"]).where("h = 1")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(h" in plan and one.count() == 32


# ---- streams -------------------------------------------------------------------------------

def shot_file(seed, file_no):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({f"elev{i}": rng.normal(50, 0.4, 80) for i in range(1, 7)})
    pdf["file_no"], pdf["sensitivity"], pdf["rh95"] = file_no, rng.uniform(0.8, 1, 80), rng.normal(3, 2, 80)
    return pdf


def test_shot_stream_equals_batch_and_runs_once_per_file(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    shot_file(1, 1).to_parquet(folder / "a.parquet")
    shot_file(2, 2).to_parquet(folder / "b.parquet")
    schema = spark.read.parquet(str(folder)).schema

    def run():
        arrivals.stream_shots(spark.readStream.schema(schema).parquet(str(folder)), str(tmp_path / "out"), str(tmp_path / "state"))

    run()
    run()
    shot_file(3, 3).assign(sensitivity=0.1).to_parquet(folder / "c.parquet")
    run()
    kept, report = arrivals.read_shots(spark, str(tmp_path / "out"))
    want = process_shots(spark.read.parquet(str(folder)))
    cols = ["file_no", "elev1", "elev_range", "rh95"]

    def rows(df):
        return sorted(tuple(round(v, 9) for v in r) for r in df.select(*cols).collect())

    assert rows(kept) == rows(want)
    assert {r.file_no: r.processed for r in report.collect()} == {1: True, 2: True, 3: False}


def test_shot_file_over_three_batches_equals_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    whole = pd.concat([shot_file(4, 1), shot_file(5, 2)], ignore_index=True).sample(frac=1, random_state=1)
    for k in range(3):
        whole.iloc[k::3].to_parquet(folder / f"{k}.parquet")
    other = shot_file(6, 3)
    other.to_parquet(folder / "only.parquet")
    stream = (spark.readStream.schema(spark.read.parquet(str(folder)).schema).option("maxFilesPerTrigger", 1).parquet(str(folder)))
    arrivals.stream_shots(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    kept, report = arrivals.read_shots(spark, str(tmp_path / "out"))
    want = process_shots(spark.createDataFrame(pd.concat([whole, other])))
    cols = ["file_no", "elev1", "elev_range", "rh95"]

    def rows(df):
        return sorted(tuple(round(v, 9) for v in r) for r in df.select(*cols).collect())

    assert rows(kept) == rows(want) and len(rows(kept)) > 0
    counts = {r.file_no: r.n_shots for r in report.collect()}
    assert sorted(counts) == [1, 2, 3] and sum(counts.values()) == len(rows(want))
    # a batch without its list does not count: readers see what the last listed batch left
    last = max((tmp_path / "out" / "current").glob("batch=*"), key=lambda f: int(f.name.split("=")[1]))
    last.rename(tmp_path / "stopped")
    before = arrivals.read_shots(spark, str(tmp_path / "out"))[0]
    assert 0 < before.count() < len(rows(want))


@pytest.mark.parametrize("delay", [None, "400 days"])
def test_product_stream_replaces_older_processing(spark, tmp_path, delay):
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive(name, rows):
        pdf = pd.DataFrame(rows, columns=["burst", "acq", "proc", "path"])
        pdf["proc"] = pd.to_datetime(pdf.proc).astype("datetime64[us]")
        pdf.to_parquet(folder / name)

    schema = "burst string, acq string, proc timestamp_ntz, path string"

    def run():
        stream = spark.readStream.schema(schema).parquet(str(folder))
        if delay:
            stream = stream.withColumn("proc", F.col("proc").cast("timestamp"))
        arrivals.stream_products(stream, str(tmp_path / "table"), str(tmp_path / "state"), ["burst", "acq"], "proc", delay=delay)

    arrive("1.parquet", [("a", "d1", "2020-01-01", "p1"), ("a", "d1", "2020-01-01", "p1"), ("b", "d1", "2020-01-01", "p2"),
                         ("a", "d2", "2020-01-01", "p3")])
    run()
    arrive("2.parquet", [("a", "d1", "2020-02-01", "p4"), ("b", "d1", "2019-12-01", "old"), ("c", "d3", "2020-02-01", "p5")])
    run()
    got = arrivals.read_products(spark, str(tmp_path / "table")).select("burst", "acq", "path")
    assert sorted(map(tuple, got.collect())) == [("a", "d1", "p4"), ("a", "d2", "p3"), ("b", "d1", "p2"), ("c", "d3", "p5")]


def test_a_batch_that_stops_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()

    def arrive(name, rows):
        pd.DataFrame(rows, columns=["burst", "acq", "proc", "path"]).to_parquet(folder / name)

    def run():
        stream = spark.readStream.schema("burst string, acq string, proc long, path string").parquet(str(folder))
        arrivals.stream_products(stream, table, str(tmp_path / "state"), ["burst", "acq"], "proc")

    def now():
        return sorted(map(tuple, arrivals.read_products(spark, table).select("burst", "acq", "path").collect()))

    arrive("1.parquet", [("a", "2020-01-01", 1, "p1"), ("b", "01", 1, "p2"), ("c", None, 1, "p3")])
    run()
    before = now()
    assert before == [("a", "2020-01-01", "p1"), ("b", "01", "p2"), ("c", None, "p3")]

    def stopped(*_):
        raise RuntimeError("stopped")

    arrive("2.parquet", [("a", "2020-01-01", 2, "p4"), ("c", None, 2, "p5"), ("d", "02", 1, "p6")])
    with monkeypatch.context() as m:
        m.setattr(arrivals, "_commit", stopped)
        with pytest.raises(Exception):
            run()
    assert now() == before
    run()
    assert {r[2] for r in now()} == {"p2", "p4", "p5", "p6"}


def test_no_local_checkpoint_or_local_folder_on_a_cluster():
    for path in Path(__file__).resolve().parents[1].joinpath("groundloom").rglob("*.py"):
        text = path.read_text()
        assert "local" + "Checkpoint" not in text and "cross" + "Join(" not in text


def test_holes_and_other_features(spark, tmp_path):
    outer, hole = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], [[4, 4], [4, 6], [6, 6], [6, 4], [4, 4]]
    square = {"type": "Feature", "properties": {"id": 1}, "geometry": {"type": "Polygon", "coordinates": [outer, hole]}}
    path = tmp_path / "holes.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [square]}))
    polys = features.read_features(spark, str(path), "id int").select("id", "ring")
    assert vector.cover_cells(polys, 1.0, ["id"]).count() == 96
    inside = polys.select(*[vector.point_in_ring(F.lit(x), F.lit(x), F.col("ring")).alias(f"p{i}") for i, x in enumerate((2.0, 5.0))],
                          vector.ring_area(F.col("ring")).alias("area"),
                          vector.intersects(F.col("ring"), vector.box_ring(F.lit(4.5), F.lit(4.5), F.lit(5.5), F.lit(5.5))).alias("in_hole"),
                          vector.intersects(F.col("ring"), vector.box_ring(F.lit(4.5), F.lit(4.5), F.lit(7.5), F.lit(5.5))).alias("over_edge")).first()
    assert (inside.p0, inside.p1, inside.area, inside.in_hole, inside.over_edge) == (True, False, 96.0, False, True)
    assert polys.select(features.wkt("ring").alias("t")).first().t.count("(") == 3
    features.write_features(polys, str(tmp_path / "out"))
    again = features.read_features(spark, str(tmp_path / "out"), "id int", by_line=True)
    assert again.select("id", "ring").collect() == polys.collect()
    square["geometry"] = {"type": "Point", "coordinates": [1, 2]}
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [square]}))
    with pytest.raises(Exception, match="not a polygon"):
        features.read_features(spark, str(path), "id int").collect()


def test_scene_map_gets_whole_scenes(spark):
    rows = spark.range(30_000).selectExpr("id % 2 AS scene", "id AS v")
    out = scene_map(rows, lambda p: p.assign(n=len(p))[["scene", "n"]].head(1), "scene bigint, n bigint", ["scene"])
    assert sorted(tuple(r) for r in out.collect()) == [(0, 15_000), (1, 15_000)]


def test_merged_frames_are_placed_by_number(spark):
    members = spark.createDataFrame([("g", "1_10"), ("g", "1_9"), ("g", "1_100")], "group_id string, frame string")
    frames = spark.createDataFrame([(1, "1_10", 10, 2), (1, "1_9", 9, 3), (1, "1_100", 100, 4)],
                                   "pathNumber int, frame string, frameNumber int, num_granules int")
    got = vector.merged_frames(members, frames, "frame").orderBy("position").collect()
    assert [(r.position, r.frameNumber, r.members, r.num_granules) for r in got] == [(1, 9, 3, 9), (2, 10, 3, 9), (3, 100, 3, 9)]


def test_file_catalog_agrees_with_the_file_system(spark, tmp_path):
    from pyspark.sql import Row

    px = spark.createDataFrame([Row(h=i % 3, v=i % 2, pr=i, pc=i, value=float(i)) for i in range(300)])
    pixels.write_pixel_table(px, str(tmp_path / "px"), rows_per_file=100)
    got = sorted((r["path"].removeprefix("file:"), r["name"], r["length"])
                 for r in listing.file_catalog(spark, str(tmp_path / "px"), "*.parquet").collect())
    want = sorted((str(p), p.name, p.stat().st_size) for p in (tmp_path / "px").rglob("*.parquet"))
    assert got == want and len(want) >= 6


def test_file_catalog_query_counts_the_files_of_a_tile(spark):
    from __spark_entry__ import queries

    rows = queries()["file_catalog_tiles"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["files"] == 1 for r in rows)


def test_scene_query_hands_over_tiles(spark, monkeypatch):
    from __spark_entry__ import queries
    from groundloom.queries import rasters

    handed = []
    monkeypatch.setattr(rasters, "TILE", 1)
    monkeypatch.setattr(rasters, "scene_map", lambda df, fn, schema, scene: handed.append(
        df.groupBy(*scene).count().agg(F.max("count")).first()[0]) or scene_map(df, fn, schema, scene))
    rows = queries()["scene_map"](spark, "/root/testdata/sf0.001").count()
    largest = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").groupBy("l_shipdate").count().agg(F.max("count")).first()[0]
    assert rows and handed[0] < largest


def test_a_batch_of_a_large_table_has_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 500)
    monkeypatch.setattr(streams, "work_path", lambda spark, name: str(tmp_path / name))
    stream = streams._arriving(Tables(spark, "/root/testdata/sf0.001"), "v_shots", "shot")
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    files = sorted((tmp_path / "arriving").glob("*.parquet"))
    assert len(files) == 3 * -(-rows // 1500)
    sizes = [spark.read.parquet(str(f)).count() for f in files]
    assert sum(sizes) == rows and max(sizes) < 1_000
    batches = []
    query = (stream.writeStream.foreachBatch(lambda df, i: batches.append(df.count()))
             .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert len(batches) == 3 and sum(batches) == rows
