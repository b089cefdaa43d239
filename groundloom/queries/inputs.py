"""Queries: sources and sinks, on tables written by Spark."""

from pyspark.sql import functions as F

from groundloom.operators import vector
from groundloom.operators.grids import Grid, to_tiles
from groundloom.queries.base import Tables, query, rounded
from groundloom.queries.rasters import DENSE
from groundloom.session import work_path
from groundloom.sources import features, flatstack, listing, pixels, tabular

POINTS = "pid long, lon double, lat double, cls string, x1 double, name string"


@query("read_points", "SELECT pid, lon, lat, cls, x1, concat(name, ', \"', cls, '\"') AS name FROM v_points", ("v_points",))
def _(t: Tables):
    path = work_path(t.spark, "points")
    pts = t.view("v_points").select("pid", "lon", "lat", "cls", "x1",
                                    F.concat("name", F.lit(', "'), "cls", F.lit('"')).alias("name"))
    tabular.write_points(pts, path, float_format=None)
    return tabular.read_points(t.spark, path, POINTS)


@query("write_points", "SELECT pid, printf('%.6f', lon) AS lon, printf('%.6f', lat) AS lat, cls FROM v_points", ("v_points",))
def _(t: Tables):
    path = work_path(t.spark, "points")
    tabular.write_points(t.view("v_points").select("pid", "lon", "lat", "cls"), path)
    return tabular.read_points(t.spark, path, "pid long, lon string, lat string, cls string")


def _feet(t: Tables):
    return t.view("v_foot").select("id", vector.box_ring("xmin", "ymin", "xmax", "ymax").alias("ring"))


@query("read_features", "SELECT id, 4 AS vertices, xmin, ymin, xmax, ymax, 4326 AS epsg FROM v_foot", ("v_foot",))
def _(t: Tables):
    path = work_path(t.spark, "features")
    features.write_features(_feet(t), path)
    back = features.read_features(t.spark, path, "id: bigint", by_line=True)
    return back.select("id", F.size("ring").alias("vertices"), *[c.alias(n) for n, c in vector.ring_bounds(F.col("ring")).items()], "epsg")


@query("write_features", """
SELECT id, concat('POLYGON ((', xmin, ' ', ymax, ', ', xmax, ' ', ymax, ', ', xmax, ' ', ymin, ', ', xmin, ' ', ymin, ', ', xmin, ' ', ymax,
'))') AS geometry FROM v_foot""", ("v_foot",))
def _(t: Tables):
    path = work_path(t.spark, "features")
    features.write_features(_feet(t), path, as_wkt=True)
    return t.spark.read.schema("id long, geometry string").option("header", True).csv(path)


@query("read_flat_stack", f"""
WITH {DENSE} SELECT pr, pc, ROUND(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS value,
ROUND(CAST(CAST(value / 3 AS FLOAT) AS DOUBLE), 4) AS third FROM d""", ("v_px",))
def _(t: Tables):
    path = work_path(t.spark, "stack").removeprefix("file:")
    px = t.view("v_px").withColumn("third", F.col("value") / 3)
    n_rows = px.agg(F.max("pr")).first()[0] + 1
    flatstack.write_flat_stack(px, path, Grid(1000.0, 5000.0, 30.0, n_rows, 120), ["value", "third"], rows_per_file=32).count()
    back = flatstack.read_flat_stack(t.spark, path, rows_per_part=16)
    return back.select("pr", "pc", *[rounded(F.col(c).cast("double"), 4).alias(c) for c in ("value", "third")])


@query("write_pixel_table", """
SELECT CAST(FLOOR(pc / 5.0) AS INT) AS h, CAST(FLOOR(pr / 5.0) AS INT) AS v, pr % 5 AS pr, pc % 5 AS pc, c_vv, ndvi FROM v_stack""",
       ("v_stack",))
def _(t: Tables):
    path = work_path(t.spark, "pixels")
    pixels.write_pixel_table(to_tiles(t.view("v_stack"), 5), path)
    return pixels.read_pixel_table(t.spark, path, ["c_vv", "ndvi"])


@query("file_catalog", """
SELECT DISTINCT concat('h=', CAST(FLOOR(pc / 32.0) AS INT), '/v=', CAST(FLOOR(pr / 32.0) AS INT), '/') AS tile, TRUE AS found, TRUE AS filled
FROM v_px""", ("v_px",))
def _(t: Tables):
    path = work_path(t.spark, "pixels")
    pixels.write_pixel_table(to_tiles(t.view("v_px"), 32), path)
    files = listing.file_catalog(t.spark, path, "*.parquet")
    tile = F.regexp_extract("path", r"h=(\d+)/v=(\d+)/", 0)
    # how many files a tile has and how long they are depends on the writing tasks
    return files.groupBy(tile.alias("tile")).agg((F.count(F.lit(1)) > 0).alias("found"), (F.sum("length") > 0).alias("filled"))


@query("file_catalog_tiles", """
SELECT concat('h=', CAST(FLOOR(pc / 32.0) AS INT), '/v=', CAST(FLOOR(pr / 32.0) AS INT), '/') AS tile, CAST(1 AS BIGINT) AS files
FROM v_px GROUP BY ALL""", ("v_px",))
def _(t: Tables):
    path = work_path(t.spark, "pixels")
    # a tile is written by one task, so it has one file
    to_tiles(t.view("v_px"), 32).repartition("h", "v").write.partitionBy("h", "v").parquet(path)
    files = listing.file_catalog(t.spark, path, "*.parquet")
    return files.groupBy(F.regexp_extract("path", r"h=(\d+)/v=(\d+)/", 0).alias("tile")).agg(F.count(F.lit(1)).alias("files"))


@query("read_catalog_json", """
SELECT concat('job', o_orderkey) AS job_id, concat('S1A_', o_custkey) AS granule, CAST(o_totalprice > 100000 AS VARCHAR) AS dem FROM orders""")
def _(t: Tables):
    path = work_path(t.spark, "jobs")
    value = F.struct(F.array(F.concat(F.lit("S1A_"), "o_custkey")).alias("granules"), (F.col("o_totalprice") > 100000).alias("dem"))
    docs = t.table("orders").select(F.to_json(F.create_map(F.concat(F.lit("job"), "o_orderkey"), value)))
    docs.write.text(path)
    jobs = listing.read_catalog_json(t.spark, path, "granules: array<string>, dem: boolean", by_line=True)
    return jobs.select("job_id", F.element_at("granules", 1).alias("granule"), F.col("dem").cast("string").alias("dem"))
