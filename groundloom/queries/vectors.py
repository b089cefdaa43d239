"""Queries: polygons, tilings, footprint algebra, projection."""

from pyspark.sql import functions as F

from groundloom.functions import geodesy
from groundloom.operators import vector as ops
from groundloom.plans import jobs
from groundloom.queries.base import Tables, query, rounded

TRIANGLE = [(0.0, 0.0), (800.0, 0.0), (0.0, 500.0)]
CELL = 10.0


def _boxes(t: Tables, view: str):
    return t.view(view).withColumn("ring", ops.box_ring("xmin", "ymin", "xmax", "ymax"))


def _aoi(t: Tables):
    """Small boxes at the lower left of every supplier footprint."""
    return t.view("v_foot").select(ops.box_ring("xmin", "ymin", F.col("xmin") + 20, F.col("ymin") + 20).alias("ring"))


@query("points_from_lonlat", "SELECT pid, lon AS x, lat AS y FROM v_points", ("v_points",))
def _(t: Tables):
    return ops.points_from_lonlat(t.view("v_points")).select("pid", "point.x", "point.y")


@query("intersects", """
SELECT burst_id, xmax >= 0 AND ymax >= 0 AND xmin <= 800 AND ymin <= 500 AND xmin / 800 + ymin / 500 <= 1 AS meets FROM v_burst""",
       ("v_burst",))
def _(t: Tables):
    meets = ops.intersects("ring", ops.ring_of(TRIANGLE))
    return _boxes(t, "v_burst").select("burst_id", meets.alias("meets"))


@query("spatial_join", """
SELECT b.burst_id, f.id FROM v_burst b JOIN v_foot f ON b.xmin <= f.xmax AND b.xmax >= f.xmin AND b.ymin <= f.ymax AND b.ymax >= f.ymin""",
       ("v_burst", "v_foot"))
def _(t: Tables):
    feet = _boxes(t, "v_foot").select("id", F.col("ring").alias("other_ring"))
    return ops.spatial_join(_boxes(t, "v_burst").select("burst_id", "ring"), feet, 100.0).select("burst_id", "id")


@query("intersects_aoi", """
SELECT scene_no, pathNumber FROM v_scenes s WHERE EXISTS (SELECT 1 FROM v_foot f WHERE s.xmin <= f.xmin + 20 AND s.xmax >= f.xmin
AND s.ymin <= f.ymin + 20 AND s.ymax >= f.ymin)""", ("v_scenes", "v_foot"))
def _(t: Tables):
    scenes = _boxes(t, "v_scenes").select("scene_no", "pathNumber", "ring")
    return ops.intersects_aoi(scenes, _aoi(t), "scene_no", 100.0).select("scene_no", "pathNumber")


def _tile_sql(left: str, top: str, nx: str, ny: str, size: int) -> str:
    return f"""bb AS (SELECT MIN(xmin) AS x0, MIN(ymin) AS y0, MAX(xmin) + 20 AS x1, MAX(ymin) + 20 AS y1 FROM v_foot),
 fr AS (SELECT {left} AS lft, {top} AS top, CAST({nx} AS BIGINT) AS nx, CAST({ny} AS BIGINT) AS ny FROM bb),
 tl AS (SELECT CAST(i AS INT) AS h, CAST(j AS INT) AS v, CAST(lft + i * {size} AS DOUBLE) AS xmin, CAST(top - j * {size} AS DOUBLE) AS ymax,
  CAST(lft + (i + 1) * {size} AS DOUBLE) AS xmax, CAST(top - (j + 1) * {size} AS DOUBLE) AS ymin FROM fr,
  generate_series(0, (SELECT nx - 1 FROM fr)) a(i), generate_series(0, (SELECT ny - 1 FROM fr)) b(j)),
 tiles AS (SELECT h, v, CASE WHEN EXISTS (SELECT 1 FROM v_foot f WHERE tl.xmin <= f.xmin + 20 AND tl.xmax >= f.xmin
  AND tl.ymin <= f.ymin + 20 AND tl.ymax >= f.ymin) THEN 1 ELSE 0 END AS mask, xmin, ymin, xmax, ymax FROM tl)"""


_CENTERED = _tile_sql("FLOOR(((x0 + x1) / 2 - CEIL((x1 - x0) / 37) / 2 * 37) / 100) * 100 + 5",
                      "FLOOR(((y0 + y1) / 2 - CEIL((y1 - y0) / 37) / 2 * 37) / 100) * 100 - 3 + CEIL((y1 - y0) / 37) * 37",
                      "CEIL((x1 - x0) / 37)", "CEIL((y1 - y0) / 37)", 37)
_SNAPPED = _tile_sql("FLOOR(x0 / 150) * 150", "CEIL(y1 / 150) * 150", "CEIL(x1 / 150) - FLOOR(x0 / 150)",
                     "CEIL(y1 / 150) - FLOOR(y0 / 150)", 150)


@query("make_tiles", f"WITH {_CENTERED} SELECT h, v, mask, xmin, ymin, xmax, ymax, 32618 AS epsg FROM tiles", ("v_foot",))
def _(t: Tables):
    return ops.make_tiles(_aoi(t), 37.0, True, 5, -3, epsg=32618).drop("ring")


@query("make_tiles_snapped", f"WITH {_SNAPPED} SELECT h, v, mask, xmin, ymin, xmax, ymax FROM tiles", ("v_foot",))
def _(t: Tables):
    return ops.make_tiles(_aoi(t), 150.0, centered=False).drop("ring", "epsg")


@query("tile_burst_map", f"""WITH {_SNAPPED}
SELECT h, v, mask, burst_id FROM tiles t LEFT JOIN v_burst b ON b.xmin <= t.xmax
AND b.xmax >= t.xmin AND b.ymin <= t.ymax AND b.ymax >= t.ymin""", ("v_foot", "v_burst"))
def _(t: Tables):
    tiles = ops.make_tiles(_aoi(t), 150.0, centered=False)
    return ops.tile_burst_map(tiles, _boxes(t, "v_burst").select("burst_id", "ring"), cell=150.0)


@query("degree_tiles", """
WITH b AS (SELECT lon AS x0, lat AS y0, lon + 0.4 AS x1, lat + 0.3 AS y1 FROM v_points),
 t AS (SELECT DISTINCT CAST(i AS INT) AS x, CAST(j AS INT) AS y FROM generate_series(-77, -71) a(i), generate_series(-12, 20) g(j), b
  WHERE x0 <= i + 1 AND x1 >= i AND y0 <= j AND y1 >= j - 1 AND j > (SELECT FLOOR(MIN(y0)) FROM b) AND j <= (SELECT CEIL(MAX(y1)) FROM b)
  AND i >= (SELECT FLOOR(MIN(x0)) FROM b) AND i < (SELECT CEIL(MAX(x1)) FROM b))
SELECT printf('%s%02d%s%03d', CASE WHEN y >= 0 THEN 'N' ELSE 'S' END, ABS(y), CASE WHEN x >= 0 THEN 'E' ELSE 'W' END, ABS(x)) AS tile FROM t""",
       ("v_points",))
def _(t: Tables):
    ring = ops.box_ring("lon", "lat", F.col("lon") + 0.4, F.col("lat") + 0.3)
    return ops.degree_tiles(t.view("v_points").select(ring.alias("ring")))


# ---- coverings -----------------------------------------------------------------------------

def _cells_sql(view: str, key: str, size: int) -> str:
    return f"""SELECT {key}, CAST(i AS BIGINT) AS cx, CAST(j AS BIGINT) AS cy FROM {view},
 UNNEST(generate_series(CAST(CEIL(xmin / {size} - 0.5) AS BIGINT), CAST(CEIL(xmax / {size} - 0.5) AS BIGINT) - 1)) a(i),
 UNNEST(generate_series(CAST(CEIL(ymin / {size} - 0.5) AS BIGINT), CAST(CEIL(ymax / {size} - 0.5) AS BIGINT) - 1)) b(j)"""


@query("cover_cells", f"""WITH c AS ({_cells_sql('v_burst', 'burst_id, xmin, ymin, xmax, ymax', 5)})
SELECT burst_id, cx, cy FROM c WHERE (cx * 5 + 2.5 - xmin) / (xmax - xmin) + (cy * 5 + 2.5 - ymin) / (ymax - ymin) < 1""", ("v_burst",))
def _(t: Tables):
    def vertex(x, y):
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))

    ring = F.array(vertex("xmin", "ymin"), vertex("xmax", "ymin"), vertex("xmin", "ymax"))
    return ops.cover_cells(t.view("v_burst").select("burst_id", ring.alias("ring")), 5.0, ["burst_id"])


@query("dissolve", f"WITH c AS ({_cells_sql('v_burst', '1 AS k', 5)}) SELECT DISTINCT cx, cy FROM c", ("v_burst",))
def _(t: Tables):
    return ops.cells_of(ops.dissolve(ops.cover_runs(_boxes(t, "v_burst"), 5.0, [])), [])


@query("group_granules", f"""
WITH c AS ({_cells_sql('v_scenes', 'pathNumber, frameNumber', 10)}),
 a AS (SELECT pathNumber, frameNumber, COUNT(DISTINCT cx * 100000 + cy) * 100.0E0 AS area FROM c GROUP BY ALL)
SELECT s.pathNumber, s.frameNumber, COUNT(*) OVER (PARTITION BY s.pathNumber, s.frameNumber) AS num_granules, filename AS granule,
COALESCE(area, 6.0E0) AS area FROM (SELECT * FROM v_scenes UNION ALL SELECT * REPLACE (-1 AS pathNumber) FROM v_scenes) s
LEFT JOIN a ON a.pathNumber = s.pathNumber AND a.frameNumber = s.frameNumber""",
       ("v_scenes",))
def _(t: Tables):
    # every scene once more as a sliver of 2 by 3 that holds no centre of a cell
    scenes = _boxes(t, "v_scenes")
    sliver = ops.box_ring(F.lit(6.0), F.lit(6.0), F.lit(8.0), F.lit(9.0))
    thin = scenes.withColumns({"pathNumber": F.lit(-1), "ring": sliver})
    return ops.group_granules(scenes.unionByName(thin), CELL, "filename")


def _foot_runs(t: Tables):
    return ops.dissolve(ops.cover_runs(_boxes(t, "v_foot"), CELL, ["id"]), ["id"])


@query("overlap_ratio", """
SELECT a.id, b.id AS other, ROUND((LEAST(a.xmax, b.xmax) - GREATEST(a.xmin, b.xmin)) * (LEAST(a.ymax, b.ymax) - GREATEST(a.ymin, b.ymin))
 / 10000, 9) AS ratio FROM v_foot a JOIN v_foot b ON a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax""",
       ("v_foot",))
def _(t: Tables):
    return ops.overlap_ratio(_foot_runs(t), "id").withColumn("ratio", rounded("ratio", 9))


@query("containment", """
SELECT a.id, b.id AS other, ROUND((LEAST(a.xmax, b.xmax) - GREATEST(a.xmin, b.xmin)) * (LEAST(a.ymax, b.ymax) - GREATEST(a.ymin, b.ymin))
 / 10000, 9) AS ratio FROM v_foot a JOIN v_foot b ON a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax
WHERE (LEAST(a.xmax, b.xmax) - GREATEST(a.xmin, b.xmin)) * (LEAST(a.ymax, b.ymax) - GREATEST(a.ymin, b.ymin)) > 7000""", ("v_foot",))
def _(t: Tables):
    return ops.containment(_foot_runs(t), "id", 0.7).withColumn("ratio", rounded("ratio", 9))


def _twins(t: Tables):
    """Every footprint twice, the second time shifted a little."""
    feet = t.view("v_foot")
    first = feet.select((F.col("id") * 2).alias("frame"), "xmin", "ymin", "xmax", "ymax")
    second = feet.select((F.col("id") * 2 + 1).alias("frame"), F.col("xmin") + 2, "ymin", F.col("xmax") + 2, "ymax")
    both = first.union(second).withColumn("ring", ops.box_ring("xmin", "ymin", "xmax", "ymax"))
    return both, ops.dissolve(ops.cover_runs(both, 2.0, ["frame"]), ["frame"])


@query("merge_neighbors", "SELECT id * 2 AS leader, CAST(2 AS BIGINT) AS members FROM v_foot", ("v_foot",))
def _(t: Tables):
    _, runs = _twins(t)
    groups = ops.merge_neighbors(ops.containment(runs, "frame"), "frame")
    return groups.groupBy("group_id").agg(F.min("frame").alias("leader"), F.count(F.lit(1)).alias("members")).drop("group_id")


@query("merged_frames", """
SELECT CAST(id % 7 AS INT) AS pathNumber, CAST(k + 1 AS BIGINT) AS position, id * 2 + k AS frameNumber, CAST(2 AS BIGINT) AS members,
CAST(6 AS BIGINT) AS num_granules FROM v_foot, (SELECT unnest([0, 1]) AS k)""", ("v_foot",))
def _(t: Tables):
    both, runs = _twins(t)
    groups = ops.merge_neighbors(ops.containment(runs, "frame"), "frame")
    frames = both.select("frame", (F.floor(F.col("frame") / 2) % 7).cast("int").alias("pathNumber"), F.lit(3).alias("num_granules"),
                         F.col("frame").alias("frameNumber"))
    return ops.merged_frames(groups, frames, "frame").drop("group_id")


_FOOT_CELLS = f"f AS ({_cells_sql('v_foot', 'id', 10)}), a AS (SELECT DISTINCT cx, cy FROM ({_cells_sql('v_burst', '1 AS k', 10)}))"


@query("exclusive_overlap", f"""
WITH {_FOOT_CELLS}, o AS (SELECT cx, cy, MIN(id) AS id FROM f GROUP BY cx, cy HAVING COUNT(*) = 1)
SELECT v.id, COUNT(a.cx) * 100.0E0 AS overlap_with_aoi FROM v_foot v LEFT JOIN o ON o.id = v.id
LEFT JOIN a ON a.cx = o.cx AND a.cy = o.cy GROUP BY v.id""", ("v_foot", "v_burst"))
def _(t: Tables):
    aoi = ops.cover_runs(_boxes(t, "v_burst"), CELL, [])
    return ops.exclusive_overlap(_foot_runs(t), aoi, "id", CELL)


@query("uncovered_area", f"WITH {_FOOT_CELLS} SELECT cx, cy FROM a EXCEPT SELECT cx, cy FROM f", ("v_foot", "v_burst"))
def _(t: Tables):
    aoi = ops.cover_runs(_boxes(t, "v_burst"), CELL, [])
    return ops.cells_of(ops.uncovered_area(_foot_runs(t), aoi), [])


_SKIM = f"""fc AS (SELECT DISTINCT pathNumber, frameNumber, cx, cy FROM ({_cells_sql('v_scenes', 'pathNumber, frameNumber', 20)})),
 a AS (SELECT DISTINCT cx, cy FROM ({_cells_sql('v_burst', '1 AS k', 20)})),
 own AS (SELECT cx, cy, MIN(pathNumber) AS pathNumber, MIN(frameNumber) AS frameNumber FROM fc GROUP BY cx, cy HAVING COUNT(*) = 1),
 keep AS (SELECT pathNumber, frameNumber, COUNT(*) * 400.0E0 AS overlap_with_aoi FROM own JOIN a ON a.cx = own.cx AND a.cy = own.cy GROUP BY ALL)"""


def _skimmed(t: Tables):
    scenes = _boxes(t, "v_scenes").select("scene_no", "scene_name", "pathNumber", "frameNumber", "ring")
    return ops.skim_granules(_boxes(t, "v_burst").select("ring"), scenes, 20.0, "scene_name")


@query("skim_granules", f"""WITH {_SKIM} SELECT scene_no, s.pathNumber, s.frameNumber FROM v_scenes s JOIN keep k
ON k.pathNumber = s.pathNumber AND k.frameNumber = s.frameNumber""", ("v_scenes", "v_burst"))
def _(t: Tables):
    return _skimmed(t)[0].select("scene_no", "pathNumber", "frameNumber")


@query("skim_frames", f"""WITH {_SKIM} SELECT k.pathNumber, k.frameNumber, COUNT(*) AS num_granules,
ANY_VALUE(overlap_with_aoi) AS overlap_with_aoi FROM v_scenes s JOIN keep k
ON k.pathNumber = s.pathNumber AND k.frameNumber = s.frameNumber GROUP BY k.pathNumber, k.frameNumber""", ("v_scenes", "v_burst"))
def _(t: Tables):
    return _skimmed(t)[1].select("pathNumber", "frameNumber", "num_granules", "overlap_with_aoi")


# ---- projection ----------------------------------------------------------------------------

# Eccentricity of WGS84, 0.9996 times its rectifying radius, and the series of the transverse Mercator projection.
_E = 0.08181919084262149
_SCALE = 0.9996 * 6367449.145823415
_SERIES = [8.377318206244698e-04, 7.608527773572309e-07, 1.197645503329453e-09, 2.429170607201359e-12, 5.711757677865804e-15,
           1.4911177312583895e-17]
_NORTH = " + ".join(f"{a!r} * SIN({2 * k} * xi) * COSH({2 * k} * eta)" for k, a in enumerate(_SERIES, 1))
_EAST = " + ".join(f"{a!r} * COS({2 * k} * xi) * SINH({2 * k} * eta)" for k, a in enumerate(_SERIES, 1))


@query("reproject", f"""
WITH a AS (SELECT pid, RADIANS(lon + 75) AS l, SINH(ATANH(SIN(RADIANS(lat))) - {_E!r} * ATANH({_E!r} * SIN(RADIANS(lat)))) AS tp FROM v_points),
 b AS (SELECT pid, ATAN2(tp, COS(l)) AS xi, ATANH(SIN(l) / SQRT(1 + tp * tp)) AS eta FROM a)
SELECT pid, ROUND(500000 + {_SCALE!r} * (eta + {_EAST}), 5) AS x, ROUND(10000000 + {_SCALE!r} * (xi + {_NORTH}), 5) AS y FROM b""",
       ("v_points",))
def _(t: Tables):
    pts = t.view("v_points").select("pid", F.col("lon").alias("x"), F.col("lat").alias("y"))
    out = geodesy.reproject(pts, "x", "y", 4326, 32718)
    return out.select("pid", rounded("x", 5).alias("x"), rounded("y", 5).alias("y"))


@query("reproject_back", "SELECT pid, ROUND(lon, 9) AS x, ROUND(lat, 9) AS y FROM v_points", ("v_points",))
def _(t: Tables):
    pts = t.view("v_points").select("pid", F.col("lon").alias("x"), F.col("lat").alias("y"))
    there = geodesy.reproject(pts, "x", "y", 4326, 32718)
    other = geodesy.reproject(there, "x", "y", 32718, 32618)
    back = geodesy.reproject(other, "x", "y", 32618, 4326)
    return back.select("pid", rounded("x", 9).alias("x"), rounded("y", 9).alias("y"))


# ---- more forms of the same operators ------------------------------------------------------

@query("burst_footprints", f"""WITH c AS ({_cells_sql('v_scenes', 'LEFT(scene_name, 25) AS burst_id', 20)})
SELECT burst_id, COUNT(DISTINCT cx * 100000 + cy) * 400.0E0 AS area FROM c GROUP BY burst_id""", ("v_scenes",))
def _(t: Tables):
    bursts = _boxes(t, "v_scenes").select(F.substring("scene_name", 1, 25).alias("burst_id"), "ring")
    return ops.covered_area(ops.dissolve(ops.cover_runs(bursts, 20.0, ["burst_id"]), ["burst_id"]), 20.0, ["burst_id"])


@query("reduce_union", f"""WITH c AS ({_cells_sql('v_burst', 'CAST(SUBSTRING(burst_id, 2) AS BIGINT) % 11 AS part', 5)})
SELECT part, COUNT(DISTINCT cx * 100000 + cy) AS cells FROM c GROUP BY part""", ("v_burst",))
def _(t: Tables):
    parts = _boxes(t, "v_burst").select((F.substring("burst_id", 2, 9).cast("bigint") % 11).alias("part"), "ring")
    united = ops.dissolve(ops.cover_runs(parts, 5.0, ["part"]), ["part"])
    return united.groupBy("part").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("cells"))


@query("rows_from_area", """
SELECT burst_id, CAST(i AS BIGINT) AS tx, CAST(j AS BIGINT) AS ty FROM v_burst,
UNNEST(generate_series(CAST(FLOOR(xmin / 20) AS BIGINT), CAST(FLOOR(xmax / 20) AS BIGINT))) a(i),
UNNEST(generate_series(CAST(FLOOR(ymin / 20) AS BIGINT), CAST(FLOOR(ymax / 20) AS BIGINT))) b(j)""", ("v_burst",))
def _(t: Tables):
    return ops.rows_from_area(_boxes(t, "v_burst").select("burst_id", "ring"), 20.0, ["burst_id"])


@query("utm_tiles")
def _(t: Tables):
    ring = ops.box_ring("lon", "lat", F.col("lon") + 0.01, F.col("lat") + 0.01)
    return jobs.utm_tiles(t.view("v_points").select(ring.alias("ring")), 25_000.0).drop("ring")
