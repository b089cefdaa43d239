"""Queries: scene, burst, product and job tables."""

from pyspark.sql import functions as F

from groundloom.operators import catalog as ops
from groundloom.queries.base import Tables, query

_PARTS = r"""tiles_found AS (SELECT CAST(regexp_extract(tile_file, 'h(\d+)_v', 1) AS INT) AS h,
 CAST(regexp_extract(tile_file, '_v(\d+)_', 1) AS INT) AS v, regexp_extract(tile_file, '_(\w\w\w?)\.tif$', 1) AS layer,
 tile_file FROM v_scenes)"""


def _files(t: Tables):
    scenes = t.view("v_scenes").select(F.col("tile_file").alias("name"))
    return ops.file_key_parts(scenes)


@query("majority_orbit", """
WITH n AS (SELECT COUNT(*) FILTER (WHERE flightDirection = 'ASCENDING') AS up,
 COUNT(*) FILTER (WHERE flightDirection = 'DESCENDING') AS down FROM v_scenes)
SELECT scene_no, flightDirection FROM v_scenes, n
WHERE flightDirection = CASE WHEN up >= down THEN 'ASCENDING' ELSE 'DESCENDING' END""", ("v_scenes",))
def _(t: Tables):
    return ops.majority_orbit(t.view("v_scenes").select("scene_no", "flightDirection"))


@query("sort_catalog", """
SELECT scene_no, pathNumber, frameNumber, CAST(startTime AS DATE) AS day FROM v_scenes ORDER BY pathNumber, frameNumber, startTime""",
       ("v_scenes",))
def _(t: Tables):
    return ops.sort_catalog(t.view("v_scenes").select("scene_no", "pathNumber", "frameNumber", "day"),
                            ["pathNumber", "frameNumber", "day", "scene_no"])


@query("drop_listed", """
SELECT scene_no, pathNumber FROM v_scenes WHERE pathNumber NOT IN
(SELECT pathNumber FROM v_scenes GROUP BY pathNumber HAVING COUNT(*) < 1250)""", ("v_scenes",))
def _(t: Tables):
    scenes = t.view("v_scenes").select("scene_no", "pathNumber")
    rare = scenes.groupBy("pathNumber").count().where("count < 1250")
    return ops.drop_listed(scenes, rare, "pathNumber")


@query("pending_work", """
WITH want AS (SELECT scene_no, platform, pathNumber, frameNumber, startTime FROM v_scenes),
 pend AS (SELECT * FROM want w WHERE NOT EXISTS (SELECT 1 FROM v_scenes d WHERE d.scene_no = w.scene_no
  AND d.platform = w.platform AND d.startTime < TIMESTAMP '1996-01-01 00:00:00') AND NOT EXISTS (SELECT 1 FROM v_scenes d
  WHERE d.scene_no = w.scene_no AND d.platform = w.platform AND (d.level = '5-LOW' OR d.pathNumber = 3)))
SELECT f.pathNumber, f.frameNumber, COUNT(p.scene_no) AS num_granules FROM (SELECT DISTINCT pathNumber, frameNumber FROM v_scenes) f
LEFT JOIN pend p ON p.pathNumber = f.pathNumber AND p.frameNumber = f.frameNumber GROUP BY ALL""", ("v_scenes",))
def _(t: Tables):
    scenes = t.view("v_scenes")
    server = scenes.where("startTime < TIMESTAMP_NTZ '1996-01-01 00:00:00'")
    project = scenes.where("level = '5-LOW' OR pathNumber = 3")      # a path with nothing pending
    pending = ops.pending_work(scenes.select("scene_no", "platform", "pathNumber", "frameNumber"), [server, project],
                               ["scene_no", "platform"])
    return ops.count_by_frame(pending, frames=scenes)


@query("first_n_quota", "SELECT scene_no, pathNumber, day FROM v_scenes ORDER BY pathNumber, day, scene_no LIMIT 500",
       ("v_scenes",))
def _(t: Tables):
    return ops.first_n_quota(t.view("v_scenes").select("scene_no", "pathNumber", "day"), 500,
                             ["pathNumber", "day", "scene_no"])


@query("skip_done", "WITH " + _PARTS + """
SELECT DISTINCT h, v FROM tiles_found EXCEPT (SELECT h, v FROM tiles_found WHERE layer = 'VV'
INTERSECT SELECT h, v FROM tiles_found WHERE layer = 'VH')""", ("v_scenes",))
def _(t: Tables):
    files = _files(t)
    return ops.skip_done(files.select("h", "v").distinct(), files, ["h", "v"], "layer")


@query("expected_vs_found", "WITH " + _PARTS + """,
 tiles AS (SELECT DISTINCT pr AS h, pc AS v, mask FROM v_mask)
SELECT t.h, t.v, CAST(CASE WHEN mask <> 0 THEN COUNT(*) FILTER (WHERE f.layer = 'VV') > 0 END AS VARCHAR) AS vv,
CAST(CASE WHEN mask <> 0 THEN COUNT(*) FILTER (WHERE f.layer = 'VH') > 0 END AS VARCHAR) AS vh,
CAST(CASE WHEN mask <> 0 THEN COUNT(*) FILTER (WHERE f.layer = 'RVI') > 0 END AS VARCHAR) AS rvi
FROM tiles t LEFT JOIN tiles_found f ON t.h = f.h AND t.v = f.v GROUP BY t.h, t.v, mask""", ("v_scenes", "v_mask"))
def _(t: Tables):
    tiles = t.view("v_mask").select(F.col("pr").alias("h"), F.col("pc").alias("v"), "mask").distinct()
    status = ops.expected_vs_found(tiles, _files(t))
    return status.select("h", "v", *[F.col(l).cast("string").alias(l.lower()) for l in ("VV", "VH", "RVI")])


@query("all_found", "WITH " + _PARTS + """,
 st AS (SELECT t.pr, t.pc, COUNT(DISTINCT f.layer) AS n FROM v_mask t LEFT JOIN tiles_found f ON t.pr = f.h AND t.pc = f.v
  WHERE t.mask <> 0 GROUP BY t.pr, t.pc) SELECT BOOL_AND(n = 3) AS all_found FROM st""", ("v_scenes", "v_mask"))
def _(t: Tables):
    tiles = t.view("v_mask").select(F.col("pr").alias("h"), F.col("pc").alias("v"), "mask")
    return ops.all_found(ops.expected_vs_found(tiles, _files(t)))


@query("attach_metadata", """
SELECT l_orderkey AS scene_no, l_linenumber AS job, s.pathNumber, s.frameNumber, s.day FROM lineitem
JOIN v_scenes s ON s.scene_no = l_orderkey""", ("v_scenes",))
def _(t: Tables):
    jobs = t.table("lineitem").select(F.col("l_orderkey").alias("scene_no"), F.col("l_linenumber").alias("job"))
    return ops.attach_metadata(jobs, t.view("v_scenes").select("scene_no", "pathNumber", "frameNumber", "day"), "scene_no")


@query("pair_polarizations", "WITH " + _PARTS + """
SELECT h, v, MAX(tile_file) FILTER (WHERE layer = 'VV') AS co_path, MAX(tile_file) FILTER (WHERE layer = 'VH') AS cross_path
FROM tiles_found GROUP BY h, v HAVING COUNT(DISTINCT layer) FILTER (WHERE layer IN ('VV', 'VH')) = 2""", ("v_scenes",))
def _(t: Tables):
    return ops.pair_polarizations(_files(t).withColumnsRenamed({"layer": "pol", "name": "path"}))


@query("burst_summary", """
WITH c AS (SELECT LEFT(scene_name, 25) AS burst_id, pathNumber, COUNT(*) AS n FROM v_scenes GROUP BY ALL),
 r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY burst_id ORDER BY n DESC, pathNumber) AS k,
  SUM(n) OVER (PARTITION BY burst_id) AS total FROM c)
SELECT burst_id, CAST(total AS BIGINT) AS "count", pathNumber FROM r WHERE k = 1""", ("v_scenes",))
def _(t: Tables):
    return ops.burst_summary(t.view("v_scenes"), 25, "scene_name")


@query("burst_count_classes", """
WITH c AS (SELECT pathNumber, frameNumber, COUNT(*) AS "count" FROM v_scenes GROUP BY ALL)
SELECT "count", COUNT(*) AS bursts FROM c GROUP BY ALL""", ("v_scenes",))
def _(t: Tables):
    return ops.burst_count_classes(t.view("v_scenes").groupBy("pathNumber", "frameNumber").count())


@query("counts_with_attrs", """
SELECT burst, COUNT(*) AS "count", MIN(kind) AS kind, MIN(acq) AS acq FROM v_products GROUP BY burst""", ("v_products",))
def _(t: Tables):
    return ops.counts_with_attrs(t.view("v_products"), "burst", ["kind", "acq"])


@query("latest_processing", """
SELECT burst, acq, proc, kind, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY burst, acq ORDER BY proc DESC) AS k
FROM v_products) WHERE k = 1""", ("v_products",))
def _(t: Tables):
    return ops.latest_processing(t.view("v_products"), ["burst", "acq"], "proc").orderBy("burst", "acq")


@query("products_by_frame", """
SELECT concat(pathNumber, '_', frameNumber) AS frame_id,
concat('/data/', pathNumber, '_', frameNumber, '/', filename) AS product FROM v_scenes
WHERE concat(pathNumber, '_', frameNumber) IN ('0_0', '3_15', '11_29', '7_7')""", ("v_scenes",))
def _(t: Tables):
    return ops.products_by_frame(t.view("v_scenes"), "/data", ["0_0", "3_15", "11_29", "7_7"])


@query("product_lists", """
SELECT concat(pathNumber, '_', frameNumber) AS frame_id, concat('/data/', pathNumber, '_', frameNumber, '/', filename) AS product,
COUNT(*) OVER (PARTITION BY pathNumber, frameNumber) AS n_products FROM v_scenes""", ("v_scenes",))
def _(t: Tables):
    return ops.product_lists(t.view("v_scenes"), "/data")


@query("granules_of_frames", """
SELECT scene_no, pathNumber, frameNumber FROM v_scenes WHERE (pathNumber, frameNumber) IN
(SELECT pathNumber, frameNumber FROM v_scenes GROUP BY ALL HAVING COUNT(*) >= 250)""", ("v_scenes",))
def _(t: Tables):
    scenes = t.view("v_scenes").select("scene_no", "pathNumber", "frameNumber")
    return ops.granules_of_frames(scenes, ops.count_by_frame(scenes).where("num_granules >= 250"))


@query("tiles_in_use", "SELECT COUNT(*) FILTER (WHERE mask <> 0) AS n_active, COUNT(*) AS n_tiles FROM v_mask", ("v_mask",))
def _(t: Tables):
    return ops.tiles_in_use(t.view("v_mask"))
