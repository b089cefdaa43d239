"""Queries: column choice, filters, set operations, scalar functions."""

from pyspark.sql import functions as F

from groundloom.functions import calendar, cells, geodesy, indices, names
from groundloom.operators import tables as ops
from groundloom.queries.base import Tables, query, rounded

BOX = (200.0, 300.0, 500.0, 900.0)


@query("subset_cols", "SELECT pid, lon, lat FROM v_points", ("v_points",))
def _(t: Tables):
    return ops.subset_cols(t.view("v_points"), ["pid", "lon", "lat"])


@query("rename_cols", "SELECT plotid AS Point_ID, center_lat AS Lat, center_lon AS Lon FROM v_survey", ("v_survey",))
def _(t: Tables):
    df = t.view("v_survey").select("plotid", "center_lat", "center_lon")
    return ops.rename_cols(df, {"plotid": "Point_ID", "center_lat": "Lat", "center_lon": "Lon"})


@query("normalise_names", 'SELECT pr AS "id-pr", c_vv AS "S1-vv", l_hh AS "ALOS2-hh", ndvi AS "LS8-ndvi", tc AS "MODIS-tc" '
       "FROM v_stack", ("v_stack",))
def _(t: Tables):
    df = t.view("v_stack").select("pr", "c_vv", "l_hh", "ndvi", "tc").toDF(
        "id.pr", "properties.0_vv", "properties.1_hh", "properties.2_ndvi", "properties.3_tc")
    return ops.normalise_names(df)


@query("pick_columns", "SELECT plotid AS Point_ID, pl_cluster AS Clust FROM v_survey", ("v_survey",))
def _(t: Tables):
    df = t.view("v_survey").select("plotid", "pl_cluster")
    found = ops.pick_columns(df, {"Point_ID": ["plot_id", "plotid"], "Clust": ["pl_strata_cat", "pl_cluster"]})
    return ops.rename_cols(df, found)


@query("cast_catalog", """
SELECT scene_no, pathNumber, frameNumber, CAST(day AS DATE) AS start_day FROM v_scenes WHERE level = '1-URGENT'""",
       ("v_scenes",))
def _(t: Tables):
    raw = t.view("v_scenes").select("scene_no", F.col("level").alias("processingLevel"),
                                    F.col("pathNumber").cast("string"), F.col("frameNumber").cast("string"),
                                    F.date_format("startTime", "yyyy-MM-dd'T'HH:mm:ss").alias("startTime"))
    done = ops.cast_catalog(raw, "1-URGENT")
    return done.select("scene_no", "pathNumber", "frameNumber", F.col("startTime").cast("date").alias("start_day"))


@query("filter_products", """
SELECT scene_no, platform FROM v_scenes WHERE platform LIKE 'S1A%'
AND startTime > TIMESTAMP '1996-01-01 00:00:00' AND startTime < TIMESTAMP '1997-01-01 00:00:00'""", ("v_scenes",))
def _(t: Tables):
    df = ops.filter_products(t.view("v_scenes"), "S1A", "1996-01-01", "1997-01-01", "platform")
    return df.select("scene_no", "platform")


@query("filter_months", f"""
SELECT scene_no, filename FROM v_scenes
WHERE regexp_matches(filename, '{names.PRODUCT_PATTERNS["rtc_zip"]}') AND MONTH(startTime) BETWEEN 5 AND 9""",
       ("v_scenes",))
def _(t: Tables):
    df = ops.filter_months(t.view("v_scenes"), names.PRODUCT_PATTERNS["rtc_zip"], 5, 9)
    return df.select("scene_no", "filename")


@query("filter_scene_meta", f"""
SELECT scene_no, flightDirection, xmin, ymin FROM v_scenes
WHERE flightDirection = 'DESCENDING' AND platform = 'S1B' AND startTime >= TIMESTAMP '1996-03-01 00:00:00'
AND startTime < TIMESTAMP '1999-03-01 00:00:00'
AND NOT (xmin > {BOX[2]} OR xmax < {BOX[0]} OR ymin > {BOX[3]} OR ymax < {BOX[1]})""", ("v_scenes",))
def _(t: Tables):
    df = ops.filter_scene_meta(t.view("v_scenes"), {"flightDirection": "DESCENDING", "platform": "S1B"},
                               "1996-03-01", "1999-03-01", box=BOX)
    return df.select("scene_no", "flightDirection", "xmin", "ymin")


@query("qa_mask", """
SELECT scene, line, qa, CASE WHEN (qa >> 3) % 2 = 0 AND (qa >> 5) % 2 = 0 THEN vv END AS vv,
CASE WHEN (qa >> 3) % 2 = 0 AND (qa >> 5) % 2 = 0 THEN vh END AS vh FROM v_obs""", ("v_obs",))
def _(t: Tables):
    return ops.qa_mask(t.view("v_obs"), "qa", ["vv", "vh"]).select("scene", "line", "qa", "vv", "vh")


@query("active_tiles", "SELECT pr, pc, mask FROM v_mask WHERE mask <> 0", ("v_mask",))
def _(t: Tables):
    return ops.active_tiles(t.view("v_mask")).select("pr", "pc", "mask")


@query("filter_prefix", """
SELECT scene_no, scene_name FROM v_scenes WHERE scene_name LIKE 'OPERA_L2_RTC-S1_T042%'""", ("v_scenes",))
def _(t: Tables):
    return ops.filter_prefix(t.view("v_scenes").select("scene_no", "scene_name"), "scene_name", "OPERA_L2_RTC-S1_T042")


@query("drop_incomplete", "SELECT pid, x1 FROM v_points WHERE x1 IS NOT NULL", ("v_points",))
def _(t: Tables):
    return ops.drop_incomplete(t.view("v_points").select("pid", "x1"))


@query("invalid_values", """
SELECT DISTINCT col_name, value FROM (
 SELECT 'presence' AS col_name, presence + unsure AS value FROM v_survey
 UNION ALL SELECT 'unsure', unsure FROM v_survey) WHERE value NOT IN (0, 100)""", ("v_survey",))
def _(t: Tables):
    df = t.view("v_survey").withColumn("presence", F.col("presence") + F.col("unsure"))
    return ops.invalid_values(df, ["presence", "unsure"])


# ---- set operations ------------------------------------------------------------------------

@query("union_beams", "SELECT file_no, shot, elev1 FROM v_shots", ("v_shots",))
def _(t: Tables):
    shots = t.view("v_shots")
    beams = [shots.where(c).select("file_no", "shot", "elev1") for c in ("sensitivity >= 0.95", "sensitivity < 0.95")]
    return ops.union_beams(*beams)


@query("upsert_products", """
SELECT pathNumber, frameNumber, day FROM v_scenes WHERE day < DATE '1998-01-01'
UNION SELECT pathNumber, frameNumber, day FROM v_scenes WHERE day >= DATE '1997-01-01'""", ("v_scenes",))
def _(t: Tables):
    df = t.view("v_scenes").select("pathNumber", "frameNumber", "day")
    old, new = df.where("day < DATE '1998-01-01'"), df.where("day >= DATE '1997-01-01'")
    return ops.upsert_products(old, new, ["pathNumber", "frameNumber", "day"])


@query("insert_absent", """
SELECT pid, 'old' AS origin FROM v_points WHERE cls <> 'MACHINERY'
UNION ALL SELECT pid, 'new' FROM v_points WHERE cls = 'MACHINERY'""", ("v_points",))
def _(t: Tables):
    df = t.view("v_points")
    old = df.where("cls <> 'MACHINERY'").select("pid", F.lit("old").alias("origin"))
    return ops.insert_absent(old, df.select("pid", F.lit("new").alias("origin")), "pid")


@query("distinct_tiles", r"""
SELECT DISTINCT regexp_extract(tile_file, 'h\d+_v\d+') AS tile_id FROM v_scenes
WHERE regexp_matches(tile_file, 'h\d+_v\d+')""", ("v_scenes",))
def _(t: Tables):
    return ops.distinct_tiles(t.view("v_scenes"), "tile_file")


@query("key_intersection", """
SELECT DISTINCT a.pr, a.pc FROM v_obs a JOIN v_obs b ON a.pr = b.pr AND a.pc = b.pc
WHERE (a.quantity > 45) AND NOT (b.quantity > 45)""", ("v_obs",))
def _(t: Tables):
    df = t.view("v_obs")                             # every row is on one of the two sides
    return ops.key_intersection(df.where("quantity > 45"), df.where("NOT (quantity > 45)"), ["pr", "pc"])


@query("remainder", "SELECT pid, cls FROM v_points WHERE cls <> 'BUILDING'", ("v_points",))
def _(t: Tables):
    df = t.view("v_points").select("pid", "cls")
    return ops.remainder(df, df.where("cls = 'BUILDING'"), "pid")


@query("compare_tables", """
WITH a AS (SELECT plotid, center_lon AS lon, center_lat AS lat FROM v_survey),
b AS (SELECT plotid, center_lon + CASE WHEN plotid % 5 = 0 THEN 0.001 ELSE 0 END AS lon, center_lat + 1e-10 AS lat
      FROM v_survey)
SELECT a.plotid, ROUND_EVEN(a.lon, 5) AS first_lon, ROUND_EVEN(a.lat, 5) AS first_lat, ROUND_EVEN(b.lon, 5) AS second_lon,
ROUND_EVEN(b.lat, 5) AS second_lat FROM a JOIN b ON a.plotid = b.plotid
WHERE ROUND_EVEN(a.lon, 5) <> ROUND_EVEN(b.lon, 5) OR ROUND_EVEN(a.lat, 5) <> ROUND_EVEN(b.lat, 5)""", ("v_survey",))
def _(t: Tables):
    a = t.view("v_survey").select("plotid", F.col("center_lon").alias("lon"), F.col("center_lat").alias("lat"))
    b = a.withColumns({"lon": F.col("lon") + F.when(F.col("plotid") % 5 == 0, 0.001).otherwise(0.0),
                       "lat": F.col("lat") + 1e-10})
    return ops.compare_tables(a, b, ["lon", "lat"], "plotid", 5)


# ---- scalar functions ----------------------------------------------------------------------

@query("rvi", "SELECT pixel, ROUND(CASE WHEN c_vv + c_vh <> 0 THEN 4.0 * c_vh / (c_vv + c_vh) END, 9) AS rvi FROM v_stack",
       ("v_stack",))
def _(t: Tables):
    return t.view("v_stack").select("pixel", rounded(indices.rvi("c_vv", "c_vh"), 9).alias("rvi"))


@query("ndvi", """
SELECT scene, line, ROUND(CASE WHEN vh >= 0 AND inc >= 0 AND vh + inc <> 0 THEN (vh - inc) / (vh + inc) END, 9) AS ndvi
FROM v_obs""", ("v_obs",))
def _(t: Tables):
    return t.view("v_obs").select("scene", "line", rounded(indices.ndvi("vh", "inc"), 9).alias("ndvi"))


@query("condense", """
SELECT scene, line, CAST(COALESCE(ROUND_EVEN(NULLIF(vh, 0) * 100, 0), -9999) AS SMALLINT) AS vh_x100 FROM v_obs""",
       ("v_obs",))
def _(t: Tables):
    return t.view("v_obs").select("scene", "line", indices.condense(F.nullif(F.col("vh"), F.lit(0.0))).alias("vh_x100"))


@query("dn_to_gamma0", "SELECT scene, line, ROUND(quantity * quantity * POW(10, -8.3), 15) AS gamma0 FROM v_obs", ("v_obs",))
def _(t: Tables):
    return t.view("v_obs").select("scene", "line", rounded(indices.dn_to_gamma0("quantity"), 15).alias("gamma0"))


@query("incidence_degrees", "SELECT scene, line, ROUND(inc * 180 / PI(), 8) AS inc_deg FROM v_obs", ("v_obs",))
def _(t: Tables):
    return t.view("v_obs").select("scene", "line", rounded(indices.incidence_degrees("inc"), 8).alias("inc_deg"))


@query("day_of_year", """
SELECT scene, line, CAST(qa + date_diff('day', DATE '2019-01-01', DATE '2014-05-24') + 1 AS SMALLINT) AS doy_2019,
CAST(qa + date_diff('day', DATE '2009-01-01', DATE '2006-01-24') + 1 AS SMALLINT) AS doy_2009 FROM v_obs""", ("v_obs",))
def _(t: Tables):
    return t.view("v_obs").select("scene", "line", calendar.day_of_year("qa", 2019).alias("doy_2019"),
                                  calendar.day_of_year("qa", 2009).alias("doy_2009"))


@query("epoch_seconds", """
SELECT scene, line, TIMESTAMP '2018-01-01 00:00:00' + to_microseconds(CAST(ROUND(vv * 1e12, 0) AS BIGINT)) AS shot_time
FROM v_obs""", ("v_obs",))
def _(t: Tables):
    seconds = F.round(F.col("vv") * 1e12, 0).cast("decimal(30,0)") / F.lit(1000000)
    return t.view("v_obs").select("scene", "line", calendar.epoch_seconds(seconds).alias("shot_time"))


_Z = " + ".join([repr(indices.BAND_MODEL_INTERCEPT)] + [f"({w!r}) * {b}" for w, b in
                zip(indices.BAND_MODEL_WEIGHTS, [*indices.STACK_BANDS, "(4 * l_hv / (l_hh + l_hv))",
                                                 "(4 * c_vh / (c_vv + c_vh))"])])


@query("logit_score", f"SELECT pixel, ROUND(1 / (1 + EXP(-({_Z}))), 9) AS probability FROM v_stack", ("v_stack",))
def _(t: Tables):
    return t.view("v_stack").select("pixel", rounded(indices.band_model_score(), 9).alias("probability"))


_ANY_ZERO = " OR ".join(f"{b} = 0" for b in indices.STACK_BANDS)


@query("logit_score_byte", f"""
SELECT pixel, CAST(CASE WHEN {_ANY_ZERO} THEN 255 WHEN 100 / (1 + EXP(-({_Z}))) = 0 THEN 255
ELSE TRUNC(100 / (1 + EXP(-({_Z})))) END AS SMALLINT) AS pct FROM v_stack""", ("v_stack",))
def _(t: Tables):
    return t.view("v_stack").select("pixel", indices.logit_score_byte().alias("pct"))


@query("threshold_class", "SELECT scene, line, CASE WHEN vv >= 0.05 THEN 1 ELSE 0 END AS presence FROM v_obs", ("v_obs",))
def _(t: Tables):
    return t.view("v_obs").select("scene", "line", indices.threshold_class("vv", 0.05).alias("presence"))


@query("parse_times", r"""
SELECT scene_no, strptime(regexp_extract(scene_name, '_(\d{8}T\d{6})Z_\d{8}T', 1), '%Y%m%dT%H%M%S') AS acquired,
strptime(regexp_extract(scene_name, 'Z_(\d{8}T\d{6})Z_S1', 1), '%Y%m%dT%H%M%S') AS processed FROM v_scenes""",
       ("v_scenes",))
def _(t: Tables):
    return t.view("v_scenes").select("scene_no", names.acquisition_time("scene_name").alias("acquired"),
                                     names.processing_time("scene_name").alias("processed"))


@query("parse_tile_id", r"""
SELECT scene_no, regexp_extract(tile_file, 'h\d+_v\d+') AS tile_id,
CAST(regexp_extract(tile_file, 'h(\d+)_v', 1) AS INT) AS h, CAST(regexp_extract(tile_file, '_v(\d+)_', 1) AS INT) AS v
FROM v_scenes""", ("v_scenes",))
def _(t: Tables):
    return t.view("v_scenes").select("scene_no", names.tile_id("tile_file").alias("tile_id"),
                                     names.tile_part("tile_file", "h").alias("h"),
                                     names.tile_part("tile_file", "v").alias("v"))


@query("product_pattern", f"""
SELECT scene_no, regexp_matches(filename, '{names.PRODUCT_PATTERNS["rtc_zip"]}') AS is_rtc,
regexp_matches(tile_file, '{names.PRODUCT_PATTERNS["rtc_zip"]}') AS tile_is_rtc FROM v_scenes""", ("v_scenes",))
def _(t: Tables):
    return t.view("v_scenes").select("scene_no", names.matches_product("filename", "rtc_zip").alias("is_rtc"),
                                     names.matches_product("tile_file", "rtc_zip").alias("tile_is_rtc"))


@query("geo_tile_name", """
WITH c AS (SELECT pid, CAST(CEIL(lat) AS INT) AS la, CAST(FLOOR(lon) AS INT) AS lo FROM v_points),
g AS (SELECT *, CAST(CASE WHEN la >= 0 THEN CEIL(la / 5.0) ELSE FLOOR(ABS(la) / 5.0) END * 5 AS INT) AS la5,
      CAST(CASE WHEN lo >= 0 THEN FLOOR(lo / 5.0) ELSE CEIL(ABS(lo) / 5.0) END * 5 AS INT) AS lo5 FROM c)
SELECT pid, printf('%s%02d%s%03d', CASE WHEN la >= 0 THEN 'N' ELSE 'S' END, ABS(la), CASE WHEN lo >= 0 THEN 'E' ELSE 'W' END,
 ABS(lo)) AS tile,
printf('%s%02d%s%03d', CASE WHEN la >= 0 OR la5 = 0 THEN 'N' ELSE 'S' END, la5, CASE WHEN lo >= 0 OR lo5 = 0 THEN 'E' ELSE 'W' END,
 lo5) AS parent FROM g""", ("v_points",))
def _(t: Tables):
    tile = t.view("v_points").select("pid", names.geo_tile_name(F.ceil("lat"), F.floor("lon")).alias("tile"))
    return tile.withColumn("parent", names.parent_grid_name("tile"))


@query("output_name", """
SELECT scene_no, concat('s1_tile_site_a_b_h', pathNumber, '_v', frameNumber, '_VV.tif') AS tile_name,
concat(pathNumber, '_', frameNumber, '/VV_mean.tif') AS mean_name FROM v_scenes""", ("v_scenes",))
def _(t: Tables):
    tile = names.output_name("tile", site=F.lit("site"), start=F.lit("a"), end=F.lit("b"), h="pathNumber",
                             v="frameNumber", pol=F.lit("VV"))
    mean = names.output_name("frame_mean", frame=names.frame_id("pathNumber", "frameNumber"), layer=F.lit("VV"))
    return t.view("v_scenes").select("scene_no", tile.alias("tile_name"), mean.alias("mean_name"))


@query("utm_zone", """
SELECT pid, CAST(FLOOR((lon + 180) / 6) % 60 + 1 AS INT) AS zone,
CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + FLOOR((lon + 180) / 6) % 60 + 1 AS INT) AS epsg FROM v_points""",
       ("v_points",))
def _(t: Tables):
    return t.view("v_points").select("pid", geodesy.utm_zone("lon").alias("zone"),
                                     geodesy.utm_epsg("lat", "lon").alias("epsg"))


@query("recode", """
SELECT plotid, CASE WHEN presence >= absence AND presence >= unsure THEN 1 WHEN absence >= unsure THEN 0 ELSE 2 END AS code
FROM v_survey""", ("v_survey",))
def _(t: Tables):
    code = cells.recode(["presence", "absence", "unsure"], {"presence": 1, "absence": 0, "unsure": 2})
    return t.view("v_survey").select("plotid", code.alias("code"))


@query("check_exclusive", """
SELECT plotid, CAST(CASE WHEN presence + absence + unsure = 100 THEN presence END AS DOUBLE) AS presence,
CAST(CASE WHEN presence + absence + unsure = 100 THEN absence END AS DOUBLE) AS absence,
CAST(CASE WHEN presence + absence + unsure = 100 THEN unsure END AS DOUBLE) AS unsure FROM v_survey""", ("v_survey",))
def _(t: Tables):
    checked = cells.check_exclusive(["presence", "absence", "unsure"])
    return t.view("v_survey").select("plotid", *[c.cast("double").alias(n) for n, c in checked.items()])


@query("round_floats", "SELECT plotid, ROUND_EVEN(center_lat, 5) AS center_lat, ROUND_EVEN(center_lon, 5) AS center_lon "
       "FROM v_survey", ("v_survey",))
def _(t: Tables):
    return cells.round_floats(t.view("v_survey").select("plotid", "center_lat", "center_lon"), 5)


@query("fill_sentinel", "SELECT doc_id, labeler, COALESCE(vote, -99) AS vote FROM v_votes", ("v_votes",))
def _(t: Tables):
    return t.view("v_votes").select("doc_id", "labeler", cells.fill_sentinel("vote").alias("vote"))


@query("true_label", "SELECT pid, CASE WHEN cls = 'BUILDING' THEN 1 ELSE 0 END AS true_label FROM v_points", ("v_points",))
def _(t: Tables):
    return t.view("v_points").select("pid", cells.true_label("cls", "BUILDING").alias("true_label"))


@query("join_list", "SELECT scene, line, concat(scene, ',', line, ',', frame) AS parts FROM v_obs", ("v_obs",))
def _(t: Tables):
    items = F.array(F.col("scene").cast("string"), F.col("line").cast("string"), F.col("frame"))
    text = t.view("v_obs").select("scene", "line", names.join_list(items).alias("parts"))
    return text.withColumn("parts", names.join_list(names.split_list("parts")))
