"""Queries: strata, sample sizes, samples and splits."""

from pyspark.sql import functions as F

from groundloom.operators import strata as ops
from groundloom.plans import jobs
from groundloom.queries.base import Tables, query, rounded

ABSENCE, PRESENCE = [0, 1, 2, 3, 4], [5, 6, 7]
Z95 = repr(ops.z_score(0.95))
_BIN = """b0 AS (SELECT CASE WHEN cat <= 4 THEN 0 ELSE 1 END AS cat, COUNT(*) AS pixel_ct FROM v_stack WHERE cat <= 7 GROUP BY ALL),
 b AS (SELECT cat, pixel_ct, ROUND_EVEN(pixel_ct * 100 / SUM(pixel_ct) OVER (), 3) AS pct_area FROM b0)"""


def _binary(t: Tables):
    return ops.consolidate(ops.class_histogram(t.view("v_stack")), ABSENCE, PRESENCE).select("cat", "pixel_ct", "pct_area")


@query("class_histogram", "SELECT cat, COUNT(*) AS pixel_ct FROM v_stack GROUP BY cat", ("v_stack",))
def _(t: Tables):
    return ops.class_histogram(t.view("v_stack"))


@query("histogram_summary", """
SELECT COUNT(*) AS total_area, MIN(cat) AS category_min, MAX(cat) AS category_max, COUNT(DISTINCT cat) AS n_categories
FROM v_stack""", ("v_stack",))
def _(t: Tables):
    return ops.histogram_summary(ops.class_histogram(t.view("v_stack")))


@query("consolidate", f"""WITH {_BIN} SELECT cat, pixel_ct, pct_area, CASE WHEN cat = 0 THEN 'Absence' ELSE 'Presence' END AS class_name,
CASE WHEN cat = 0 THEN '0,1,2,3,4' ELSE '5,6,7' END AS source_classes FROM b""", ("v_stack",))
def _(t: Tables):
    return ops.consolidate(ops.class_histogram(t.view("v_stack")), ABSENCE, PRESENCE)


@query("size_manual", f"WITH {_BIN} SELECT cat, pixel_ct, pct_area, CASE WHEN cat = 0 THEN 120 ELSE 80 END AS nh_adjusted FROM b",
       ("v_stack",))
def _(t: Tables):
    return ops.size_manual(_binary(t), {0: 120, 1: 80})


@query("size_required", f"""WITH {_BIN} SELECT cat, pixel_ct, pct_area,
CAST(ROUND_EVEN(CASE WHEN cat = 0 THEN 100 / 0.8 ELSE 75 / 0.6 END, 0) AS INT) AS nh_adjusted FROM b""", ("v_stack",))
def _(t: Tables):
    return ops.size_required(_binary(t), {0: 100.0, 1: 75.0}, {0: 0.8, 1: 0.6})


@query("size_stehman_foody", f"""WITH {_BIN}, p AS (SELECT *, CASE WHEN cat = 0 THEN 0.9 ELSE 0.7 END * 1.0E0 AS p FROM b)
SELECT cat, pixel_ct, pct_area, p, CAST(TRUNC({Z95} * {Z95} * p * (1 - p) / (0.05 * 0.05)) AS INT) AS nh,
GREATEST(CAST(TRUNC({Z95} * {Z95} * p * (1 - p) / (0.05 * 0.05)) AS INT), 200) AS nh_adjusted FROM p""", ("v_stack",))
def _(t: Tables):
    return ops.size_stehman_foody(_binary(t), 0.05, 0.95, 200, {0: 0.9, 1: 0.7})


@query("size_olofsson", f"""WITH {_BIN}, q AS (SELECT *, CASE WHEN cat = 0 THEN 0.9 ELSE 0.7 END * 1.0E0 AS qh, pct_area / 100 AS wh FROM b),
 s AS (SELECT *, SQRT(qh * (1 - qh)) AS sd FROM q), n AS (SELECT POW(SUM(sd * wh) /
 (0.15 * (MAX(CASE WHEN cat = 1 THEN pct_area END) / 100 / {Z95})), 2) AS n FROM s)
SELECT cat, pixel_ct, pct_area, qh, ROUND(wh, 9) AS wh, ROUND(sd, 9) AS SDh, ROUND(sd * wh, 9) AS SDh_x_wh,
CAST(TRUNC(wh * n) AS INT) AS nh, GREATEST(CAST(TRUNC(wh * n) AS INT), 40) AS nh_adjusted FROM s, n""", ("v_stack",))
def _(t: Tables):
    out = ops.size_olofsson(_binary(t), 0.15, 0.95, 40, 1, {0: 0.9, 1: 0.7})
    return out.withColumns({c: rounded(c, 9) for c in ("wh", "SDh", "SDh_x_wh")})


@query("scale_for_training", f"""WITH {_BIN} SELECT cat, pixel_ct, pct_area,
CAST(TRUNC(CASE WHEN cat = 0 THEN 37 ELSE 23 END / 0.3) AS INT) AS nh_adjusted FROM b""", ("v_stack",))
def _(t: Tables):
    return ops.scale_for_training(ops.size_manual(_binary(t), {0: 37, 1: 23}), 0.3)


_WEIGHTS = {"absence": {0: 0.5, 2: 0.5}, "presence": {5: 0.25, 6: 0.75}}


def _distributed(t: Tables):
    binary = ops.size_manual(_binary(t), {0: 51, 1: 33})
    return ops.distribute_sample(binary, ops.class_histogram(t.view("v_stack")), _WEIGHTS["absence"], _WEIGHTS["presence"])


_DIST = """d AS (SELECT cat, COUNT(*) AS pixel_ct, CAST(TRUNC(CASE cat WHEN 0 THEN 51 * 0.5 WHEN 2 THEN 51 * 0.5 WHEN 5 THEN 33 * 0.25
 ELSE 33 * 0.75 END) AS INT) AS nh_final FROM v_stack WHERE cat IN (0, 2, 5, 6) GROUP BY cat)"""


@query("distribute_sample", f"WITH {_DIST} SELECT cat, pixel_ct, nh_final FROM d", ("v_stack",))
def _(t: Tables):
    return _distributed(t)


@query("fill_categories", f"""WITH {_DIST} SELECT CAST(i AS INT) AS cat, CAST(d.pixel_ct AS DOUBLE) AS pixel_ct,
COALESCE(d.nh_final, 0) AS nh_final FROM generate_series(0, 6) g(i) LEFT JOIN d ON d.cat = i""", ("v_stack",))
def _(t: Tables):
    return ops.fill_categories(_distributed(t)).withColumn("pixel_ct", F.col("pixel_ct").cast("double"))


_HASH = "md5(concat_ws(':', '{seed}', {cols}))"


@query("stratified_sample", f"""
SELECT pixel, cat FROM (SELECT pixel, cat, ROW_NUMBER() OVER (PARTITION BY cat ORDER BY {_HASH.format(seed=9999, cols='pixel')}, pixel)
AS k FROM v_stack) WHERE k <= CASE WHEN cat IN (1, 3) THEN 1000 WHEN cat < 5 THEN 7 ELSE 12 END""", ("v_stack",))
def _(t: Tables):
    px = t.view("v_stack").select("pixel", "cat")
    wanted = F.when(F.col("cat").isin(1, 3), 1000).when(F.col("cat") < 5, 7).otherwise(12)
    return ops.stratified_sample(px, px.select("cat").distinct().withColumn("nh_final", wanted), 9999, ["pixel"])


@query("shuffle_and_number", f"""
SELECT pid, lon, lat, ROW_NUMBER() OVER (ORDER BY {_HASH.format(seed=7, cols='pid')}, pid) - 1 AS PLOTID FROM v_points""", ("v_points",))
def _(t: Tables):
    return ops.shuffle_and_number(t.view("v_points").select("pid", "lon", "lat"), 7, ["pid"])


@query("train_val_test_split", f"""
WITH r AS (SELECT scene_no, ROW_NUMBER() OVER (ORDER BY {_HASH.format(seed=999, cols='scene_no')}, scene_no) - 1 AS k,
 COUNT(*) OVER () AS n FROM v_scenes)
SELECT scene_no, CASE WHEN k < FLOOR(n * 0.6) THEN 'train' WHEN k < FLOOR(n * 0.6) + FLOOR(n * 0.15) THEN 'validate'
ELSE 'map_reference/test' END AS usage FROM r""", ("v_scenes",))
def _(t: Tables):
    return ops.train_val_test_split(t.view("v_scenes").select("scene_no"), (0.6, 0.15, 0.25), 999, ["scene_no"])


@query("split_counts", """
SELECT CASE WHEN level < '3' THEN 'train' ELSE 'test' END AS usage, COUNT(*) AS n FROM v_scenes GROUP BY ALL""", ("v_scenes",))
def _(t: Tables):
    return ops.split_counts(t.view("v_scenes").withColumn("usage", F.when(F.col("level") < "3", "train").otherwise("test")))


@query("sample_design", f"""
WITH s AS (SELECT CAST(TRUNC({Z95} * {Z95} * 0.8 * 0.2 / 0.01) AS INT) AS nh),
 c AS (SELECT pixel, cat, ROW_NUMBER() OVER (PARTITION BY cat ORDER BY {_HASH.format(seed=9999, cols='pixel')}, pixel) AS k,
  CAST(TRUNC(CAST(TRUNC(GREATEST(nh, 30) / 0.5) AS INT) * CASE cat WHEN 0 THEN 0.5 WHEN 2 THEN 0.5 WHEN 5 THEN 0.25 ELSE 0.75 END) AS INT) AS want
  FROM v_stack, s WHERE cat IN (0, 2, 5, 6))
SELECT pixel, cat, ROW_NUMBER() OVER (ORDER BY {_HASH.format(seed=9999, cols='pixel')}, pixel) AS PLOTID FROM c WHERE k <= want""",
       ("v_stack",))
def _(t: Tables):
    return jobs.sample_design(t.view("v_stack").select("pixel", "cat"), _WEIGHTS["absence"], _WEIGHTS["presence"],
                              0.1, 0.95, 30, 0.8, 0.5, 9999, ["pixel"])
