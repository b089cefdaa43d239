"""Queries: composites, masks, stacks, neighbourhoods, grids and points on rasters."""

from pyspark.sql import functions as F

from groundloom.functions import indices, names
from groundloom.functions.frames import row_apply, scene_map
from groundloom.operators import composites as comp
from groundloom.operators import grids
from groundloom.operators import neighborhood as near
from groundloom.operators.grids import Grid
from groundloom.plans import jobs
from groundloom.queries.base import Tables, query, rounded
from groundloom.scale import attach

PX = ["pr", "pc"]
BANDS = indices.STACK_BANDS
SRC = Grid(0.0, 0.0, 30.0)
COARSE = Grid(-10.0, 20.0, 70.0)
FINE = Grid(5.0, -7.0, 12.0)
TILE = 1024


# ---- temporal statistics -------------------------------------------------------------------

@query("temporal_mean_nz", """
SELECT frame, pr, pc, ROUND(COALESCE(AVG(NULLIF(vh, 0)), 0), 8) AS mean FROM v_obs GROUP BY ALL""", ("v_obs",))
def _(t: Tables):
    df = comp.temporal_mean_nz(t.view("v_obs"), ["frame", *PX], "vh")
    return df.withColumn("mean", rounded("mean", 8))


@query("temporal_var_nz", """
SELECT pr, pc, ROUND(VAR_POP(NULLIF(vh, 0)), 10) AS variance FROM v_obs GROUP BY ALL""", ("v_obs",))
def _(t: Tables):
    df = comp.temporal_var_nz(t.view("v_obs"), PX, "vh")
    return df.withColumn("variance", rounded("variance", 10))


@query("temporal_mean_skipna", """
WITH n AS (SELECT burst FROM v_products GROUP BY burst HAVING COUNT(DISTINCT acq) >= 28)
SELECT burst, kind, ROUND(AVG(CASE WHEN value < 1.0 THEN NULL ELSE value END), 8) AS value
FROM v_products WHERE burst IN (SELECT burst FROM n) GROUP BY ALL""", ("v_products",))
def _(t: Tables):
    df = t.view("v_products").withColumn("value", F.when(F.col("value") < 1.0, float("nan")).otherwise(F.col("value")))
    means = comp.temporal_mean_skipna(df, ["burst", "kind"], min_scenes=28)
    return means.withColumn("value", rounded("value", 8))


@query("mean_composite", """
SELECT frame, pr, pc, ROUND(AVG(vv), 9) AS value FROM v_obs GROUP BY ALL""", ("v_obs",))
def _(t: Tables):
    df = comp.composite(t.view("v_obs"), ["frame", *PX], "mean", "vv")
    return df.withColumn("value", rounded("value", 9))


@query("median_composite", "SELECT pr, pc, ROUND(MEDIAN(vv), 9) AS value FROM v_obs GROUP BY ALL", ("v_obs",))
def _(t: Tables):
    return comp.composite(t.view("v_obs"), PX, "median", "vv").withColumn("value", rounded("value", 9))


@query("first_composite", """
SELECT pr, pc, vv AS value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pr, pc ORDER BY acq, vv) AS k FROM v_obs)
WHERE k = 1""", ("v_obs",))
def _(t: Tables):
    return comp.composite(t.view("v_obs"), PX, "first", "vv")


@query("frame_temporal_job", """
SELECT frame, pr, pc, ROUND(COALESCE(AVG(NULLIF(vv, 0)), 0), 9) AS vv, ROUND(COALESCE(AVG(NULLIF(vh, 0)), 0), 9) AS vh,
ROUND(COALESCE(AVG(NULLIF(inc, 0)), 0), 9) AS inc FROM v_obs GROUP BY ALL""", ("v_obs",))
def _(t: Tables):
    df = comp.frame_temporal_job(t.view("v_obs"), ["vv", "vh", "inc"])
    return df.withColumns({c: rounded(c, 9) for c in ("vv", "vh", "inc")})


@query("vegetation_map", """
WITH m AS (SELECT frame, pr, pc, COALESCE(AVG(NULLIF(vv, 0)), 0) AS vv, COALESCE(AVG(NULLIF(vh, 0)), 0) AS vh
 FROM v_obs GROUP BY ALL), i AS (SELECT *, CASE WHEN vv + vh <> 0 THEN 4.0 * vh / (vv + vh) END AS rvi FROM m)
SELECT frame, pr, pc, ROUND(vv, 9) AS vv, ROUND(vh, 9) AS vh, ROUND(rvi, 9) AS rvi,
ROUND(1 / (1 + EXP(-(-1.5 + 0.8 * rvi))), 9) AS probability FROM i""", ("v_obs",))
def _(t: Tables):
    df = jobs.vegetation_map(t.view("v_obs"), "vv", "vh", -1.5, 0.8)
    return df.withColumns({c: rounded(c, 9) for c in ("vv", "vh", "rvi", "probability")})


# ---- masks and stacks ----------------------------------------------------------------------

@query("apply_mask", """
SELECT p.pr, p.pc, CASE WHEN m.mask <> 0 THEN p.value END AS value,
ROUND(CASE WHEN m.mask <> 0 THEN p.value * 90 / PI() END, 8) AS inc
FROM v_px p LEFT JOIN (SELECT pr + 1 AS pr, pc, CASE WHEN status <> 'P' THEN mask END AS mask FROM v_mask) m
ON p.pr = m.pr AND p.pc = m.pc""", ("v_px", "v_mask"))
def _(t: Tables):
    px = t.view("v_px").withColumn("inc", F.col("value") / 2)
    # the mask lies one row lower, so that some pixels have none
    mask = t.view("v_mask").selectExpr("pr + 1 AS pr", "pc", "CASE WHEN status <> 'P' THEN mask END AS mask")
    out = comp.apply_mask(px, mask, ["value", "inc"], PX, "inc")
    return out.select(*PX, "value", rounded("inc", 8).alias("inc"))


@query("union_mask", """
SELECT p.pr, p.pc, CASE WHEN p.value IS NOT NULL OR COALESCE(m.mask, 0) <> 0 THEN 1 ELSE 0 END AS mask
FROM v_px p LEFT JOIN (SELECT pr, pc, CASE WHEN status = 'F' THEN mask ELSE 0 END AS mask FROM v_mask) m
ON p.pr = m.pr AND p.pc = m.pc""", ("v_px", "v_mask"))
def _(t: Tables):
    a = t.view("v_px").select(*PX, F.col("value").isNotNull().cast("int").alias("mask"))
    return comp.union_mask(a, t.view("v_mask").selectExpr("pr", "pc", "CASE WHEN status = 'F' THEN mask ELSE 0 END AS mask"))


_LAYERS = " UNION ALL ".join(f"SELECT CAST(FLOOR(pc / 5.0) AS INT) AS h, CAST(FLOOR(pr / 5.0) AS INT) AS v, pr % 5 AS pr, "
                             f"pc % 5 AS pc, '{b}' AS band, {b} AS value FROM v_stack" for b in BANDS)


def _layers(t: Tables):
    cells = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("value")) for b in BANDS])
    flat = t.view("v_stack").select(*PX, F.explode(cells).alias("_c")).select(*PX, "_c.*")
    return flat


@query("stack_bands", "SELECT CAST(FLOOR(pc / 5.0) AS INT) AS h, CAST(FLOOR(pr / 5.0) AS INT) AS v, pr % 5 AS pr, pc % 5 AS pc, "
       + ", ".join(BANDS) + " FROM v_stack", ("v_stack",))
def _(t: Tables):
    return comp.stack_bands(grids.to_tiles(_layers(t), 5), BANDS)


@query("missing_bands", """
SELECT pr, 'R' AS missing_band FROM v_obs GROUP BY pr HAVING COUNT(*) FILTER (WHERE frame = 'R' AND quantity > 49) = 0
UNION ALL SELECT pr, 'A' FROM v_obs GROUP BY pr HAVING COUNT(*) FILTER (WHERE frame = 'A') = 0""", ("v_obs",))
def _(t: Tables):
    layers = t.view("v_obs").select("pr", F.when((F.col("frame") == "R") & (F.col("quantity") <= 49), "x")
                                    .otherwise(F.col("frame")).alias("band"))
    return comp.missing_bands(layers, ["R", "A"], ["pr"])


_GRID_STACK = ", ".join(f"CAST(COALESCE(MAX(CASE WHEN band = '{b}' THEN value END), -9999) AS FLOAT) AS {b}" for b in BANDS)


@query("build_stack", f"""
WITH src AS ({' UNION ALL '.join(f"SELECT pr, pc, '{b}' AS band, {b} AS value FROM v_stack" for b in BANDS)}),
 r AS (SELECT band, CAST(FLOOR((pr * 30 + 15) / 30) AS INT) AS pr, pc, value FROM src),
 fine AS (SELECT s.band, s.value, CAST(a.i AS INT) AS r, CAST(b.j AS INT) AS c FROM src s
  JOIN (SELECT i, CAST(FLOOR((i + 0.5) * 15 / 30) AS INT) AS pr FROM generate_series(0, 5000) g(i)) a ON a.pr = s.pr
  JOIN (SELECT j, CAST(FLOOR((j + 0.5) * 15 / 30) AS INT) AS pc FROM generate_series(0, 49) g(j)) b ON b.pc = s.pc),
 tiled AS (SELECT band, value, CAST(FLOOR(c / 10.0) AS INT) AS h, CAST(FLOOR(r / 10.0) AS INT) AS v, r % 10 AS pr, c % 10 AS pc
  FROM fine)
SELECT h, v, pr, pc, {_GRID_STACK} FROM tiled WHERE (h + v) % 3 <> 0 GROUP BY h, v, pr, pc""", ("v_stack",))
def _(t: Tables):
    layers = _layers(t)
    tiles = layers.select((F.floor(F.col("pc") / 5.0)).cast("int").alias("h"),
                          (F.floor(F.col("pr") / 5.0)).cast("int").alias("v")).distinct()
    tiles = tiles.withColumn("mask", F.when((F.col("h") + F.col("v")) % 3 != 0, 1).otherwise(0))
    return grids.build_stack(layers, SRC, Grid(0.0, 0.0, 15.0), 10, tiles, BANDS)


_RVI100 = "CAST(COALESCE(ROUND_EVEN(CASE WHEN {co} + {x} <> 0 THEN 4.0 * {x} / ({co} + {x}) END * 100, 0), -9999) AS SMALLINT)"


@query("condensed_stack", f"""
SELECT pr, pc, {_RVI100.format(co='c_vv', x='c_vh')} AS c_rvi_x100, {_RVI100.format(co='l_hh', x='l_hv')} AS l_rvi_x100,
CAST(COALESCE(ROUND_EVEN(ndvi * 100, 0), -9999) AS SMALLINT) AS ndvi_x100, CAST(TRUNC(tc) AS SMALLINT) AS tc FROM v_stack""",
       ("v_stack",))
def _(t: Tables):
    return comp.condensed_stack(t.view("v_stack"), PX)


_Z = " + ".join([repr(indices.BAND_MODEL_INTERCEPT)] + [f"({w!r}) * {b}" for w, b in
                zip(indices.BAND_MODEL_WEIGHTS, [*BANDS, "(4 * l_hv / (l_hh + l_hv))", "(4 * c_vh / (c_vv + c_vh))"])])


@query("classify_stack", f"SELECT pr, pc, ROUND(1 / (1 + EXP(-({_Z}))), 9) AS probability FROM v_stack", ("v_stack",))
def _(t: Tables):
    df = comp.classify_stack(t.view("v_stack"), indices.band_model_score(), PX)
    return df.withColumn("probability", rounded("probability", 9))


@query("pixel_function", "SELECT pr, pc, ROUND(SQRT(c_vv * c_vh) + ndvi, 9) AS value FROM v_stack", ("v_stack",))
def _(t: Tables):
    df = comp.pixel_function(t.view("v_stack"), lambda a, b, n: F.sqrt(a * b) + n, ["c_vv", "c_vh", "ndvi"])
    return df.select(*PX, rounded("value", 9).alias("value"))


@query("scene_map", "SELECT scene, line, ROUND(vv - AVG(vv) OVER (PARTITION BY acq), 9) AS value FROM v_obs", ("v_obs",))
def _(t: Tables):
    # a date has ever more pixels as the table grows, a tile of a date has not
    tile = [F.floor(F.col("pr") / TILE).alias("v"), F.floor(F.col("pc") / TILE).alias("h")]
    px = t.view("v_obs").select("scene", "line", "vv", "acq", *tile)
    px = attach(px, px.groupBy("acq").agg(F.avg("vv").alias("mean")), ["acq"])
    out = scene_map(px, lambda p: p.assign(value=p.vv - p["mean"])[["scene", "line", "value"]],
                    "scene bigint, line int, value double", ["acq", "v", "h"])
    return out.withColumn("value", rounded("value", 9))


@query("row_apply", "SELECT scene, line, vv > vh AS brighter, ROUND(ABS(vv - vh), 9) AS gap FROM v_obs", ("v_obs",))
def _(t: Tables):
    px = t.view("v_obs").select("scene", "line", "vv", "vh")

    def both(p):
        return p.assign(brighter=p.vv > p.vh, gap=(p.vv - p.vh).abs())[["brighter", "gap"]]

    out = row_apply(px, both, "brighter boolean, gap double")
    return out.select("scene", "line", "brighter", rounded("gap", 9).alias("gap"))


@query("mosaic", """
SELECT pr, pc, vv AS value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pr, pc ORDER BY scene DESC, line DESC, vv DESC) AS k FROM v_obs
WHERE vh <> 0) WHERE k = 1""", ("v_obs",))
def _(t: Tables):
    px = t.view("v_obs").select(*PX, F.when(F.col("vh") != 0, F.col("vv")).alias("value"),
                                F.struct("scene", "line", "vv").alias("priority"))
    return comp.mosaic(px, PX, "priority")


@query("fill_gaps_prior_year", """
WITH y AS (SELECT pr, pc, CAST(YEAR(acq) AS INT) AS year, AVG(vv) AS value FROM v_obs WHERE vh > 0.05 GROUP BY ALL)
SELECT pr, pc, ROUND(arg_max(value, year), 9) AS value FROM y GROUP BY pr, pc""", ("v_obs",))
def _(t: Tables):
    yearly = (t.view("v_obs").withColumn("year", F.year("acq")).groupBy(*PX, "year")
              .agg(F.avg(F.when(F.col("vh") > 0.05, F.col("vv"))).alias("value")))
    done = comp.fill_gaps_prior_year(yearly, PX)
    return done.where("value is not null").withColumn("value", rounded("value", 9))


@query("same_grid_check", """
SELECT COUNT(*) AS n_grids, COUNT(*) = 1 AS same_grid FROM (SELECT DISTINCT frame, l_linestatus FROM v_obs, lineitem
WHERE scene = l_orderkey AND line = l_linenumber)""", ("v_obs",))
def _(t: Tables):
    layers = t.table("lineitem").select("l_returnflag", "l_linestatus")
    return comp.same_grid_check(layers, ["l_returnflag", "l_linestatus"])


# ---- neighbourhoods ------------------------------------------------------------------------

DENSE = """d AS (SELECT g.pr, g.pc, p.value FROM (SELECT CAST(a.i AS INT) AS pr, CAST(b.j AS INT) AS pc FROM
 generate_series(0, (SELECT MAX(pr) FROM v_px)) a(i), generate_series(0, (SELECT MAX(pc) FROM v_px)) b(j)) g
 LEFT JOIN v_px p ON g.pr = p.pr AND g.pc = p.pc)"""
_BOX = """b AS (SELECT a.pr, a.pc, ANY_VALUE(a.value) AS value, COALESCE(SUM(n.value), 0) AS s, COALESCE(SUM(n.value * n.value), 0) AS q,
 COUNT(n.value) AS n FROM d a JOIN d n ON n.pr BETWEEN a.pr - 2 AND a.pr + 2 AND n.pc BETWEEN a.pc - 2 AND a.pc + 2
 GROUP BY a.pr, a.pc)"""


def _dense(t: Tables):
    return near.densify(t.view("v_px"))


@query("densify", f"WITH {DENSE} SELECT pr, pc, value FROM d", ("v_px",))
def _(t: Tables):
    return _dense(t)


@query("box_filter", f"""
WITH {DENSE}, {_BOX} SELECT pr, pc, ROUND(s, 9) AS box_sum, ROUND(q, 6) AS box_sum_sq, n AS box_count FROM b""", ("v_px",))
def _(t: Tables):
    df = near.box_filter(_dense(t), 5)
    return df.select(*PX, rounded("box_sum", 9).alias("box_sum"), rounded("box_sum_sq", 6).alias("box_sum_sq"), "box_count")


@query("enhanced_lee", f"""
WITH {DENSE}, {_BOX}, m AS (SELECT *, s / n AS mu, q / n AS sq FROM b WHERE n > 0),
 c AS (SELECT *, CASE WHEN ABS(sq - mu * mu) > 1e-8 + 1e-5 * mu * mu THEN SQRT(sq - mu * mu) ELSE 0 END / mu AS ci FROM m),
 w AS (SELECT *, CASE WHEN ci <= 0.523 THEN 1 WHEN ci < SQRT(3) THEN EXP(-(ci - 0.523) / (SQRT(3) - ci)) ELSE 0 END AS w FROM c)
SELECT pr, pc, ROUND(mu * w + COALESCE(value, 0) * (1 - w), 8) AS filtered FROM w""", ("v_px",))
def _(t: Tables):
    return near.enhanced_lee(_dense(t)).select(*PX, rounded("filtered", 8).alias("filtered"))


_SIDES = """s AS (SELECT a.pr, a.pc, a.mask, COALESCE(l.mask, 1) AS "left", COALESCE(r.mask, 1) AS "right", COALESCE(u.mask, 1) AS up,
 COALESCE(b.mask, 1) AS down FROM v_mask a LEFT JOIN v_mask l ON l.pr = a.pr AND l.pc = a.pc - 1
 LEFT JOIN v_mask r ON r.pr = a.pr AND r.pc = a.pc + 1 LEFT JOIN v_mask u ON u.pr = a.pr - 1 AND u.pc = a.pc
 LEFT JOIN v_mask b ON b.pr = a.pr + 1 AND b.pc = a.pc)"""


def _mask(t: Tables):
    return t.view("v_mask").select(*PX, "mask")


@query("neighbor_lookup", f'WITH {_SIDES} SELECT pr, pc, mask, "left", "right", up, down FROM s', ("v_mask",))
def _(t: Tables):
    return near.neighbor_lookup(_mask(t))


@query("inner_edges", f"""WITH {_SIDES} SELECT pr, pc FROM s WHERE mask = 1 AND LEAST("left", "right", up, down) = 0""", ("v_mask",))
def _(t: Tables):
    return near.inner_edges(_mask(t))


@query("peel_edges", """
SELECT a.pr, a.pc, CASE WHEN EXISTS (SELECT 1 FROM v_mask z WHERE z.mask = 0 AND z.pr BETWEEN a.pr - 2 AND a.pr + 2
 AND z.pc BETWEEN a.pc - 2 AND a.pc + 2 AND ABS(z.pr - a.pr) + ABS(z.pc - a.pc) <= 2) THEN NULL ELSE a.pr + a.pc END * 1.0E0 AS value
FROM v_mask a""", ("v_mask",))
def _(t: Tables):
    px = _mask(t).withColumn("value", (F.col("pr") + F.col("pc")).cast("double"))
    return near.peel_edges(px, 2).select(*PX, "value")


_EDGES = _SIDES + """, e AS (SELECT pr, pc FROM s WHERE mask = 1 AND LEAST("left", "right", up, down) = 0),
 x AS (SELECT MIN(pr) AS top, MAX(pr) AS bottom, MIN(pc) AS lft, MAX(pc) AS rgt FROM e),
 t AS (SELECT top, bottom, lft, rgt, (SELECT MIN(pc) FROM e WHERE pr = top) AS top0, (SELECT MAX(pc) FROM e WHERE pr = top) AS top1,
  (SELECT MIN(pc) FROM e WHERE pr = bottom) AS bot0, (SELECT MAX(pc) FROM e WHERE pr = bottom) AS bot1,
  (SELECT MIN(pr) FROM e WHERE pc = lft) AS lft0, (SELECT MAX(pr) FROM e WHERE pc = lft) AS lft1,
  (SELECT MIN(pr) FROM e WHERE pc = rgt) AS rgt0, (SELECT MAX(pr) FROM e WHERE pc = rgt) AS rgt1 FROM x),
 k AS (SELECT CASE WHEN lft0 > rgt0 THEN top ELSE lft0 END AS row_ul, CASE WHEN lft0 > rgt0 THEN top0 ELSE lft END AS col_ul,
  CASE WHEN lft0 > rgt0 THEN rgt0 ELSE top END AS row_ur, CASE WHEN lft0 > rgt0 THEN rgt ELSE top1 END AS col_ur,
  CASE WHEN lft0 > rgt0 THEN bottom ELSE rgt1 END AS row_lr, CASE WHEN lft0 > rgt0 THEN bot1 ELSE rgt END AS col_lr,
  CASE WHEN lft0 > rgt0 THEN lft1 ELSE bottom END AS row_ll, CASE WHEN lft0 > rgt0 THEN lft ELSE bot0 END AS col_ll FROM t)"""


@query("corner_pixels", f"WITH {_EDGES} SELECT row_ul, col_ul, row_ur, col_ur, row_lr, col_lr, row_ll, col_ll FROM k", ("v_mask",))
def _(t: Tables):
    return near.corner_pixels(near.inner_edges(_mask(t)), [])


@query("side_edges", f"""WITH {_EDGES}
SELECT pr, pc, CASE WHEN (pr, pc) IN ((row_ul, col_ul), (row_ur, col_ur), (row_lr, col_lr), (row_ll, col_ll)) THEN 2 ELSE 1 END AS side
FROM e, k WHERE (pr, pc) IN ((row_ul, col_ul), (row_ur, col_ur), (row_lr, col_lr), (row_ll, col_ll))
OR (pr > LEAST(row_ur, row_lr) AND pr < GREATEST(row_ur, row_lr) AND pc BETWEEN LEAST(col_ur, col_lr) AND GREATEST(col_ur, col_lr))
OR (pr > LEAST(row_ul, row_ll) AND pr < GREATEST(row_ul, row_ll) AND pc BETWEEN LEAST(col_ul, col_ll) AND GREATEST(col_ul, col_ll))""",
       ("v_mask",))
def _(t: Tables):
    return near.side_edges(_mask(t))


def _peel_sql(k: int, mask: str) -> str:
    """One step of side peeling on the table ``mask``; tables of step k end in k."""
    return f"""z{k} AS MATERIALIZED (SELECT a.pr, a.pc FROM {mask} a WHERE mask = 1 AND EXISTS (SELECT 1 FROM {mask} n WHERE n.mask = 0
  AND ((n.pr = a.pr AND n.pc = a.pc + 1) OR (n.pr = a.pr AND n.pc = a.pc - 1) OR (n.pr = a.pr + 1 AND n.pc = a.pc)
  OR (n.pr = a.pr - 1 AND n.pc = a.pc)))),
 x{k} AS (SELECT MIN(pr) AS top, MAX(pr) AS bottom, MIN(pc) AS lft, MAX(pc) AS rgt FROM z{k}),
 t{k} AS (SELECT top, bottom, lft, rgt, (SELECT MIN(pc) FROM z{k} WHERE pr = top) AS top0, (SELECT MAX(pc) FROM z{k} WHERE pr = top) AS top1,
  (SELECT MIN(pc) FROM z{k} WHERE pr = bottom) AS bot0, (SELECT MAX(pc) FROM z{k} WHERE pr = bottom) AS bot1,
  (SELECT MIN(pr) FROM z{k} WHERE pc = lft) AS lft0, (SELECT MAX(pr) FROM z{k} WHERE pc = lft) AS lft1,
  (SELECT MIN(pr) FROM z{k} WHERE pc = rgt) AS rgt0, (SELECT MAX(pr) FROM z{k} WHERE pc = rgt) AS rgt1 FROM x{k}),
 k{k} AS (SELECT CASE WHEN lft0 > rgt0 THEN top ELSE lft0 END AS row_ul, CASE WHEN lft0 > rgt0 THEN top0 ELSE lft END AS col_ul,
  CASE WHEN lft0 > rgt0 THEN rgt0 ELSE top END AS row_ur, CASE WHEN lft0 > rgt0 THEN rgt ELSE top1 END AS col_ur,
  CASE WHEN lft0 > rgt0 THEN bottom ELSE rgt1 END AS row_lr, CASE WHEN lft0 > rgt0 THEN bot1 ELSE rgt END AS col_lr,
  CASE WHEN lft0 > rgt0 THEN lft1 ELSE bottom END AS row_ll, CASE WHEN lft0 > rgt0 THEN lft ELSE bot0 END AS col_ll FROM t{k}),
 g{k} AS MATERIALIZED (SELECT pr, pc, CASE WHEN (pr, pc) IN ((row_ul, col_ul), (row_ur, col_ur), (row_lr, col_lr), (row_ll, col_ll)) THEN 2 ELSE 1 END
  AS side FROM z{k}, k{k} WHERE (pr, pc) IN ((row_ul, col_ul), (row_ur, col_ur), (row_lr, col_lr), (row_ll, col_ll))
  OR (pr > LEAST(row_ur, row_lr) AND pr < GREATEST(row_ur, row_lr) AND pc BETWEEN LEAST(col_ur, col_lr) AND GREATEST(col_ur, col_lr))
  OR (pr > LEAST(row_ul, row_ll) AND pr < GREATEST(row_ul, row_ll) AND pc BETWEEN LEAST(col_ul, col_ll) AND GREATEST(col_ul, col_ll))),
 m{k} AS MATERIALIZED (SELECT a.pr, a.pc, CASE WHEN g.side IS NULL THEN a.mask ELSE 0 END AS mask FROM {mask} a LEFT JOIN g{k} g
  ON a.pr = g.pr AND a.pc = g.pc)"""


@query("peel_sides", f"""WITH m0 AS MATERIALIZED (SELECT pr, pc, mask FROM v_mask), {_peel_sql(1, 'm0')}, {_peel_sql(2, 'm1')}, {_peel_sql(3, 'm2')}
SELECT pr, pc, side FROM g1 UNION ALL SELECT pr, pc, side FROM g2 UNION ALL SELECT pr, pc, side FROM g3""", ("v_mask",))
def _(t: Tables):
    return near.peel_sides(_mask(t), 3)


@query("remove_edges", f"""WITH {DENSE}, m0 AS MATERIALIZED (SELECT pr, pc, CASE WHEN value IS NULL THEN 0 ELSE 1 END AS mask FROM d),
 {_peel_sql(1, 'm0')}, {_peel_sql(2, 'm1')}
SELECT d.pr, d.pc, CASE WHEN m2.mask = 1 THEN d.value END AS vv, CASE WHEN m2.mask = 1 THEN d.value / 3 END AS vh
FROM d JOIN m2 ON d.pr = m2.pr AND d.pc = m2.pc""", ("v_px",))
def _(t: Tables):
    px = _dense(t).select(F.lit(1).alias("frame"), *PX, F.col("value").alias("vv"), (F.col("value") / 3).alias("vh"))
    return near.remove_edges(px, ["vv", "vh"], 2, "vv").drop("frame", "mask")


# ---- grids ---------------------------------------------------------------------------------

_AXES = """ax AS (SELECT CAST(i AS INT) AS tr, {y0} - (i + 0.5) * {res} AS ty FROM generate_series(0, {nr}) g(i)),
 ay AS (SELECT CAST(j AS INT) AS tc, {x0} + (j + 0.5) * {res} AS tx FROM generate_series(0, {nc}) g(j))"""


@query("resample_nearest", "WITH " + _AXES.format(y0=-7, x0=5, res=12, nr=40000, nc=400) + """
SELECT tr AS pr, tc AS pc, value FROM ax JOIN v_px p ON p.pr = CAST(FLOOR(-ty / 30) AS INT)
JOIN ay ON p.pc = CAST(FLOOR(tx / 30) AS INT)""", ("v_px",))
def _(t: Tables):
    return grids.resample(t.view("v_px"), SRC, FINE, "nearest")


@query("resample_average", """
WITH sp AS (SELECT *, pr * 30.0 AS a, pr * 30.0 + 30 AS b, pc * 30.0 AS l, pc * 30.0 + 30 AS r FROM v_px WHERE value IS NOT NULL),
 ax AS (SELECT CAST(i AS INT) AS tr, i * 70.0 - 20 AS ta FROM generate_series(0, 20000) g(i)),
 ay AS (SELECT CAST(j AS INT) AS tc, j * 70.0 - 10 AS tl FROM generate_series(0, 60) g(j)),
 k AS (SELECT tr, tc, value, (LEAST(b, ta + 70) - GREATEST(a, ta)) * (LEAST(r, tl + 70) - GREATEST(l, tl)) AS w FROM sp
  JOIN ax ON a < ta + 70 AND b > ta JOIN ay ON l < tl + 70 AND r > tl)
SELECT tr AS pr, tc AS pc, ROUND(CAST(SUM(w * value) / SUM(w) AS DOUBLE), 8) AS value FROM k GROUP BY ALL""", ("v_px",))
def _(t: Tables):
    out = grids.resample(t.view("v_px"), SRC, COARSE, "average")
    return out.withColumn("value", rounded("value", 8))


@query("resample_bilinear", "WITH " + _AXES.format(y0=20, x0=-10, res=70, nr=20000, nc=60) + """,
 k AS (SELECT tr, tc, value, (1 - ABS(-ty / 30 - 0.5 - pr)) * (1 - ABS(tx / 30 - 0.5 - pc)) AS w FROM ax
  JOIN (SELECT * FROM v_px WHERE value IS NOT NULL) p ON p.pr BETWEEN CAST(FLOOR(-ty / 30 - 0.5) AS INT) AND CAST(FLOOR(-ty / 30 - 0.5) AS INT) + 1
  JOIN ay ON p.pc BETWEEN CAST(FLOOR(tx / 30 - 0.5) AS INT) AND CAST(FLOOR(tx / 30 - 0.5) AS INT) + 1)
SELECT tr AS pr, tc AS pc, ROUND(SUM(w * value) / SUM(w), 8) AS value FROM k WHERE w > 1e-9 GROUP BY ALL""", ("v_px",))
def _(t: Tables):
    out = grids.resample(t.view("v_px"), SRC, COARSE, "bilinear")
    return out.withColumn("value", rounded("value", 8))


@query("resample_aligned", """
SELECT pr + 1 AS pr, pc AS pc, value FROM v_px""", ("v_px",))
def _(t: Tables):
    # corner (0, 15) moves out to (0, 30); pixel centres fall on the next row
    return grids.resample(t.view("v_px"), SRC, Grid(14.0, 15.0, 30.0).aligned(), "nearest")


@query("clip_to_box", "SELECT pr, pc, value FROM v_px WHERE pc * 30 + 15 BETWEEN 300 AND 2500 AND -(pr * 30 + 15) BETWEEN -3000 AND -400",
       ("v_px",))
def _(t: Tables):
    return grids.clip_to_box(t.view("v_px"), SRC, (300.0, -3000.0, 2500.0, -400.0))


@query("to_tiles", """SELECT pr % 32 AS pr, pc % 32 AS pc, value, CAST(FLOOR(pc / 32.0) AS INT) AS h, CAST(FLOOR(pr / 32.0) AS INT) AS v
FROM v_px""", ("v_px",))
def _(t: Tables):
    return grids.to_tiles(t.view("v_px"), 32)


@query("pixel_dims", """SELECT id, CAST(TRUNC((xmax - xmin) / 30) AS INT) AS xdim, CAST(TRUNC((ymax - ymin) / 30) AS INT) AS ydim
FROM v_foot""", ("v_foot",))
def _(t: Tables):
    return grids.pixel_dims(t.view("v_foot"), 30.0).select("id", "xdim", "ydim")


# ---- points --------------------------------------------------------------------------------

POINT_GRID = Grid(0.0, 0.0, 1.0)


@query("sample_at_points", """
SELECT g.pid, p.value FROM v_gpoints g LEFT JOIN v_px p ON p.pr = CAST(FLOOR(-g.y) AS INT) AND p.pc = CAST(FLOOR(g.x) AS INT)""",
       ("v_gpoints", "v_px"))
def _(t: Tables):
    return grids.sample_at_points(t.view("v_gpoints"), t.view("v_px"), POINT_GRID, ["value"], x="x", y="y").select("pid", "value")


@query("window_at_points", """
WITH o AS (SELECT pid, -y - 1 AS ro, x - 1 AS co FROM v_gpoints),
 k AS (SELECT pid, CAST(TRUNC(ro) AS INT) AS r, CAST(TRUNC(co) AS INT) AS c FROM o WHERE ro >= 0 AND co >= 0
  AND ro + 3 <= (SELECT MAX(pr) + 1 FROM v_px) AND co + 3 <= 120),
 m AS (SELECT pid, AVG(value) AS value FROM k JOIN v_px p ON p.pr BETWEEN r AND r + 2 AND p.pc BETWEEN c AND c + 2 GROUP BY pid)
SELECT g.pid, ROUND(m.value, 8) AS value FROM v_gpoints g LEFT JOIN m ON g.pid = m.pid""", ("v_gpoints", "v_px"))
def _(t: Tables):
    px = t.view("v_px")
    n_rows = px.agg(F.max("pr")).first()[0] + 1
    out = grids.window_at_points(t.view("v_gpoints"), px, Grid(0.0, 0.0, 1.0, n_rows, 120), ["value"], x="x", y="y")
    return out.select("pid", rounded("value", 8).alias("value"))


@query("zonal_mean", """
SELECT m.status AS zone, ROUND(AVG(value), 8) AS value FROM v_px p JOIN v_mask m ON p.pr = m.pr AND p.pc = m.pc GROUP BY ALL""",
       ("v_px", "v_mask"))
def _(t: Tables):
    zones = t.view("v_mask").withColumnRenamed("status", "zone")
    out = grids.zonal_mean(t.view("v_px"), zones, ["value"])
    return out.withColumn("value", rounded("value", 8))


@query("bounds", """
SELECT MIN(lon) AS xmin, MIN(lat) AS ymin, MAX(lon) AS xmax, MAX(lat) AS ymax, ROUND(AVG(lon), 9) AS xmean,
ROUND(AVG(lat), 9) AS ymean FROM v_points""", ("v_points",))
def _(t: Tables):
    out = grids.bounds(t.view("v_points"))
    return out.withColumns({c: rounded(c, 9) for c in ("xmean", "ymean")})


@query("summary_stats", """
SELECT 'x1' AS col_name, COUNT(x1) AS "count", ROUND(AVG(x1), 6) AS mean, ROUND(STDDEV_SAMP(x1), 6) AS stddev, MIN(x1) AS "min",
ROUND(QUANTILE_CONT(x1, 0.25), 6) AS q25, ROUND(QUANTILE_CONT(x1, 0.5), 6) AS q50, ROUND(QUANTILE_CONT(x1, 0.75), 6) AS q75,
MAX(x1) AS "max" FROM v_points UNION ALL
SELECT 'lat', COUNT(lat), ROUND(AVG(lat), 6), ROUND(STDDEV_SAMP(lat), 6), MIN(lat), ROUND(QUANTILE_CONT(lat, 0.25), 6),
ROUND(QUANTILE_CONT(lat, 0.5), 6), ROUND(QUANTILE_CONT(lat, 0.75), 6), MAX(lat) FROM v_points""", ("v_points",))
def _(t: Tables):
    out = comp.summary_stats(t.view("v_points"), ["x1", "lat"])
    return out.withColumns({c: rounded(c) for c in ("mean", "stddev", "q25", "q50", "q75")})


_TILED = """t AS (SELECT *, CAST(FLOOR(pr / 25.0) AS INT) AS tile FROM d)"""


def _lee_sql(pol: str, factor: int) -> str:
    """Speckle filter of one polarization, each tile alone, from the dense grid."""
    return f"""{pol}0 AS (SELECT tile, pr, pc, value * {factor} * value * {factor} * POW(10, -8.3) AS g FROM t),
 {pol}1 AS (SELECT a.tile, a.pr, a.pc, ANY_VALUE(a.g) AS g, SUM(n.g) / COUNT(n.g) AS mu, SUM(n.g * n.g) / COUNT(n.g) AS sq FROM {pol}0 a
  JOIN {pol}0 n ON n.tile = a.tile AND n.pr BETWEEN a.pr - 2 AND a.pr + 2 AND n.pc BETWEEN a.pc - 2 AND a.pc + 2 GROUP BY a.tile, a.pr, a.pc),
 {pol}2 AS (SELECT *, CASE WHEN ABS(sq - mu * mu) > 1e-8 + 1e-5 * mu * mu THEN SQRT(sq - mu * mu) ELSE 0 END / mu AS ci FROM {pol}1),
 {pol} AS (SELECT tile, pr, pc, CASE WHEN ci <= 0.523 THEN mu WHEN ci < SQRT(3) THEN mu * EXP(-(ci - 0.523) / (SQRT(3) - ci))
  + COALESCE(g, 0) * (1 - EXP(-(ci - 0.523) / (SQRT(3) - ci))) ELSE COALESCE(g, 0) END AS v FROM {pol}2)"""


@query("alos_mosaic_job", f"""WITH {DENSE}, {_TILED}, {_lee_sql('hh', 5000)}, {_lee_sql('hv', 2000)}
SELECT hh.tile, hh.pr, hh.pc, ROUND(hh.v, 7) AS hh, ROUND(hv.v, 7) AS hv, ROUND(hh.pc / 3.0E0, 6) AS inc,
CAST(hh.pr % 365 + date_diff('day', DATE '2019-01-01', DATE '2014-05-24') + 1 AS SMALLINT) AS doy
FROM hh JOIN hv ON hh.pr = hv.pr AND hh.pc = hv.pc""", ("v_px",))
def _(t: Tables):
    dn = _dense(t).select(F.floor(F.col("pr") / 25.0).cast("int").alias("tile"), *PX,
                          (F.col("value") * 5000).alias("hh"), (F.col("value") * 2000).alias("hv"),
                          (F.col("pc") / 3.0).cast("double").alias("inc"), (F.col("pr") % 365).alias("days"))
    out = jobs.alos_mosaic_job(dn, 2019)
    return out.withColumns({"hh": rounded("hh", 7), "hv": rounded("hv", 7), "inc": rounded("inc", 6)})


@query("mosaic_named_tiles", "SELECT pr, pc, ROUND(COALESCE(value, 0.5), 9) AS value FROM v_px", ("v_px",))
def _(t: Tables):
    # two years of tiles; the earlier one fills the gaps of the later one
    px, corner = t.view("v_px"), [5 - F.floor(F.col("pr") / 30.0), F.floor(F.col("pc") / 30.0) - 2]
    years = px.select(names.geo_tile_name(*corner).alias("tile"), (F.col("pr") % 30).alias("pr"), (F.col("pc") % 30).alias("pc"),
                      F.explode(F.array(F.struct(F.lit(2019).alias("year"), F.col("value")),
                                        F.struct(F.lit(2018).alias("year"), (F.coalesce("value", F.lit(1.0)) / 2).alias("value"))))
                      .alias("y")).select("tile", "pr", "pc", "y.*")
    return jobs.mosaic_named_tiles(years, 30, ["value"], "year").withColumn("value", rounded("value", 9))


@query("burst_tiles", f"""
WITH l AS (SELECT frame, acq, pr, pc, vv, vh FROM (SELECT *, RANK() OVER (PARTITION BY frame, acq ORDER BY line DESC) AS k
  FROM v_obs) WHERE k = 1),
 m AS (SELECT frame, pr, pc, AVG(vv) AS vv, AVG(vh) AS vh FROM l GROUP BY ALL),
 {_AXES.format(y0=-7, x0=5, res=12, nr=40000, nc=400)},
 w AS (SELECT frame, tr, tc, vv, vh FROM ax JOIN m p ON p.pr = CAST(FLOOR(-ty / 30) AS INT) JOIN ay ON p.pc = CAST(FLOOR(tx / 30) AS INT)),
 z AS (SELECT tr, tc, arg_max(vv, frame) AS vv, arg_max(vh, frame) AS vh FROM w GROUP BY ALL)
SELECT CAST(FLOOR(tc / 64.0) AS INT) AS h, CAST(FLOOR(tr / 64.0) AS INT) AS v, tr % 64 AS pr, tc % 64 AS pc, ROUND(vv, 9) AS vv,
ROUND(vh, 9) AS vh, ROUND(CASE WHEN vv + vh <> 0 THEN 4.0 * vh / (vv + vh) END, 9) AS rvi FROM z""", ("v_obs",))
def _(t: Tables):
    scenes = t.view("v_obs").select(F.col("frame").alias("burst"), "acq", F.col("line").alias("proc"), *PX, "vv", "vh")
    out = jobs.burst_tiles(scenes, SRC, FINE, 64)
    return out.withColumns({c: rounded(c, 9) for c in ("vv", "vh", "rvi")})


@query("resample_reprojected")
def _(t: Tables):
    """The orders raster, laid out in zone 18 north, on tiles of zone 17 around its corner."""
    from groundloom.functions.geodesy import reproject
    tiles = t.view("v_foot").select(F.lit(0).alias("h"), F.col("id").cast("int").alias("v"), F.lit(-78.02).alias("x"),
                                    (F.lit(4.0) - F.col("id") * 0.003).alias("y"))
    tiles = reproject(tiles, "x", "y", 4326, 32617).select(
        "h", "v", F.col("x").alias("xmin"), (F.col("x") + 3000).alias("xmax"), (F.col("y") - 600).alias("ymin"), F.col("y").alias("ymax"))
    src = Grid(164000.0, 442900.0, 30.0)
    return grids.resample_reprojected(t.view("v_px"), src, 32618, tiles, 60.0, 32617)
