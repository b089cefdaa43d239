"""Queries: lidar shots."""

from pyspark.sql import functions as F

from groundloom.functions.cells import robust_range
from groundloom.operators import shots as ops
from groundloom.queries.base import Tables, query, rounded

_STATS = """q AS (SELECT * FROM v_shots WHERE sensitivity >= 0.9),
 l AS (SELECT file_no, UNNEST([elev1, elev2, elev3, elev4, elev5, elev6]) AS e FROM q),
 st AS (SELECT file_no, AVG(e) AS mean, STDDEV_SAMP(e) AS sd FROM l GROUP BY file_no),
 r AS (SELECT q.*, mean, sd, list_filter([elev1, elev2, elev3, elev4, elev5, elev6], lambda x: x <= mean + 2 * sd AND x >= mean - 2 * sd)
  AS ok FROM q JOIN st ON q.file_no = st.file_no),
 g AS (SELECT *, COALESCE(list_max(ok) - list_min(ok), 99) AS elev_range FROM r)"""


def _stats_then_range(t: Tables):
    sharp = ops.shot_quality(t.view("v_shots"))
    joined = ops.attach(sharp, ops.pooled_elev_stats(sharp, ["file_no"]), ["file_no"])
    return joined.withColumn("elev_range", robust_range(ops.ELEVATIONS, "elev_mean", "elev_sd"))


_SHOT = """SELECT l_orderkey AS file_no, l_linenumber AS line, concat('BEAM', l_suppkey % 8) AS beam, {k} AS shot, {elev} AS elev1,
TIMESTAMP '2018-01-01 00:00:00' + to_microseconds((CAST(l_extendedprice * 100 AS BIGINT) + {k}) * 10000) AS date,
{rh} FROM lineitem {where}"""


@query("flatten_shots", _SHOT.format(k=1, elev="l_quantity", rh="l_tax AS rh0, l_discount AS rh1, l_quantity AS rh2", where="")
       + " UNION ALL " + _SHOT.format(k=2, elev="l_tax", rh="l_discount AS rh0, l_tax AS rh1, l_quantity AS rh2",
                                      where="WHERE l_returnflag <> 'R'"))
def _(t: Tables):
    # one short beam per line, its second shot incomplete for returned lines, and a group that is no beam
    item = t.table("lineitem")
    beams = item.select(
        F.col("l_orderkey").alias("file_no"), F.col("l_linenumber").alias("line"),
        F.explode(F.array(F.concat(F.lit("BEAM"), F.pmod("l_suppkey", F.lit(8)).cast("string")), F.lit("METADATA"))).alias("beam"),
        F.array(F.lit(1), F.lit(2)).alias("shot"),
        F.array(F.col("l_extendedprice") + 0.01, F.col("l_extendedprice") + 0.02).alias("delta_time"),
        F.array("l_quantity", F.when(F.col("l_returnflag") != "R", F.col("l_tax"))).alias("elev1"),
        F.array(F.array("l_tax", "l_discount", "l_quantity"), F.array("l_discount", "l_tax", "l_quantity")).alias("rh"))
    out = ops.flatten_shots(beams, ["shot", "delta_time", "elev1"], 3, keys=("file_no", "line", "beam"))
    return out.drop("delta_time")


@query("shot_quality", "SELECT file_no, shot, sensitivity, rh95 FROM v_shots WHERE sensitivity >= 0.95 AND rh95 > 0", ("v_shots",))
def _(t: Tables):
    return ops.shot_quality(t.view("v_shots"), 0.95, None, "rh95").select("file_no", "shot", "sensitivity", "rh95")


@query("pooled_elev_stats", f"WITH {_STATS} SELECT file_no, ROUND(mean, 8) AS elev_mean, ROUND(sd, 8) AS elev_sd FROM st", ("v_shots",))
def _(t: Tables):
    out = ops.pooled_elev_stats(ops.shot_quality(t.view("v_shots")), ["file_no"])
    return out.withColumns({c: rounded(c, 8) for c in ("elev_mean", "elev_sd")})


@query("robust_range", f"WITH {_STATS} SELECT file_no, shot, elev1, ROUND(elev_range, 8) AS elev_range FROM g", ("v_shots",))
def _(t: Tables):
    return _stats_then_range(t).select("file_no", "shot", "elev1", rounded("elev_range", 8).alias("elev_range"))


@query("process_shots", f"""WITH {_STATS} SELECT file_no, shot, elev1, rh95, ROUND(elev_range, 8) AS elev_range FROM g
WHERE ABS(elev_range) < 2 AND rh95 > 0""", ("v_shots",))
def _(t: Tables):
    return ops.process_shots(t.view("v_shots")).select("file_no", "shot", "elev1", "rh95",
                                                       rounded("elev_range", 8).alias("elev_range"))


@query("success_report", """
WITH f AS (SELECT l_suppkey AS file, AVG(l_quantity) > 25.5 AS ok FROM lineitem GROUP BY l_suppkey)
SELECT CASE WHEN ok THEN 'processed' ELSE 'failed' END AS status, COUNT(*) OVER (PARTITION BY ok) AS n_files, file FROM f""")
def _(t: Tables):
    files = t.table("lineitem").groupBy(F.col("l_suppkey").alias("file")).agg((F.avg("l_quantity") > 25.5).alias("processed"))
    return ops.success_report(files)
