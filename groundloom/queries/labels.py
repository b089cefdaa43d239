"""Queries: labels by several labelers."""

from pyspark.sql import functions as F

from groundloom.operators import votes as ops
from groundloom.plans import jobs
from groundloom.queries.base import Tables, query, rounded

LABELERS = ["user1", "user2", "user3"]
P = ops.LABELER_PREFIX
_MODE = """n AS (SELECT doc_id, vote, COUNT(vote) AS n FROM v_votes GROUP BY ALL),
 m AS (SELECT doc_id, (SELECT x.vote FROM n x WHERE x.doc_id = n.doc_id AND x.n > 0 ORDER BY x.n DESC, x.vote LIMIT 1) AS cls,
  MAX(n) / SUM(n) AS confidence, CAST(SUM(n) AS BIGINT) AS ct FROM n GROUP BY doc_id)"""


@query("merge_labelers", f"""
SELECT a.doc_id, CAST(a.vote AS DOUBLE) AS "{P}1", CAST(b.vote AS DOUBLE) AS "{P}2", CAST(c.vote AS DOUBLE) AS "{P}3"
FROM (SELECT * FROM v_votes WHERE labeler = 'user2') a
LEFT JOIN (SELECT * FROM v_votes WHERE labeler = 'user1') b ON a.doc_id = b.doc_id
LEFT JOIN (SELECT * FROM v_votes WHERE labeler = 'user3') c ON a.doc_id = c.doc_id""", ("v_votes",))
def _(t: Tables):
    out = ops.merge_labelers(t.view("v_votes"), ["doc_id"], ["user2", "user1", "user3"])
    return out.select("doc_id", *[F.col(f"`{P}{i}`").cast("double").alias(f"{P}{i}") for i in (1, 2, 3)])


@query("vote_mode", f"""WITH {_MODE} SELECT doc_id, cls AS "class", ROUND(confidence, 9) AS confidence, ct AS "count" FROM m""",
       ("v_votes",))
def _(t: Tables):
    return ops.vote_mode(t.view("v_votes"), ["doc_id"]).withColumn("confidence", rounded("confidence", 9))


@query("consensus", f"""WITH {_MODE} SELECT doc_id, cls AS "class", ROUND(confidence, 9) AS confidence, ct AS "count" FROM m
WHERE confidence > 1.0 / 3""", ("v_votes",))
def _(t: Tables):
    out = ops.consensus(t.view("v_votes"), ["doc_id"], 3)
    return out.withColumn("confidence", rounded("confidence", 9))


@query("label_mode_flag", """
WITH n AS (SELECT doc_id, vote, COUNT(*) AS n FROM v_votes WHERE vote IS NOT NULL GROUP BY ALL),
 x AS (SELECT *, MAX(n) OVER (PARTITION BY doc_id) AS top FROM n)
SELECT doc_id, CASE WHEN COUNT(*) = 1 THEN MIN(vote) ELSE -9999 END AS mode_label FROM x WHERE n = top GROUP BY doc_id""",
       ("v_votes",))
def _(t: Tables):
    return ops.label_mode_flag(t.view("v_votes"), ["doc_id"])


@query("agreement_by_class", f"""WITH {_MODE} SELECT cls AS "class", ROUND(AVG(confidence), 9) AS mean_confidence FROM m
WHERE confidence > 1.0 / 3 GROUP BY cls""", ("v_votes",))
def _(t: Tables):
    out = ops.agreement_by_class(ops.consensus(t.view("v_votes"), ["doc_id"], 3))
    return out.withColumn("mean_confidence", rounded("mean_confidence", 9))


@query("labelers_list", "SELECT DISTINCT email FROM v_survey", ("v_survey",))
def _(t: Tables):
    return ops.labelers_list(t.view("v_survey"))


@query("process_labels", """
SELECT plotid AS Point_ID, pl_cluster AS Clust, center_lat AS Lat, center_lon AS Lon, CAST(CASE WHEN presence + absence + unsure = 100
THEN CASE WHEN presence = 100 THEN 1 WHEN absence = 100 THEN 0 ELSE 2 END END AS DOUBLE) AS labeler FROM v_survey""", ("v_survey",))
def _(t: Tables):
    rename = {"plotid": "Point_ID", "pl_cluster": "Clust", "center_lat": "Lat", "center_lon": "Lon",
              "presence": "Presence", "absence": "Absence", "unsure": "Unsure"}
    out = ops.process_labels(t.view("v_survey"), rename, ["Presence", "Absence", "Unsure"],
                             {"Presence": 1, "Absence": 0, "Unsure": 2}, ["Point_ID", "Clust"])
    return out.withColumn("labeler", F.col("labeler").cast("double"))


@query("class_mean_impute", """
SELECT pid, cls, ROUND(COALESCE(x1, AVG(x1) OVER (PARTITION BY cls)), 7) AS x1 FROM v_points""", ("v_points",))
def _(t: Tables):
    out = ops.class_mean_impute(t.view("v_points").select("pid", "cls", "x1"), "cls", ["x1"])
    return out.withColumn("x1", rounded("x1", 7))


@query("confusion_matrix", """
SELECT k AS predicted, COUNT(*) FILTER (WHERE k = 1 AND frame <> 'A') AS actual_0,
COUNT(*) FILTER (WHERE k = 1 AND frame = 'A') AS actual_1 FROM v_obs, (SELECT unnest([0, 1]) AS k) GROUP BY ALL""", ("v_obs",))
def _(t: Tables):
    # class 0 is never predicted and keeps its row
    df = t.view("v_obs").select((F.col("vv") > -1).cast("int").alias("p"), (F.col("frame") == "A").cast("int").alias("a"))
    return ops.confusion_matrix(df, "p", "a")


@query("confusion_matrix_both", """
SELECT k AS predicted, COUNT(*) FILTER (WHERE (vv > 0.05) = (k = 1) AND frame <> 'A') AS actual_0,
COUNT(*) FILTER (WHERE (vv > 0.05) = (k = 1) AND frame = 'A') AS actual_1 FROM v_obs, (SELECT unnest([0, 1]) AS k) GROUP BY ALL""",
       ("v_obs",))
def _(t: Tables):
    df = t.view("v_obs").select((F.col("vv") > 0.05).cast("int").alias("p"), (F.col("frame") == "A").cast("int").alias("a"))
    return ops.confusion_matrix(df, "p", "a")


@query("overall_accuracy", """
SELECT ROUND(AVG(CASE WHEN (vv > 0.05) = (frame = 'A') THEN 1.0E0 ELSE 0.0E0 END), 9) AS accuracy FROM v_obs""", ("v_obs",))
def _(t: Tables):
    df = t.view("v_obs").select((F.col("vv") > 0.05).cast("int").alias("p"), (F.col("frame") == "A").cast("int").alias("a"))
    return ops.overall_accuracy(df, "p", "a").withColumn("accuracy", rounded("accuracy", 9))


@query("label_set", f"""WITH {_MODE}, c AS (SELECT * FROM m WHERE confidence > 1.0 / 3),
 r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY md5(concat_ws(':', '999', doc_id)), doc_id) - 1 AS k, COUNT(*) OVER () AS n FROM c)
SELECT doc_id, cls AS "class", ROUND(confidence, 9) AS confidence, ct AS "count", CASE WHEN k < FLOOR(n * 0.7) THEN 'train'
WHEN k < FLOOR(n * 0.7) + FLOOR(n * 0.2) THEN 'validate' ELSE 'map_reference/test' END AS usage FROM r""", ("v_votes",))
def _(t: Tables):
    out = jobs.label_set(t.view("v_votes"), ["doc_id"], LABELERS, (0.7, 0.2, 0.1), 999)
    return out.withColumn("confidence", rounded("confidence", 9))
