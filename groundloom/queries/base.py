"""Registry of the queries, and views that shape the given tables into rasters, catalogs and labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.functions.indices import STACK_BANDS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_DAY = "REPLACE(CAST(CAST({} AS DATE) AS STRING), '-', '')"
_STACK = [f"ABS(CAST({{el}}{i}{{le}} AS DOUBLE)) AS {b}" for i, b in enumerate(STACK_BANDS, start=1)]

# Column lists that Spark SQL and DuckDB read alike. {el}k{le} is the k-th element of the vector.
VIEWS = {
    "v_px": ("orders", ["CAST(FLOOR(o_orderkey / 120.0) AS INT) AS pr", "CAST(o_orderkey % 120 AS INT) AS pc",
                        "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice / 100000.0 END AS value"]),
    "v_mask": ("orders", ["CAST(FLOOR(o_orderkey / 120.0) AS INT) AS pr", "CAST(o_orderkey % 120 AS INT) AS pc",
                          "CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE 1 END AS mask", "o_orderstatus AS status"]),
    "v_obs": ("lineitem", ["CAST(FLOOR(l_partkey / 50.0) AS INT) AS pr", "CAST(l_partkey % 50 AS INT) AS pc",
                           "CAST(l_shipdate AS DATE) AS acq", "l_returnflag AS frame", "l_discount AS vh",
                           "l_extendedprice / 1000000.0 AS vv", "l_tax AS inc", "l_quantity AS quantity",
                           "CAST(l_quantity AS INT) AS qa", "l_orderkey AS scene", "l_linenumber AS line"]),
    "v_stack": ("embeddings", ["CAST(FLOOR(vec_id / 25.0) AS INT) AS pr", "CAST(vec_id % 25 AS INT) AS pc",
                               "label AS cat", "vec_id AS pixel", *_STACK]),
    "v_scenes": ("orders", [
        "o_orderkey AS scene_no", "CAST(o_custkey % 12 AS INT) AS pathNumber", "CAST(o_custkey % 30 AS INT) AS frameNumber",
        "CAST(o_orderdate AS DATE) AS day", "o_orderdate AS startTime",
        "CASE WHEN o_orderstatus = 'F' THEN 'ASCENDING' ELSE 'DESCENDING' END AS flightDirection",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'S1A' ELSE 'S1B' END AS platform", "o_orderpriority AS level",
        "CONCAT('OPERA_L2_RTC-S1_T', LPAD(CAST(o_custkey % 60 AS STRING), 3, '0'), '-IW1_', "
        + _DAY.format("o_orderdate") + ", 'T', LPAD(CAST(o_orderkey % 24 AS STRING), 2, '0'), '0000Z_', "
        + _DAY.format("o_orderdate") + ", 'T235959Z_S1A_30_v1.0') AS scene_name",
        "CONCAT('S1A_IW_', " + _DAY.format("o_orderdate") + ", 'T060000_DVP_RTC30_G_gpunem_', "
        "LPAD(CAST(o_orderkey % 10000 AS STRING), 4, '0'), '.zip') AS filename",
        "CONCAT('s1_tile_site_a_b_h', CAST(o_custkey % 40 AS STRING), '_v', CAST(o_orderkey % 12 AS STRING), '_', "
        "CASE WHEN o_orderstatus = 'F' THEN 'VV' WHEN o_orderstatus = 'O' THEN 'VH' ELSE 'RVI' END, '.tif') AS tile_file",
        "CAST((o_custkey % 12) * 80 + (o_orderkey % 3) * 5 AS DOUBLE) AS xmin",
        "CAST((o_custkey % 30) * 60 + (o_orderkey % 4) * 5 AS DOUBLE) AS ymin",
        "CAST((o_custkey % 12) * 80 + (o_orderkey % 3) * 5 + 100 AS DOUBLE) AS xmax",
        "CAST((o_custkey % 30) * 60 + (o_orderkey % 4) * 5 + 100 AS DOUBLE) AS ymax"]),
    "v_products": ("events", ["user_id AS burst", "CAST(ts AS DATE) AS acq", "event_id AS proc", "event_type AS kind",
                              "value"]),
    "v_shots": ("lineitem", [
        "CAST(l_suppkey % 10 AS INT) AS file_no", "l_orderkey * 10 + l_linenumber AS shot",
        "CAST(1.0 - l_discount AS DOUBLE) AS sensitivity", "l_quantity AS elev1", "l_quantity + 5 * l_tax AS elev2",
        "l_quantity + 10 * l_tax AS elev3", "l_quantity - 5 * l_tax AS elev4", "l_quantity + 15 * l_tax AS elev5",
        "l_quantity + 100 * l_discount AS elev6", "l_quantity - 5 AS rh95"]),
    "v_points": ("customer", [
        "c_custkey AS pid", "CAST(-76 + (c_custkey % 400) / 100.0 AS DOUBLE) AS lon",
        "CAST(-11 + (FLOOR(c_custkey / 400.0) % 2000) / 100.0 AS DOUBLE) AS lat", "c_mktsegment AS cls",
        "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS x1", "c_name AS name", "c_nationkey AS nation"]),
    "v_gpoints": ("customer", [
        "c_custkey AS pid", "CAST((c_custkey * 37 % 1300) / 10.0 + 0.031 AS DOUBLE) AS x",
        "CAST(-(c_custkey * 7 % 13000) / 100.0 - 0.017 AS DOUBLE) AS y"]),
    "v_foot": ("supplier", [
        "s_suppkey AS id", "CAST((s_suppkey % 10) * 80 AS DOUBLE) AS xmin",
        "CAST(FLOOR(s_suppkey / 10.0) * 80 AS DOUBLE) AS ymin", "CAST((s_suppkey % 10) * 80 + 100 AS DOUBLE) AS xmax",
        "CAST(FLOOR(s_suppkey / 10.0) * 80 + 100 AS DOUBLE) AS ymax"]),
    "v_burst": ("customer", [
        "CONCAT('T', LPAD(CAST(c_custkey AS STRING), 9, '0')) AS burst_id",
        "CAST((c_custkey % 50) * 17 + 3 AS DOUBLE) AS xmin", "CAST(FLOOR(c_custkey / 50.0) * 23 + 4 AS DOUBLE) AS ymin",
        "CAST((c_custkey % 50) * 17 + 38 AS DOUBLE) AS xmax", "CAST(FLOOR(c_custkey / 50.0) * 23 + 44 AS DOUBLE) AS ymax"]),
    "v_survey": ("labels", [
        "doc_id AS plotid", "CAST(doc_id % 9 AS INT) AS pl_cluster", "CAST(doc_id AS DOUBLE) / 7 AS center_lat",
        "CAST(doc_id AS DOUBLE) / 3 AS center_lon", "CONCAT('user', CAST(doc_id % 3 AS STRING)) AS email",
        "quality * 100 AS presence", "(1 - quality) * 100 AS absence", "toxic * 100 AS unsure"]),
}


def _expressions(name: str, spark: bool) -> list[str]:
    marks = ("element_at(embedding, ", ")") if spark else ("embedding[", "]")
    return [e.replace("{el}", marks[0]).replace("{le}", marks[1]) for e in VIEWS[name][1]]


V_VOTES = """v_votes AS (SELECT doc_id, 'user1' AS labeler, quality AS vote FROM labels
  UNION ALL SELECT doc_id, 'user2', CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 1 - toxic END FROM labels
  UNION ALL SELECT l.doc_id, 'user3', CASE WHEN d.n_chars % 3 = 0 THEN 2 WHEN d.n_chars % 3 = 1 THEN 1 ELSE 0 END
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


class Tables:
    """The given tables of one folder and the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name == "v_votes":
            return self._votes()
        return self.table(VIEWS[name][0]).selectExpr(*_expressions(name, True))

    def _votes(self) -> DataFrame:
        labels, docs = self.table("labels"), self.table("documents").select("doc_id", "n_chars")
        one = labels.selectExpr("doc_id", "'user1' AS labeler", "quality AS vote")
        two = labels.selectExpr("doc_id", "'user2' AS labeler",
                                "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 1 - toxic END AS vote")
        three = labels.select("doc_id").join(docs, "doc_id").selectExpr(
            "doc_id", "'user3' AS labeler",
            "CASE WHEN n_chars % 3 = 0 THEN 2 WHEN n_chars % 3 = 1 THEN 1 ELSE 0 END AS vote")
        return one.unionByName(two).unionByName(three)


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), ready: bool = False):
    """Register a query; the DuckDB text gets the named views as leading table expressions unless it is ready."""
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if ready:
            ORACLES[name] = sql
        elif sql is not None:
            heads = [V_VOTES if v == "v_votes"
                     else f"{v} AS (SELECT {', '.join(_expressions(v, False))} FROM {VIEWS[v][0]})" for v in views]
            body = _nudged(sql.strip())
            if body.startswith("WITH "):
                heads.append(body[len("WITH "):])
                ORACLES[name] = "WITH " + ", ".join(heads)
            else:
                ORACLES[name] = (f"WITH {', '.join(heads)} " if heads else "") + body
        return fn

    return register


def _nudge(digits: int) -> float:
    """A small part of the last digit. It moves exact ties, which engines round differently, off the tie."""
    return float(f"1.7e-{digits + 3}")


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Value rounded for comparison; the DuckDB texts get the same nudge in every ROUND."""
    return F.round((F.col(c) if isinstance(c, str) else c) + _nudge(digits), digits)


def _nudged(sql: str) -> str:
    """The text with ``ROUND(x, d)`` turned into ``ROUND(x + nudge, d)``."""
    out, rest = "", sql
    while (at := rest.find("ROUND(")) >= 0:
        depth, comma, end = 1, 0, at + 6
        while depth:
            ch = rest[end]
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 1:
                comma = end
            end += 1
        inner, digits = rest[at + 6:comma], int(rest[comma + 1:end - 1])
        out += rest[:at] + "ROUND(" + _nudged(inner) + (f" + {_nudge(digits)!r}" if digits else "") + f", {digits})"
        rest = rest[end:]
    return out + rest
