"""GeoJSON features and well-known text of polygons, with holes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundloom.functions.indices import as_col

_GEOMETRY = "struct<type: string, coordinates: string>"
_POINT = "array<double>"


def _open_ring(points: Column) -> Column:
    """Vertex array without the repeated last vertex."""
    ring = F.transform(points, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    closed = F.element_at(ring, 1) == F.element_at(ring, -1)
    return F.when(closed, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)


def _ring(rings: Column) -> Column:
    """One vertex array of a polygon; with holes each ring is closed and followed by a NULL."""
    def closed(points: Column) -> Column:
        ring = _open_ring(points)
        return F.concat(ring, F.slice(ring, 1, 1), F.array(F.lit(None).cast("struct<x: double, y: double>")))

    return F.when(F.size(rings) == 1, _open_ring(rings[0])).otherwise(F.flatten(F.transform(rings, closed)))


def rings_of(ring: Column | str) -> Column:
    """Closed rings of a polygon, the outer one first."""
    ring = as_col(ring)
    point = "array<struct<x: double, y: double>>"
    start = F.struct(F.expr(f"CAST(array() AS array<{point}>)").alias("done"), F.expr(f"CAST(array() AS {point})").alias("now"))

    def step(acc: Column, p: Column) -> Column:
        end = p.isNull()
        return F.struct(F.when(end, F.concat(acc["done"], F.array(acc["now"]))).otherwise(acc["done"]).alias("done"),
                        F.when(end, F.slice(acc["now"], 1, 0)).otherwise(F.concat(acc["now"], F.array(p))).alias("now"))

    split = F.aggregate(ring, start, step, lambda acc: acc["done"])
    return F.when(F.exists(ring, lambda p: p.isNull()), split).otherwise(F.array(F.concat(ring, F.slice(ring, 1, 1))))


def read_features(spark: SparkSession, path: str, properties: str, epsg: int = 4326,
                  by_line: bool = False) -> DataFrame:
    """Polygons with their attributes; a multi-polygon becomes one row per part, holes stay with their part.

    ``properties`` is the schema of the attributes. A feature collection is one document per
    file; with ``by_line`` every line is a feature, so that a single large file splits. A feature that is no polygon is an
    error.
    """
    feature = f"struct<properties: struct<{properties}>, geometry: {_GEOMETRY}>"
    if by_line:
        lines = spark.read.schema(f"properties struct<{properties}>, geometry {_GEOMETRY}").json(path)
        rows = lines.select(F.struct("properties", "geometry").alias("f"))
    else:
        docs = spark.read.schema(f"features array<{feature}>").option("multiLine", True).json(path)
        rows = docs.select(F.explode("features").alias("f"))
    shape = F.col("f.geometry.coordinates")
    parts = (F.when(F.col("f.geometry.type") == "MultiPolygon",
                    F.from_json(shape, f"array<array<array<{_POINT}>>>"))
             .when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json(shape, f"array<array<{_POINT}>>")))
             .otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce("f.geometry.type", F.lit("no geometry"))))))
    flat = rows.select("f.properties.*", F.explode(parts).alias("_part"))
    return flat.withColumn("ring", _ring(F.col("_part"))).drop("_part").withColumn("epsg", F.lit(epsg))


def wkt(ring: Column | str) -> Column:
    """POLYGON text with the first vertex of each ring repeated at its end."""
    def text(points: Column) -> Column:
        pairs = F.transform(points, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
        return F.concat(F.lit("("), F.array_join(pairs, ", "), F.lit(")"))

    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings_of(ring), text), ", "), F.lit(")"))


def write_features(df: DataFrame, path: str, as_wkt: bool = False, ring: str = "ring",
                   mode: str = "errorifexists") -> None:
    """One GeoJSON feature per line, or delimited text with the polygon as well-known text."""
    attrs = [c for c in df.columns if c != ring]
    if as_wkt:
        df.select(*attrs, wkt(ring).alias("geometry")).write.mode(mode).option("header", True).csv(path)
        return
    points = F.transform(rings_of(ring), lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*attrs).alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), points.alias("coordinates")).alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.mode(mode).text(path)
