"""Scene, burst, product and job tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundloom.functions.names import TILE_ID, frame_id
from groundloom.scale import attach


def majority_orbit(df: DataFrame, direction: str = "flightDirection") -> DataFrame:
    """Scenes of the more frequent orbit direction; ascending wins a tie."""
    counts = df.agg(F.count_if(F.col(direction) == "ASCENDING").alias("_up"),
                    F.count_if(F.col(direction) == "DESCENDING").alias("_down"))
    keep = counts.select(F.when(F.col("_up") >= F.col("_down"), "ASCENDING").otherwise("DESCENDING").alias(direction))
    return df.join(F.broadcast(keep), direction, "left_semi")       # one row


def sort_catalog(df: DataFrame, cols: Sequence[str] = ("pathNumber", "frameNumber", "startTime")) -> DataFrame:
    return df.orderBy(*cols)


def drop_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the list."""
    return df.join(listed.select(key), key, "left_anti")


def pending_work(requested: DataFrame, histories: Sequence[DataFrame], key: Sequence[str],
                 resubmit: bool = False) -> DataFrame:
    """Requests (item and options) that no job history holds yet."""
    if not resubmit:
        for done in histories:
            requested = requested.join(done.select(*key), list(key), "left_anti")
    return requested


def count_by_frame(df: DataFrame, keys: Sequence[str] = ("pathNumber", "frameNumber"),
                   frames: DataFrame | None = None) -> DataFrame:
    """Granules per frame; with ``frames`` also those of its frames that have none, as 0."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_granules"))
    if frames is None:
        return counts
    every = frames.select(*keys).distinct()
    return every.join(counts, list(keys), "left").withColumn("num_granules", F.coalesce("num_granules", F.lit(0).cast("bigint")))


def first_n_quota(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The requests the remaining quota allows, in order."""
    return df.orderBy(*order).limit(n)


def skip_done(work: DataFrame, done: DataFrame, key: Sequence[str], variant: str,
              need: Sequence[str] = ("VV", "VH")) -> DataFrame:
    """Work items for which not all needed outputs exist."""
    complete = (done.where(F.col(variant).isin(list(need))).groupBy(*key)
                .agg(F.count_distinct(variant).alias("_n")).where(F.col("_n") == len(need)).select(*key))
    return work.join(complete, list(key), "left_anti")


def expected_vs_found(tiles: DataFrame, files: DataFrame,
                      layers: Sequence[str] = ("VV", "VH", "RVI")) -> DataFrame:
    """Per tile and layer whether the file exists; NULL for inactive tiles.

    ``files`` has one row per file with columns ``h``, ``v`` and ``layer``.
    """
    flags = files.groupBy("h", "v").agg(*[F.bool_or(F.col("layer") == l).alias(l) for l in layers])
    seen = tiles.select("h", "v", "mask").join(flags, ["h", "v"], "left")
    return seen.select("h", "v", *[F.when(F.col("mask") != 0, F.coalesce(F.col(l), F.lit(False))).alias(l)
                                   for l in layers])


def all_found(status: DataFrame, layers: Sequence[str] = ("VV", "VH", "RVI")) -> DataFrame:
    """One row: whether every active tile has every layer."""
    ok = F.lit(True)
    for l in layers:
        ok = ok & F.coalesce(F.col(l), F.lit(True))
    return status.agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("all_found"))


def attach_metadata(jobs: DataFrame, scenes: DataFrame, key: str = "sceneName") -> DataFrame:
    """Jobs with the metadata of their scene; a scene named by very many jobs is spread out."""
    return attach(jobs, scenes, [key], derived=False)


def pair_polarizations(files: DataFrame, co: str = "VV", cross: str = "VH",
                       keys: Sequence[str] = ("h", "v")) -> DataFrame:
    """Tiles for which both polarizations exist, with both paths."""
    def one(pol: str, name: str) -> DataFrame:
        return files.where(F.col("pol") == pol).groupBy(*keys).agg(F.max("path").alias(name))

    return one(co, "co_path").join(one(cross, "cross_path"), list(keys))


def burst_summary(granules: DataFrame, id_len: int = 31, file_id: str = "fileID",
                  path: str = "pathNumber") -> DataFrame:
    """Per burst: number of granules and most frequent path, the smallest on a tie."""
    per_path = (granules.withColumn("burst_id", F.substring(file_id, 1, id_len))
                .groupBy("burst_id", path).agg(F.count(F.lit(1)).alias("_n")))
    return per_path.groupBy("burst_id").agg(
        F.sum("_n").alias("count"),
        F.max(F.struct(F.col("_n"), (-F.col(path)).alias("_neg"))).getField("_neg").alias("_neg"),
    ).select("burst_id", "count", (-F.col("_neg")).alias(path))


def counts_with_attrs(granules: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Per key the row count and one value of each attribute, in one aggregation."""
    return granules.groupBy(key).agg(F.count(F.lit(1)).alias("count"), *[F.min(a).alias(a) for a in attrs])


def burst_count_classes(bursts: DataFrame) -> DataFrame:
    """How many bursts have each acquisition count."""
    return bursts.groupBy("count").agg(F.count(F.lit(1)).alias("bursts"))


def latest_processing(df: DataFrame, keys: Sequence[str], proc: str) -> DataFrame:
    """Per key (burst and acquisition time) the row processed last.

    A maximum over structs combines before the shuffle, unlike a ranking window.
    """
    rest = [c for c in df.columns if c not in keys and c != proc]
    best = df.groupBy(*keys).agg(F.max(F.struct(proc, *rest)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def file_key_parts(files: DataFrame, name: str = "name") -> DataFrame:
    """Tile numbers and layer of tile files, from names ending in ``_h<h>_v<v>_<layer>.tif``."""
    pattern = TILE_ID + r"_(\w+)\.tif$"
    return (files.where(F.col(name).rlike(pattern))
            .withColumns({"h": F.regexp_extract(name, pattern, 1).cast("int"),
                          "v": F.regexp_extract(name, pattern, 2).cast("int"),
                          "layer": F.regexp_extract(name, pattern, 3)}))


def products_by_frame(df: DataFrame, prefix: str, frames: Sequence[str] | None = None) -> DataFrame:
    """Product paths per ``<path>_<frame>``, optionally only of the listed frames.

    One row per product, so that a frame with very many products stays spread over partitions.
    """
    keyed = df.withColumn("frame_id", frame_id("pathNumber", "frameNumber"))
    if frames is not None:
        keyed = keyed.where(F.col("frame_id").isin(list(frames)))
    return keyed.select("frame_id", F.concat_ws("/", F.lit(prefix), F.col("frame_id"), F.col("filename")).alias("product"))


def product_lists(df: DataFrame, prefix: str, frames: Sequence[str] | None = None) -> DataFrame:
    """Product paths with the number of products of their frame, one row per product."""
    rows = products_by_frame(df, prefix, frames)
    return attach(rows, rows.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n_products")), ["frame_id"])


def granules_of_frames(granules: DataFrame, frames: DataFrame,
                       keys: Sequence[str] = ("pathNumber", "frameNumber")) -> DataFrame:
    return attach(granules, frames.select(*keys), keys, "left_semi")


def tiles_in_use(tiles: DataFrame) -> DataFrame:
    """'n of m' report: tiles that meet the area and tiles in all."""
    return tiles.agg(F.count_if(F.col("mask") != 0).alias("n_active"), F.count(F.lit(1)).alias("n_tiles"))


