"""Whole jobs composed of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundloom.functions.geodesy import epsg_of, reproject_ring
from groundloom.functions.indices import logit_score, rvi, threshold_class
from groundloom.functions.names import tile_corner
from groundloom.operators.bayes import LogitModel, Prior, bayes_logit_fit, draw_matrix, predict_interval
from groundloom.operators.catalog import latest_processing
from groundloom.operators.composites import (PIXEL, alos_layers, classify_stack, frame_temporal_job, mosaic,
                                             temporal_mean_skipna)
from groundloom.operators.grids import Grid, resample, to_tiles, window_at_points
from groundloom.operators.neighborhood import enhanced_lee
from groundloom.operators.strata import (class_histogram, consolidate, distribute_sample, fill_categories,
                                         scale_for_training, shuffle_and_number, size_stehman_foody,
                                         stratified_sample, train_val_test_split)
from groundloom.operators.vector import TASK_POLYGONS, make_tiles, ring_bounds
from groundloom.operators.votes import class_mean_impute, consensus, long_votes, merge_labelers
from groundloom.scale import attach, dealt
from groundloom.session import checkpointed


def vegetation_map(scenes: DataFrame, co: str, cross: str, intercept: float, weight: float,
                   keys: Sequence[str] = ("frame", *PIXEL)) -> DataFrame:
    """Time series to temporal means, vegetation index and probability per pixel.

    One aggregation by pixel is the only shuffle; index and score are projections on top.
    """
    means = frame_temporal_job(scenes, [co, cross], "mean", keys)
    indexed = means.withColumn("rvi", rvi(co, cross))
    return indexed.withColumn("probability", logit_score(intercept, [weight], ["rvi"]))


def utm_tiles(aoi: DataFrame, size: float, centered: bool = True, x_offset: float = 0, y_offset: float = 0) -> DataFrame:
    """Reference tiles for an area in longitude and latitude, in the UTM zone of its middle."""
    box = aoi.select(*[v.alias(k) for k, v in ring_bounds(F.col("ring")).items()])
    xmin, ymin, xmax, ymax = box.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    epsg = epsg_of((ymin + ymax) / 2, (xmin + xmax) / 2)
    # written once: the bounds and the join would each project every vertex again
    plane = checkpointed(dealt(aoi, F.lit(1), TASK_POLYGONS).withColumn("ring", reproject_ring("ring", 4326, epsg)))
    return make_tiles(plane, size, centered, x_offset, y_offset, epsg)


def burst_tiles(scenes: DataFrame, grid: Grid, target: Grid, cells_per_tile: int) -> DataFrame:
    """Burst time series to co- and cross-polarized tiles with their vegetation index.

    ``scenes`` has one row per burst, acquisition, processing time and pixel with bands ``vv``
    and ``vh``. The latest processing of an acquisition counts, which is decided on the scenes and
    not on their pixels; later bursts win in a mosaic.
    """
    latest = latest_processing(scenes.select("burst", "acq", "proc").distinct(), ["burst", "acq"], "proc")
    current = attach(scenes, latest, ["burst", "acq", "proc"], "left_semi")
    means = temporal_mean_skipna(current, ["burst", *PIXEL], ["vv", "vh"], scenes=latest)
    tiled = to_tiles(resample(means, grid, target, "nearest"), cells_per_tile)
    flat = mosaic(tiled, ["h", "v", *PIXEL], "burst", ["vv", "vh"])
    return flat.withColumn("rvi", rvi("vv", "vh"))


def alos_mosaic_job(dn: DataFrame, year: int, win: int = 5, looks: float = 1,
                    tile: Sequence[str] = ("tile",)) -> DataFrame:
    """L-band mosaic tiles: calibrated, speckle-filtered HH and HV, incidence angle and day of year.

    Each tile is filtered alone. Both polarizations go through the filter as one table.
    """
    tile = list(tile)
    layers = alos_layers(dn, year)
    pols = F.array(*[F.struct(F.lit(p).alias("pol"), F.col(p).alias("value")) for p in ("hh", "hv")])
    long = layers.select(*tile, *PIXEL, "inc", "doy", F.explode(pols).alias("_p")).select(
        *tile, *PIXEL, "inc", "doy", "_p.*")
    done = enhanced_lee(long, win, looks, "value", "value_filtered", [*tile, "pol"])
    return done.groupBy(*tile, *PIXEL).agg(
        F.max(F.when(F.col("pol") == "hh", F.col("value_filtered"))).alias("hh"),
        F.max(F.when(F.col("pol") == "hv", F.col("value_filtered"))).alias("hv"),
        F.max("inc").alias("inc"), F.max("doy").alias("doy"))


def mosaic_named_tiles(px: DataFrame, cells: int, values: Sequence[str], priority: str, tile: str = "tile") -> DataFrame:
    """1-degree tiles of ``cells`` by ``cells`` pixels, placed by their names on one image, each value mosaicked.

    Row and column 0 are at the northernmost and westernmost tile. Of several values of a cell the one of highest
    ``priority`` that has data counts, so that layers of several years fill each other's gaps.
    """
    lat, lon = tile_corner(tile)
    corners = px.select(tile).distinct().agg(F.max(lat).alias("north"), F.min(lon).alias("west")).first()
    placed = px.withColumns({"pr": F.col("pr") + (F.lit(corners["north"]) - lat) * cells,
                             "pc": F.col("pc") + (lon - F.lit(corners["west"])) * cells})
    return mosaic(placed, PIXEL, priority, values)


def point_model(points: DataFrame, stack: DataFrame, grid: Grid, bands: Sequence[str], cls: str, positive: str,
                prior: Prior | None = None, key: str = "pid") -> tuple[LogitModel, DataFrame]:
    """Training points to a fitted model and the points with probability and predicted class."""
    extracted = window_at_points(points, stack, grid, bands, key=key)
    filled = class_mean_impute(extracted, cls, bands)
    labelled = filled.withColumn("true_label", (F.col(cls) == positive).cast("int"))
    model = bayes_logit_fit(labelled, bands, "true_label", prior)
    scored = labelled.withColumn("probability", model.probability())
    return model, scored.withColumn("predicted", threshold_class("probability"))


def point_intervals(points: DataFrame, model: LogitModel, n: int = 2000, seed: int = 7, low: float = 0.025,
                    high: float = 0.975) -> DataFrame:
    """Credible interval of the probability of each point."""
    return predict_interval(points, draw_matrix(model, n, seed).tolist(), model.cols, low, high)


def probability_map(stack: DataFrame, model: LogitModel, keys: Sequence[str] = PIXEL) -> DataFrame:
    return classify_stack(stack, model.probability(), keys)


def sample_design(px: DataFrame, absence: Mapping[int, float], presence: Mapping[int, float], moe: float,
                  confidence: float, minimum: int, accuracy: float, proportion: float, seed: int,
                  ident: Sequence[str], cat: str = "cat") -> DataFrame:
    """Strata image to a numbered stratified sample of pixels."""
    hist = class_histogram(px, cat)
    binary = consolidate(hist, list(absence), list(presence), cat)
    sized = scale_for_training(size_stehman_foody(binary, moe, confidence, minimum, accuracy, cat), proportion)
    final = fill_categories(distribute_sample(sized, hist, absence, presence, cat), cat)
    drawn = stratified_sample(px, final, seed, ident, cat)
    return shuffle_and_number(drawn, seed, ident, 1)


def label_set(votes: DataFrame, by: Sequence[str], labelers: Sequence[str], shares: tuple[float, float, float],
              seed: int) -> DataFrame:
    """Votes of several labelers to consensus labels with a train, validation and test split."""
    wide = merge_labelers(votes, by, labelers)
    cols = [c for c in wide.columns if c not in by]
    agreed = consensus(long_votes(wide, by, cols), by, len(labelers))
    return train_val_test_split(agreed, shares, seed, by)
