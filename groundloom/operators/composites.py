"""Temporal statistics per pixel, masks, stacks and mosaics on pixel tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundloom.functions.calendar import day_of_year
from groundloom.functions.indices import STACK_BANDS, condense, dn_to_gamma0, incidence_degrees, rvi
from groundloom.scale import MAX_GROUP_ROWS, attach, grouped_quantiles, ranked_quantiles

PIXEL = ("pr", "pc")


def nonzero(value: str) -> Column:
    return F.nullif(F.col(value), F.lit(0).cast("double"))


def temporal_mean_nz(px: DataFrame, keys: Sequence[str], value: str = "value", out: str = "mean") -> DataFrame:
    """Mean over time of the non-zero values; 0 where there is none."""
    return px.groupBy(*keys).agg(F.coalesce(F.avg(nonzero(value)), F.lit(0.0)).alias(out))


def temporal_var_nz(px: DataFrame, keys: Sequence[str], value: str = "value", out: str = "variance") -> DataFrame:
    """Population variance over time of the non-zero values; NULL where there is none."""
    return px.groupBy(*keys).agg(F.var_pop(nonzero(value)).alias(out))


def temporal_mean_skipna(px: DataFrame, keys: Sequence[str], values: Sequence[str] = ("value",),
                         burst: str = "burst", scene: str = "acq", min_scenes: int = 2,
                         scenes: DataFrame | None = None) -> DataFrame:
    """Mean over time skipping NaN, only for bursts with at least ``min_scenes`` scenes.

    ``scenes`` (burst, scene), if there is such a table, saves a scan of the pixels.
    """
    counts = (px if scenes is None else scenes).select(burst, scene).distinct().groupBy(burst).agg(F.count(F.lit(1)).alias("_n"))
    enough = counts.where(F.col("_n") >= min_scenes).select(burst)
    return attach(px, enough, [burst], "left_semi").groupBy(burst, *[k for k in keys if k != burst]).agg(
        *[F.avg(F.when(~F.isnan(v), F.col(v))).alias(v) for v in values])


def composite(px: DataFrame, keys: Sequence[str], how: str, value: str = "value", time: str = "acq",
              out: str = "value", max_group: int | None = None) -> DataFrame:
    """One value per pixel from many scenes: ``mean``, ``median`` or ``first`` in time.

    A median takes all values of a key into one task, as a pixel's time series is short. For keys of unbounded size give
    ``max_group``: those with more values are ranked over many tasks.
    """
    if how == "mean":
        return px.groupBy(*keys).agg(F.avg(value).alias(out))
    if how == "median" and max_group is not None:
        medians = grouped_quantiles(px, keys, value, [0.5], [out], max_group)
        empty = px.groupBy(*keys).agg(F.count(value).alias("_n")).where("_n = 0")
        return medians.unionByName(empty.select(*keys, F.lit(None).cast("double").alias(out)))
    if how == "median":
        return px.groupBy(*keys).agg(F.percentile(value, 0.5).alias(out))       # a pixel's time series is short
    if how == "first":
        first = F.min(F.when(F.col(value).isNotNull(), F.struct(time, value)))
        return px.groupBy(*keys).agg(first.getField(value).alias(out))
    raise ValueError(f"unknown composite: {how}")


def frame_temporal_job(px: DataFrame, layers: Sequence[str], stat: str = "mean",
                       keys: Sequence[str] = ("frame", *PIXEL)) -> DataFrame:
    """Temporal statistic of every layer of every frame in one aggregation."""
    def agg(layer: str) -> Column:
        if stat == "mean":
            return F.coalesce(F.avg(nonzero(layer)), F.lit(0.0)).alias(layer)
        return F.var_pop(nonzero(layer)).alias(layer)

    return px.groupBy(*keys).agg(*[agg(l) for l in layers])


def apply_mask(px: DataFrame, mask: DataFrame, layers: Sequence[str], keys: Sequence[str] = ("frame", *PIXEL),
               angle: str | None = None) -> DataFrame:
    """Layers become NULL where the mask is 0 or absent; ``angle`` is also turned into degrees."""
    keys = list(keys)
    joined = px.join(mask.select(*keys, F.col("mask").alias("_m")), keys, "left")
    keep = F.coalesce(F.col("_m"), F.lit(0)) != 0
    return joined.withColumns({l: F.when(keep, incidence_degrees(l) if l == angle else F.col(l))
                               for l in layers}).drop("_m")


def union_mask(a: DataFrame, b: DataFrame, keys: Sequence[str] = PIXEL) -> DataFrame:
    """Mask that is valid where either mask is."""
    both = a.select(*keys, "mask").unionByName(b.select(*keys, "mask"))
    return both.groupBy(*keys).agg(F.max(F.when(F.col("mask") != 0, 1).otherwise(0)).alias("mask"))


def stack_bands(layers: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("h", "v", *PIXEL),
                band: str = "band", value: str = "value") -> DataFrame:
    """Long layers to one column per band, in the given band order, with a single shuffle."""
    return layers.groupBy(*keys).agg(*[F.max(F.when(F.col(band) == b, F.col(value))).alias(b) for b in bands])


def missing_bands(layers: DataFrame, bands: Sequence[str], tile: Sequence[str] = ("h", "v"),
                  band: str = "band") -> DataFrame:
    """Bands that a tile lacks altogether."""
    have = layers.groupBy(*tile).agg(*[F.bool_or(F.col(band) == b).alias(f"_{i}") for i, b in enumerate(bands)])
    names = F.array_compact(F.array(*[F.when(~F.col(f"_{i}"), F.lit(b)) for i, b in enumerate(bands)]))
    return have.select(*tile, F.explode(names).alias("missing_band"))


def condensed_stack(stack: DataFrame, keys: Sequence[str] = ("h", "v", *PIXEL),
                    bands: Sequence[str] = STACK_BANDS) -> DataFrame:
    """Stack to the four SMALLINT bands C-RVI, L-RVI, NDVI (all x100) and tree cover."""
    c_vv, c_vh, _, l_hh, l_hv, _, ndvi_band, tc = bands
    return stack.select(*keys, condense(rvi(c_vv, c_vh)).alias("c_rvi_x100"),
                        condense(rvi(l_hh, l_hv)).alias("l_rvi_x100"),
                        condense(ndvi_band).alias("ndvi_x100"),
                        F.coalesce(F.col(tc).cast("smallint"), F.lit(-9999).cast("smallint")).alias("tc"))


def classify_stack(stack: DataFrame, model: Column, keys: Sequence[str] = ("h", "v", *PIXEL),
                   out: str = "probability") -> DataFrame:
    """Score of every pixel; a projection without shuffle."""
    return stack.select(*keys, model.alias(out))


def pixel_function(df: DataFrame, fn: Callable[..., Column], cols: Sequence[str], out: str = "value") -> DataFrame:
    """Band computed by a user function over band columns."""
    return df.withColumn(out, fn(*[F.col(c) for c in cols]))


def mosaic(px: DataFrame, keys: Sequence[str], priority: str, values: Sequence[str] = ("value",)) -> DataFrame:
    """Per cell and band the value of the source with the highest priority that has data there."""
    def top(v: str) -> Column:
        valid = F.col(v).isNotNull() & ~F.isnan(F.col(v).cast("double"))
        return F.max_by(F.when(valid, F.col(v)), F.when(valid, F.col(priority))).alias(v)

    return px.groupBy(*keys).agg(*[top(v) for v in values])


def fill_gaps_prior_year(px: DataFrame, keys: Sequence[str], year: str = "year",
                         values: Sequence[str] = ("value",)) -> DataFrame:
    """Value of the latest year with data."""
    return mosaic(px, keys, year, values)


def same_grid_check(layers: DataFrame, grid: Sequence[str] = ("epsg", "x0", "y0", "res")) -> DataFrame:
    """One row: number of distinct grids and whether all layers share one."""
    grids = layers.select(*grid).distinct().agg(F.count(F.lit(1)).alias("n_grids"))
    return grids.select("n_grids", (F.col("n_grids") == 1).alias("same_grid"))


def alos_layers(dn: DataFrame, year: int) -> DataFrame:
    """Backscatter from digital numbers and day of the year from days since launch."""
    return dn.withColumns({"hh": dn_to_gamma0("hh"), "hv": dn_to_gamma0("hv"),
                           "doy": F.coalesce(day_of_year("days", year), F.lit(-9999).cast("smallint"))})


def summary_stats(df: DataFrame, cols: Sequence[str], max_group: int = MAX_GROUP_ROWS) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each column, one row per column; none of an empty table.

    One pass gives the moments of all columns side by side, and with the counts it is known which columns have more than
    ``max_group`` values. Quartiles of those are ranked over many tasks, of the others taken in one aggregation.
    """
    names = list(dict.fromkeys(cols))
    cells = {c: F.col(c).cast("double") for c in names}
    moments = ["count", "mean", "stddev", "min", "max"]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(*[f(v).alias(m) for m, f in zip(moments, (F.count, F.avg, F.stddev_samp, F.min, F.max))]).alias(f"s{i}")
        for i, v in enumerate(cells.values())]).first()
    numbers = [[c, *row[f"s{i}"]] for i, c in enumerate(names)] if row["rows"] else []
    stats = df.sparkSession.createDataFrame(
        numbers, "col_name string, count bigint, mean double, stddev double, min double, max double")
    quarters, parts = [0.25, 0.5, 0.75], []
    out = ["q25", "q50", "q75"]

    def long(picked: list[str]) -> DataFrame:
        one = [F.struct(F.lit(c).alias("col_name"), cells[c].alias("value")) for c in picked]
        return df.select(F.inline(F.array(*one)))

    large = [n[0] for n in numbers if n[1] > max_group]
    small = [n[0] for n in numbers if n[1] <= max_group]
    if large:
        parts.append(ranked_quantiles(long(large).where("value IS NOT NULL"), ["col_name"], "value", quarters, out))
    if small or not large:
        wide = df.agg(*[F.percentile(cells[c], quarters).alias(f"p{i}") for i, c in enumerate(small or names)])
        rows = [F.struct(F.lit(c).alias("col_name"), *[F.get(F.col(f"p{i}"), F.lit(j)).alias(q) for j, q in enumerate(out)])
                for i, c in enumerate(small or names)]
        parts.append(wide.select(F.inline(F.array(*rows))))
    return stats.join(F.broadcast(reduce(DataFrame.unionByName, parts)), "col_name", "left")     # one row per column
