"""Regular grids: resampling, clipping, tiling and values at points.

All resampling goes from the source pixel to the target cells it contributes to. That is
arithmetic per row, so nearest neighbour needs no shuffle and the weighted methods need one
aggregation that combines before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundloom.functions.geodesy import reproject
from groundloom.operators.composites import stack_bands
from groundloom.scale import attach


@dataclass(frozen=True)
class Grid:
    """Upper-left corner, cell size and, if known, the number of rows and columns."""

    x0: float
    y0: float
    res: float
    n_rows: int | None = None
    n_cols: int | None = None

    def aligned(self) -> Grid:
        """The same grid with its corner moved out to multiples of the cell size."""
        return replace(self, x0=math.floor(self.x0 / self.res) * self.res,
                       y0=math.ceil(self.y0 / self.res) * self.res)

    def row(self, y: Column) -> Column:
        return F.floor((F.lit(self.y0) - y) / self.res).cast("int")

    def col(self, x: Column) -> Column:
        return F.floor((x - F.lit(self.x0)) / self.res).cast("int")

    def center_x(self, col: Column) -> Column:
        return F.lit(self.x0) + (col + 0.5) * self.res

    def center_y(self, row: Column) -> Column:
        return F.lit(self.y0) - (row + 0.5) * self.res

    def holds(self, row: Column, col: Column) -> Column:
        ok = (row >= 0) & (col >= 0)
        if self.n_rows is not None:
            ok = ok & (row < self.n_rows)
        if self.n_cols is not None:
            ok = ok & (col < self.n_cols)
        return ok


def _spread(px: DataFrame, first_row: Column, last_row: Column, first_col: Column, last_col: Column,
            dst: Grid) -> DataFrame:
    """One row per target cell in the given ranges, clipped to the target grid."""
    low_r, low_c = F.greatest(first_row, F.lit(0)), F.greatest(first_col, F.lit(0))
    top_r = last_row if dst.n_rows is None else F.least(last_row, F.lit(dst.n_rows - 1))
    top_c = last_col if dst.n_cols is None else F.least(last_col, F.lit(dst.n_cols - 1))
    ranged = px.withColumns({"_r0": low_r.cast("int"), "_r1": top_r.cast("int"),
                             "_c0": low_c.cast("int"), "_c1": top_c.cast("int")})
    return (ranged.where("_r0 <= _r1 and _c0 <= _c1")
            .withColumn("_tr", F.explode(F.sequence("_r0", "_r1")))
            .withColumn("_tc", F.explode(F.sequence("_c0", "_c1")))
            .drop("_r0", "_r1", "_c0", "_c1"))


def _target_axes(src: Grid, dst: Grid) -> tuple:
    """Source pixel coordinates (edges in pixel units) to target pixel units, per axis."""
    def rows(r: Column) -> Column:
        return (r * src.res + (dst.y0 - src.y0)) / dst.res

    def cols(c: Column) -> Column:
        return (c * src.res + (src.x0 - dst.x0)) / dst.res

    return rows, cols


def resample_nearest(px: DataFrame, src: Grid, dst: Grid) -> DataFrame:
    """Each target cell takes the source pixel that holds its centre. No shuffle."""
    rows, cols = _target_axes(src, dst)
    pr, pc = F.col("pr"), F.col("pc")
    spread = _spread(px, F.ceil(rows(pr) - 0.5), F.ceil(rows(pr + 1) - 0.5) - 1,
                     F.ceil(cols(pc) - 0.5), F.ceil(cols(pc + 1) - 0.5) - 1, dst)
    return spread.withColumns({"pr": F.col("_tr"), "pc": F.col("_tc")}).drop("_tr", "_tc")


def _weighted(spread: DataFrame, weight: Column, by: Sequence[str], value: str, least: float) -> DataFrame:
    used = spread.withColumn("_w", weight).where((F.col("_w") > least) & F.col(value).isNotNull())
    return (used.groupBy(*by, F.col("_tr").alias("pr"), F.col("_tc").alias("pc"))
            .agg((F.sum(F.col("_w") * F.col(value)) / F.sum("_w")).alias(value)))


def resample_average(px: DataFrame, src: Grid, dst: Grid, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Mean of the source pixels in each target cell, weighted by overlap."""
    rows, cols = _target_axes(src, dst)
    pr, pc = F.col("pr"), F.col("pc")
    spread = _spread(px, F.floor(rows(pr)), F.ceil(rows(pr + 1)) - 1, F.floor(cols(pc)), F.ceil(cols(pc + 1)) - 1, dst)

    def overlap(t: str, low: Column, high: Column) -> Column:
        return F.greatest(F.least(F.col(t) + 1.0, high) - F.greatest(F.col(t).cast("double"), low), F.lit(0.0))

    weight = overlap("_tr", rows(pr), rows(pr + 1)) * overlap("_tc", cols(pc), cols(pc + 1))
    return _weighted(spread, weight, by, value, 1e-9)


def resample_bilinear(px: DataFrame, src: Grid, dst: Grid, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Distance-weighted mean of the four pixels around each target centre, of those with data."""
    rows, cols = _target_axes(src, dst)
    pr, pc = F.col("pr"), F.col("pc")
    spread = _spread(px, F.ceil(rows(pr - 0.5) - 0.5), F.floor(rows(pr + 1.5) - 0.5),
                     F.ceil(cols(pc - 0.5) - 0.5), F.floor(cols(pc + 1.5) - 0.5), dst)
    # subtracted before the division, so the error does not grow with the row number
    away_r = F.abs(F.lit(src.y0) - dst.center_y(F.col("_tr")) - (pr + 0.5) * src.res) / src.res
    away_c = F.abs(dst.center_x(F.col("_tc")) - F.lit(src.x0) - (pc + 0.5) * src.res) / src.res
    weight = F.greatest(1 - away_r, F.lit(0.0)) * F.greatest(1 - away_c, F.lit(0.0))
    return _weighted(spread, weight, by, value, 1e-9)


def resample(px: DataFrame, src: Grid, dst: Grid, how: str = "nearest", by: Sequence[str] = (),
             value: str = "value") -> DataFrame:
    if how == "nearest":
        return resample_nearest(px, src, dst)
    return {"average": resample_average, "bilinear": resample_bilinear}[how](px, src, dst, by, value)


def tile_cells(tiles: DataFrame, res: float) -> DataFrame:
    """Cells of each tile with the coordinates of their centre, spread by tile row."""
    rows = tiles.withColumn("pr", F.explode(F.sequence(
        F.lit(0), ((F.col("ymax") - F.col("ymin")) / res).cast("int") - 1)))
    cells = rows.repartition("h", "v", "pr").withColumn("pc", F.explode(F.sequence(
        F.lit(0), ((F.col("xmax") - F.col("xmin")) / res).cast("int") - 1)))
    return cells.select("h", "v", "pr", "pc", (F.col("xmin") + (F.col("pc") + 0.5) * res).alias("x"),
                        (F.col("ymax") - (F.col("pr") + 0.5) * res).alias("y"))


def resample_reprojected(px: DataFrame, src: Grid, src_epsg: int, tiles: DataFrame, res: float,
                         dst_epsg: int, value: str = "value") -> DataFrame:
    """Nearest neighbour onto tiles of another coordinate system.

    The centre of every tile cell is projected back into the source and looked up by its cell.
    """
    cells = reproject(tile_cells(tiles, res), "x", "y", dst_epsg, src_epsg)
    wanted = cells.select("h", "v", "pr", "pc", src.row(F.col("y")).alias("_sr"), src.col(F.col("x")).alias("_sc"))
    source = px.select(F.col("pr").alias("_sr"), F.col("pc").alias("_sc"), value)
    return wanted.join(source, ["_sr", "_sc"], "left").drop("_sr", "_sc")


def clip_to_box(px: DataFrame, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    """Pixels whose centre lies in the box, as row and column ranges that reach the scan."""
    xmin, ymin, xmax, ymax = box
    c0, c1 = math.ceil((xmin - grid.x0) / grid.res - 0.5), math.floor((xmax - grid.x0) / grid.res - 0.5)
    r0, r1 = math.ceil((grid.y0 - ymax) / grid.res - 0.5), math.floor((grid.y0 - ymin) / grid.res - 0.5)
    return px.where(F.col("pr").between(r0, r1) & F.col("pc").between(c0, c1))


def to_tiles(px: DataFrame, cells_per_tile: int) -> DataFrame:
    """Cut a grid into square tiles: tile column ``h``, tile row ``v`` and the cell within."""
    n = F.lit(float(cells_per_tile))
    return px.withColumns({"h": F.floor(F.col("pc") / n).cast("int"), "v": F.floor(F.col("pr") / n).cast("int"),
                           "pr": F.pmod("pr", F.lit(cells_per_tile)), "pc": F.pmod("pc", F.lit(cells_per_tile))})


def pixel_dims(tiles: DataFrame, res: float) -> DataFrame:
    """Width and height of each tile in whole pixels."""
    return tiles.withColumns({"xdim": ((F.col("xmax") - F.col("xmin")) / res).cast("int"),
                              "ydim": ((F.col("ymax") - F.col("ymin")) / res).cast("int")})


def build_stack(layers: DataFrame, src: Grid, dst: Grid, cells_per_tile: int, tiles: DataFrame,
                bands: Sequence[str], how: str = "nearest", nodata: float | None = -9999.0) -> DataFrame:
    """Layers (``band, pr, pc, value``) on the target grid, cut to the active tiles, one FLOAT column per band."""
    on_grid = to_tiles(resample(layers, src, dst, how, ["band"]), cells_per_tile)
    kept = attach(on_grid, tiles.where(F.col("mask") != 0).select("h", "v"), ["h", "v"], "left_semi")
    stack = stack_bands(kept, bands)
    fill = {b: F.coalesce(F.col(b), F.lit(nodata)).cast("float") for b in bands}
    return stack.withColumns(fill) if nodata is not None else stack


def point_cells(points: DataFrame, grid: Grid, x: str = "lon", y: str = "lat") -> DataFrame:
    return points.withColumns({"pr": grid.row(F.col(y)), "pc": grid.col(F.col(x))})


def sample_at_points(points: DataFrame, stack: DataFrame, grid: Grid, bands: Sequence[str], key: str = "pid",
                     x: str = "lon", y: str = "lat") -> DataFrame:
    """Band values of the pixel under each point; NULL outside the grid."""
    cells = point_cells(points, grid, x, y)
    hits = attach(stack.select("pr", "pc", *bands), cells.select(key, "pr", "pc"), ["pr", "pc"], derived=False,
                  few_rows_each=True)
    return points.join(hits.select(key, *bands), key, "left")


def window_at_points(points: DataFrame, stack: DataFrame, grid: Grid, bands: Sequence[str], buffer: int = 1,
                     key: str = "pid", x: str = "lon", y: str = "lat") -> DataFrame:
    """Mean of each band over ``buffer + 2`` squared pixels around each point.

    The upper-left pixel is the truncated position minus ``buffer``. A window that leaves the
    grid gives NULL; missing pixels are skipped.
    """
    size = buffer + 2
    off = points.withColumns({"_ro": (F.lit(grid.y0) - F.col(y)) / grid.res - buffer,
                              "_co": (F.col(x) - F.lit(grid.x0)) / grid.res - buffer})
    inside = ((F.col("_ro") >= 0) & (F.col("_ro") + size <= grid.n_rows)
              & (F.col("_co") >= 0) & (F.col("_co") + size <= grid.n_cols))
    wanted = (off.where(inside).select(key, F.col("_ro").cast("int").alias("_r"), F.col("_co").cast("int").alias("_c"))
              .withColumn("pr", F.explode(F.sequence(F.col("_r"), F.col("_r") + (size - 1))))
              .withColumn("pc", F.explode(F.sequence(F.col("_c"), F.col("_c") + (size - 1))))
              .select(key, "pr", "pc"))
    means = (attach(stack.select("pr", "pc", *bands), wanted, ["pr", "pc"], derived=False, few_rows_each=True)
             .groupBy(key).agg(*[F.avg(b).alias(b) for b in bands]))
    return points.join(means, key, "left")


def zonal_mean(stack: DataFrame, zones: DataFrame, bands: Sequence[str], zone: str = "zone") -> DataFrame:
    """Mean of each band per zone; ``zones`` holds one row per zone and cell."""
    joined = stack.select("pr", "pc", *bands).join(zones.select(zone, "pr", "pc"), ["pr", "pc"])
    return joined.groupBy(zone).agg(*[F.avg(b).alias(b) for b in bands])


def bounds(df: DataFrame, x: str = "lon", y: str = "lat") -> DataFrame:
    """One row: bounding box and mean position."""
    return df.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"),
                  F.avg(x).alias("xmean"), F.avg(y).alias("ymean"))
