"""Neighbourhood operators on pixel tables: box sums, speckle filter, edges.

Every window runs inside square blocks of pixels that carry a copy of their neighbours' border
(the halo). One shuffle by block serves all row and column passes, and no window ever spans
more than one block, however long the image is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from pyspark.sql.window import WindowSpec

from groundloom.scale import attach
from groundloom.session import checkpointed

BLOCK = 256
BLOCK_ROW = 1024                                 # columns of an image row that are filled together
TASK_CELLS = 1_000_000


def densify(px: DataFrame, by: Sequence[str] = (), values: Sequence[str] = ("value",)) -> DataFrame:
    """Add a NULL row for every cell missing from the image rectangle of each ``by`` group.

    Cells are dealt by image row and by ``BLOCK_ROW`` columns of it, over as many tasks as there are millions of cells. A mark
    for such a piece of a row becomes its blank cells only in the task that joins them with the pixels.
    """
    by = list(by)
    types, n = dict(px.dtypes), F.lit(float(BLOCK_ROW))
    spans = checkpointed(px.groupBy(*by).agg(F.max("pr").alias("_r1"), F.max("pc").alias("_c1")))
    cells = spans.agg(F.sum((F.col("_r1") + 1.0) * (F.col("_c1") + 1.0))).first()[0] or 0
    tasks = max(int(px.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(cells / TASK_CELLS))
    # row numbers come from numbers of parts, so that no task makes all marks of a large image
    parts = spans.select(*by, "_r1", "_c1", F.explode(F.sequence(F.lit(0), F.floor(F.col("_r1") / n))).alias("_part"))
    rows = (parts.repartition(tasks, *by, "_part")
            .select(*by, "_c1", F.explode(F.sequence(F.col("_part") * BLOCK_ROW, F.least(F.col("_part") * BLOCK_ROW + (BLOCK_ROW - 1), "_r1")))
                    .alias("pr")))
    marks = rows.select(*by, F.col("pr").cast(types["pr"]).alias("pr"), F.explode(F.sequence(F.lit(0), F.floor(F.col("_c1") / n))).alias("_piece"),
                        F.col("_c1").cast("bigint").alias("_c1"))
    marks = marks.withColumns({"pc": F.lit(None).cast(types["pc"]), **{v: F.lit(None).cast(types[v]) for v in values}})
    pixels = px.select(*by, "pr", "pc", *values, F.floor(F.col("pc") / n).alias("_piece"), F.lit(None).cast("bigint").alias("_c1"))
    dealt = pixels.unionByName(marks).repartition(tasks, *by, "pr", "_piece")
    blank = F.sequence(F.col("_piece") * BLOCK_ROW, F.least(F.col("_piece") * BLOCK_ROW + (BLOCK_ROW - 1), F.col("_c1")))
    own = F.array(F.col("pc").cast("bigint"))
    cell = dealt.select(*by, "pr", "_piece", F.explode(F.when(F.col("_c1").isNull(), own).otherwise(blank)).alias("pc"), *values)
    full = cell.groupBy(*by, "pr", "_piece", "pc").agg(*[F.max(v).alias(v) for v in values])
    return full.select(*by, "pr", F.col("pc").cast(types["pc"]).alias("pc"), *values)


def _blocks(px: DataFrame, halo: int, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    size = max(BLOCK, 4 * halo)

    def touched(c: str) -> Column:
        first = F.greatest(F.floor((F.col(c) - halo) / F.lit(float(size))), F.lit(0))
        return F.explode(F.sequence(first, F.floor((F.col(c) + halo) / F.lit(float(size)))))

    block = [*by, "_br", "_bc"]
    spread = px.withColumn("_br", touched("pr")).withColumn("_bc", touched("pc"))
    home = ((F.col("_br") == F.floor(F.col("pr") / F.lit(float(size))))
            & (F.col("_bc") == F.floor(F.col("pc") / F.lit(float(size)))))
    return spread.withColumn("_home", home).repartition(*block), block


def _home(df: DataFrame) -> DataFrame:
    return df.where("_home").drop("_br", "_bc", "_home")


def _box_sums(px: DataFrame, k: int, value: str, by: Sequence[str]) -> DataFrame:
    low, high = -(k // 2), k - 1 - k // 2
    rows = px.withColumn("_v", F.col(value).cast("double"))
    blocked, block = _blocks(rows, k // 2, by)
    schema = StructType([*px.schema.fields, StructField("box_sum", DoubleType()), StructField("box_sum_sq", DoubleType()),
                         StructField("box_count", LongType())])
    names = px.columns

    def slid(image: np.ndarray) -> np.ndarray:
        """Sums over the window, one axis after the other, by adding the image shifted to each place of the window."""
        for axis in (1, 0):
            n, total = image.shape[axis], np.zeros_like(image)
            for step in range(low, high + 1):
                to = slice(max(0, -step), max(min(n, n - step), 0))
                of = slice(max(0, step), max(min(n, n + step), 0))
                at = (slice(None), to) if axis else to
                total[at] += image[(slice(None), of) if axis else of]
            image = total
        return image

    def sums(cells: pa.Table) -> pa.Table:
        r, c = (cells[x].to_numpy().astype("int64") for x in ("pr", "pc"))
        r, c = r - r.min(), c - c.min()
        present = cells["_v"].is_valid().to_numpy()
        v = cells["_v"].fill_null(0.0).to_numpy()
        home = cells["_home"]
        hr, hc = r[home.to_numpy()], c[home.to_numpy()]
        kept = cells.filter(home).select(names)
        for name, part in (("box_sum", v), ("box_sum_sq", v * v), ("box_count", present.astype("int64"))):
            image = np.zeros((r.max() + 1, c.max() + 1), part.dtype)        # at most a block with its border
            np.add.at(image, (r, c), part)
            kept = kept.append_column(name, pa.array(slid(image)[hr, hc]))
        return kept

    return blocked.groupBy(*block).applyInArrow(sums, schema)


def box_filter(px: DataFrame, k: int, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Sum, sum of squares and count of data over a k x k window cut off at the image border, for the cells that have a row.

    No data is NULL. A cell without a row counts as no data, so :func:`densify` is needed only where absent cells shall be
    returned too. A block of cells with its border is one numpy array, so wide windows cost little more than narrow ones.
    """
    return _box_sums(px, k, value, by)


def enhanced_lee(px: DataFrame, win: int = 5, looks: float = 1, value: str = "value", out: str = "filtered",
                 by: Sequence[str] = ()) -> DataFrame:
    """Enhanced Lee speckle filter.

    A missing pixel with data in its window is filled; only an empty window stays NULL. With
    ``by`` each tile is filtered alone, without it windows run across tile borders.
    """
    clean = px.withColumn(value, F.when(~F.isnan(F.col(value).cast("double")), F.col(value)))
    sums = _box_sums(clean, win, value, by)

    def settled(c: str) -> Column:
        return F.when(F.abs(c) <= 1e-8, 0.0).otherwise(F.col(c))

    n = F.col("box_count")
    sums = sums.withColumns({"_mean": F.try_divide(settled("box_sum"), n),
                             "_msq": F.try_divide(settled("box_sum_sq"), n)})
    mean, msq = F.col("_mean"), F.col("_msq")
    spread = F.abs(msq - mean * mean) > 1e-8 + 1e-5 * mean * mean
    sums = sums.withColumn("_ci", F.try_divide(F.when(spread, F.sqrt(msq - mean * mean)).otherwise(0.0), mean))
    cu, cmax = 0.523 / math.sqrt(looks), math.sqrt(1 + 2 / looks)
    ci = F.col("_ci")
    weight = (F.when(ci <= cu, 1.0).when(ci < cmax, F.exp(-(ci - cu) / F.nullif(cmax - ci, F.lit(0.0))))
              .otherwise(0.0))
    img = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    return (sums.withColumn("_w", weight)
            .withColumn(out, F.when(n > 0, mean * F.col("_w") + img * (1 - F.col("_w"))))
            .drop("box_sum", "box_sum_sq", "box_count", "_mean", "_msq", "_ci", "_w"))


def neighbor_lookup(px: DataFrame, col: str = "mask", default: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Values of the four rook neighbours; cells outside the image get ``default``."""
    blocked, block = _blocks(px, 1, by)
    along = Window.partitionBy(*block, "pr").orderBy("pc")
    across = Window.partitionBy(*block, "pc").orderBy("pr")

    def at(window, step: int) -> Column:
        return F.coalesce(F.max(col).over(window.rangeBetween(step, step)), F.lit(default))

    return _home(blocked.withColumns({"left": at(along, -1), "right": at(along, 1),
                                      "up": at(across, -1), "down": at(across, 1)}))


def inner_edges(px: DataFrame, mask: str = "mask", by: Sequence[str] = ()) -> DataFrame:
    """Data pixels with at least one rook neighbour without data; the border counts as data."""
    seen = neighbor_lookup(px.select(*by, "pr", "pc", F.when(F.col(mask) != 0, 1).otherwise(0).alias("mask")),
                           "mask", 1, by)
    return (seen.where((F.col("mask") == 1) & (F.least("left", "right", "up", "down") == 0))
            .select(*by, "pr", "pc"))


def zero_distance(px: DataFrame, depth: int, mask: str = "mask", by: Sequence[str] = ()) -> DataFrame:
    """L1 distance of each pixel to the nearest no-data pixel; exact up to ``depth``, else NULL."""
    blocked, block = _blocks(px, depth, by)
    def upto(line: str, order: Column) -> WindowSpec:
        # running frames only, once in each direction: a frame to the end of the line would be read again for every row
        return Window.partitionBy(*block, line).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    zero_at = F.when(F.col(mask) == 0, F.col("pc"))
    near = (blocked.withColumn("_l", F.last(zero_at, ignorenulls=True).over(upto("pr", F.asc("pc"))))
            .withColumn("_r", F.last(zero_at, ignorenulls=True).over(upto("pr", F.desc("pc"))))
            .withColumn("_g", F.least(F.col("pc") - F.col("_l"), F.col("_r") - F.col("pc"))))
    dist = F.least(F.min(F.col("_g") - F.col("pr")).over(upto("pc", F.asc("pr"))) + F.col("pr"),
                   F.min(F.col("_g") + F.col("pr")).over(upto("pc", F.desc("pr"))) - F.col("pr"))
    far = near.withColumn("distance", dist)
    return (_home(far).drop("_l", "_r", "_g")
            .withColumn("distance", F.when(F.col("distance") <= depth, F.col("distance"))))


def peel_edges(px: DataFrame, depth: int = 1, value: str = "value", mask: str = "mask",
               by: Sequence[str] = ()) -> DataFrame:
    """Remove ``depth`` layers of inner edge pixels.

    A pixel goes in step k exactly if its L1 distance to the nearest no-data pixel is k, so one
    distance transform replaces the repeated peeling.
    """
    near = zero_distance(px, depth, mask, by)
    return near.withColumn(value, F.when(F.col("distance").isNull(), F.col(value))).drop("distance")


def corner_pixels(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """The four corners of each image from its edge pixels, with the tie rules of a row-major scan."""
    r, c = F.col("pr"), F.col("pc")
    kind = edges.schema["pr"].dataType

    def order(a: Column, b: Column) -> Column:
        return F.shiftleft(a.cast("bigint"), 32) + b.cast("bigint") + (1 << 31)     # one number: no aggregate over structs

    least = {"top_first": (r, c), "top_last": (r, -c), "left_first": (c, r), "left_last": (c, -r)}
    most = {"bottom_first": (r, -c), "bottom_last": (r, c), "right_first": (c, -r), "right_last": (c, r)}
    ext = edges.groupBy(*by).agg(*[F.min(order(*ab)).alias(name) for name, ab in least.items()],
                                 *[F.max(order(*ab)).alias(name) for name, ab in most.items()])
    ext = ext.withColumns({name: F.struct(F.shiftright(name, 32).cast(kind).alias("a"),
                                          (F.col(name).bitwiseAND(F.lit(0xFFFFFFFF)) - (1 << 31)).cast(kind).alias("b"))
                           for name in (*least, *most)})
    leaning = F.col("left_first.b") > -F.col("right_first.b")    # the top pixel is the upper left one

    def corner(name: str, when_leaning: tuple[Column, Column], otherwise: tuple[Column, Column]) -> list[Column]:
        return [F.when(leaning, a).otherwise(b).alias(f"{axis}_{name}")
                for axis, a, b in zip(("row", "col"), when_leaning, otherwise)]

    def by_row(name: str, last_negated: bool) -> tuple[Column, Column]:
        b = F.col(f"{name}.b")
        return F.col(f"{name}.a"), -b if last_negated else b

    def by_col(name: str, negated: bool) -> tuple[Column, Column]:
        b = F.col(f"{name}.b")
        return -b if negated else b, F.col(f"{name}.a")

    return ext.select(
        *by,
        *corner("ul", by_row("top_first", False), by_col("left_first", False)),
        *corner("ur", by_col("right_first", True), by_row("top_last", True)),
        *corner("lr", by_row("bottom_last", False), by_col("right_last", False)),
        *corner("ll", by_col("left_last", True), by_row("bottom_first", True)))


def _mark_sides(edges: DataFrame, left_right: bool, by: Sequence[str]) -> DataFrame:
    corners = corner_pixels(edges, by)
    # one row per image: small ones are broadcast at run time, an image with very many edge pixels is split
    joined = edges.join(corners, list(by)) if by else edges.join(F.broadcast(corners))
    r, c = F.col("pr"), F.col("pc")

    def strictly(x: Column, a: str, b: str) -> Column:
        return (x > F.least(a, b)) & (x < F.greatest(a, b))

    def within(x: Column, a: str, b: str) -> Column:
        return (x >= F.least(a, b)) & (x <= F.greatest(a, b))

    if left_right:
        side = ((strictly(r, "row_ur", "row_lr") & within(c, "col_ur", "col_lr"))
                | (strictly(r, "row_ul", "row_ll") & within(c, "col_ul", "col_ll")))
    else:
        side = ((within(r, "row_ul", "row_ur") & strictly(c, "col_ul", "col_ur"))
                | (within(r, "row_ll", "row_lr") & strictly(c, "col_ll", "col_lr")))
    corner = F.lit(False)
    for k in ("ul", "ur", "lr", "ll"):
        corner = corner | ((r == F.col(f"row_{k}")) & (c == F.col(f"col_{k}")))
    return joined.select(*edges.columns, F.when(corner, 2).when(side, 1).otherwise(0).alias("side"))


def side_edges(px: DataFrame, left_right: bool = True, mask: str = "mask", by: Sequence[str] = ()) -> DataFrame:
    """Edge pixels on the left and right (or top and bottom) sides: 1, corners 2."""
    return _mark_sides(inner_edges(px, mask, by), left_right, by).where("side > 0")


def peel_sides(px: DataFrame, depth: int, left_right: bool = True, mask: str = "mask",
               by: Sequence[str] = ()) -> DataFrame:
    """Pixels removed by ``depth`` steps of side peeling, with 1 for an edge and 2 for a corner.

    Corners move with every step, so the steps have to follow each other. Only the edge is
    carried along: after a step it consists of the edge pixels that stayed and of the data
    neighbours of those that went. The pixels that can become an edge at all lie within
    ``depth`` of a no-data pixel; they are found and written once. A step is one written table and counts nothing.
    """
    by = list(by)
    cell = [*by, "pr", "pc"]
    near = zero_distance(px.select(*cell, F.col(mask).alias("mask")), depth, "mask", by)
    band = checkpointed(near.where((F.col("mask") != 0) & F.col("distance").isNotNull()).select(*cell, "distance"))
    edge = band.where("distance = 1").select(*cell)
    gone = None
    for k in range(1, depth + 1):
        marked = checkpointed(_mark_sides(edge, left_right, by))
        step = marked.where("side > 0")
        gone = step if gone is None else gone.unionByName(step)
        if k % 25 == 0:
            gone = checkpointed(gone)
        stay = marked.where("side = 0").select(*cell)
        around = step.select(*by, F.explode(F.array(*[
            F.struct((F.col("pr") + dr).alias("pr"), (F.col("pc") + dc).alias("pc"))
            for dr, dc in ((0, 1), (0, -1), (1, 0), (-1, 0))])).alias("_n")).select(*by, "_n.*").distinct()
        reachable = band.where(F.col("distance") <= k + 1).select(*cell)
        fresh = reachable.join(around, cell, "left_semi")
        old = gone.select(*cell).unionByName(stay)
        edge = fresh.join(old, cell, "left_anti").unionByName(stay)
    return gone


def remove_edges(px: DataFrame, layers: Sequence[str], depth: int, deciding: str, side: str = "lr",
                 angle: str | None = None, by: Sequence[str] = ("frame",), extra: str | None = None) -> DataFrame:
    """Peel the image sides and clear all layers outside the mask of the deciding layer.

    ``extra`` names a layer whose data extend the mask before peeling.
    """
    cell = [*by, "pr", "pc"]
    valid = F.col(deciding).isNotNull()
    grown = valid | F.col(extra).isNotNull() if extra else valid
    masked = px.withColumn("mask", grown.cast("int"))
    if side == "all":
        near = zero_distance(masked.select(*cell, "mask"), depth, "mask", by)
        gone = near.where((F.col("mask") != 0) & F.col("distance").isNotNull()).select(*cell)
    else:
        gone = peel_sides(masked, depth, side == "lr", "mask", by).select(*cell)
    flagged = attach(px, gone.withColumn("_gone", F.lit(1)), cell, "left", few_rows_each=True)
    keep = F.col("_gone").isNull() & valid
    values = {l: F.when(keep, F.degrees(l) if l == angle else F.col(l)) for l in layers if l != deciding}
    values[deciding] = F.when(keep, F.col(deciding))
    return flagged.withColumns(values).drop("_gone")


