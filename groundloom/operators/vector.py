"""Polygons as vertex arrays: predicates, tilings, coverings and footprint algebra.

A polygon is ``ring``, an array of ``struct<x, y>``. A polygon with holes has its outer ring and its holes in one
array, each closed by its first vertex and followed by a NULL; a point is inside if an odd number of edges lies to its
right, so holes need no treatment of their own. Predicates are exact and run per row.
Areas, unions and differences use coverings: for each row of a common cell grid the runs of
cells whose centre lies inside, as (y, x0, x1).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from groundloom.functions.indices import as_col
from groundloom.functions.names import geo_tile_name
from groundloom.scale import attach, dealt, running_totals, shuffled_join
from groundloom.session import checkpointed

RUN_BLOCK = 256
CROSSINGS = 1_000_000                            # of edges with grid rows that a task holds at once
TASK_RUNS = 300_000
TASK_POLYGONS = 20_000


def points_from_lonlat(df: DataFrame, x: str = "lon", y: str = "lat", out: str = "point") -> DataFrame:
    return df.withColumn(out, F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))


def _vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(xmin: Column | str, ymin: Column | str, xmax: Column | str, ymax: Column | str) -> Column:
    xmin, ymin, xmax, ymax = map(as_col, (xmin, ymin, xmax, ymax))
    return F.array(_vertex(xmin, ymax), _vertex(xmax, ymax), _vertex(xmax, ymin), _vertex(xmin, ymin))


def ring_of(points: Sequence[tuple[float, float]]) -> Column:
    return F.array(*[_vertex(F.lit(float(x)), F.lit(float(y))) for x, y in points])


def edges(ring: Column) -> Column:
    """Edges of a polygon; those to and from a NULL between rings have NULL ends and meet no condition."""
    n = F.size(ring)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.element_at(ring, i)["x"].alias("x1"), F.element_at(ring, i)["y"].alias("y1"),
        F.element_at(ring, F.pmod(i, n) + 1)["x"].alias("x2"), F.element_at(ring, F.pmod(i, n) + 1)["y"].alias("y2")))


def ring_area(ring: Column) -> Column:
    """Area by the cross products of the edges; holes run against their outer ring and count less."""
    products = F.transform(edges(ring), lambda e: F.coalesce(e["x1"] * e["y2"] - e["x2"] * e["y1"], F.lit(0.0)))
    return F.abs(F.aggregate(products, F.lit(0.0), lambda s, p: s + p)) / 2


def ring_bounds(ring: Column) -> dict[str, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def _crosses_line(e: Column, y: Column) -> Column:
    return (e["y1"] > y) != (e["y2"] > y)


def _x_at(e: Column, y: Column) -> Column:
    return e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether an odd number of edges crosses the ray from the point to the right."""
    hits = F.filter(edges(ring), lambda e: _crosses_line(e, y) & (x < _x_at(e, y)))
    return F.pmod(F.size(hits), F.lit(2)) == 1


def _segments_meet(a: Column, b: Column) -> Column:
    def turn(s: Column, x: Column, y: Column) -> Column:
        return (s["x2"] - s["x1"]) * (y - s["y1"]) - (s["y2"] - s["y1"]) * (x - s["x1"])

    def apart(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
        return (F.greatest(lo1, hi1) < F.least(lo2, hi2)) | (F.greatest(lo2, hi2) < F.least(lo1, hi1))

    disjoint = apart(a["x1"], a["x2"], b["x1"], b["x2"]) | apart(a["y1"], a["y2"], b["y1"], b["y2"])
    return (~disjoint & (F.signum(turn(a, b["x1"], b["y1"])) * F.signum(turn(a, b["x2"], b["y2"])) <= 0)
            & (F.signum(turn(b, a["x1"], a["y1"])) * F.signum(turn(b, a["x2"], a["y2"])) <= 0))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for the row, also where it is used for every edge."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _edges_near(ring: Column, other: Column) -> Column:
    """The edges whose box meets the box of another polygon."""
    box = F.struct(*[c.alias(n) for n, c in ring_bounds(other).items()])
    return _once(box, lambda b: F.filter(edges(ring), lambda e: (
        (F.greatest(e["x1"], e["x2"]) >= b["xmin"]) & (F.least(e["x1"], e["x2"]) <= b["xmax"])
        & (F.greatest(e["y1"], e["y2"]) >= b["ymin"]) & (F.least(e["y1"], e["y2"]) <= b["ymax"]) & e["x1"].isNotNull()
        & e["x2"].isNotNull())))


def intersects(a: Column | str, b: Column | str) -> Column:
    """Whether two simple polygons share at least one point; a common border counts.

    Of polygons with many vertices only edges near the other one are compared, so the work is about the number of edges.
    """
    a, b = as_col(a), as_col(b)
    near = _once(_edges_near(b, a), lambda eb: F.exists(_edges_near(a, b), lambda s: F.exists(eb, lambda t: _segments_meet(s, t))))
    every = F.exists(edges(a), lambda s: F.exists(edges(b), lambda t: _segments_meet(s, t)))
    touch = F.when(F.size(a) * F.size(b) > 64, near).otherwise(every)
    return (F.coalesce(touch, F.lit(False)) | point_in_ring(a[0]["x"], a[0]["y"], b)
            | point_in_ring(b[0]["x"], b[0]["y"], a))


def _cells(df: DataFrame, ring: str, cell: float, tag: str) -> DataFrame:
    box = {f"_{tag}{k}": v for k, v in ring_bounds(F.col(ring)).items()}

    def span(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(f"_{tag}{low}") / cell), F.floor(F.col(f"_{tag}{high}") / cell)))

    return (df.withColumns(box).withColumn("_cx", span("xmin", "xmax")).withColumn("_cy", span("ymin", "ymax")))


def spatial_join(a: DataFrame, b: DataFrame, cell: float, a_ring: str = "ring", b_ring: str = "other_ring") -> DataFrame:
    """All pairs of intersecting polygons, each once.

    Both sides are keyed by the coarse cells of their bounding box. A pair is tested only in
    the cell of the lower-left corner of the common box, so it needs no duplicate removal.
    """
    left, right = _cells(dealt(a, F.lit(1), TASK_POLYGONS), a_ring, cell, "a"), _cells(b, b_ring, cell, "b")
    pairs = attach(left, right, ["_cx", "_cy"], derived=False)
    overlap = ((F.col("_axmin") <= F.col("_bxmax")) & (F.col("_bxmin") <= F.col("_axmax"))
               & (F.col("_aymin") <= F.col("_bymax")) & (F.col("_bymin") <= F.col("_aymax")))
    once = ((F.col("_cx") == F.floor(F.greatest("_axmin", "_bxmin") / cell))
            & (F.col("_cy") == F.floor(F.greatest("_aymin", "_bymin") / cell)))
    return (pairs.where(overlap & once).where(intersects(a_ring, b_ring))
            .select(*a.columns, *[c for c in b.columns if c not in a.columns]))


def intersects_aoi(df: DataFrame, aoi: DataFrame, key: str, cell: float, ring: str = "ring") -> DataFrame:
    """Rows whose polygon meets any polygon of the area of interest."""
    hit = spatial_join(df.select(key, ring), aoi.select(F.col(ring).alias("other_ring")), cell, ring)
    return df.join(hit.select(key).distinct(), key, "left_semi")


def grid_frame(bounds: tuple[float, float, float, float], size: float, centered: bool = True,
               x_offset: float = 0, y_offset: float = 0) -> tuple[float, float, int, int]:
    """Left edge, top edge and number of columns and rows of the tile grid over a bounding box."""
    xmin, ymin, xmax, ymax = bounds
    if not centered:
        left, bottom = math.floor(xmin / size) * size, math.floor(ymin / size) * size
        right, top = math.ceil(xmax / size) * size, math.ceil(ymax / size) * size
        return left, top, round((right - left) / size), round((top - bottom) / size)
    nx, ny = math.ceil((xmax - xmin) / size), math.ceil((ymax - ymin) / size)

    def snapped(low: float, high: float, n: int) -> float:
        return math.floor(((low + high) / 2 - n / 2 * size) / 100) * 100      # corners at multiples of 100

    left, bottom = snapped(xmin, xmax, nx) + x_offset, snapped(ymin, ymax, ny) + y_offset
    return left, bottom + ny * size, nx, ny


def _bounds_of(polys: DataFrame, ring: str) -> tuple[float, float, float, float]:
    box = polys.select(*[v.alias(k) for k, v in ring_bounds(F.col(ring)).items()])
    row = box.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    return tuple(float(v) for v in row)


def _tile_grid(polys: DataFrame, left: float, top: float, nx: int, ny: int, size: float, ring: str) -> DataFrame:
    """Tiles of the grid with ``mask`` 1 where a polygon is met; ids come from a distributed range."""
    ids = polys.sparkSession.range(nx * ny)
    tiles = ids.select(F.floor(F.col("id") / F.lit(float(ny))).cast("int").alias("h"),
                       F.pmod("id", F.lit(ny)).cast("int").alias("v"))
    tiles = tiles.withColumns({"xmin": F.lit(float(left)) + F.col("h") * float(size),
                               "ymax": F.lit(float(top)) - F.col("v") * float(size)})
    tiles = tiles.withColumns({"xmax": F.col("xmin") + float(size), "ymin": F.col("ymax") - float(size)})
    boxed = tiles.withColumn("ring", box_ring("xmin", "ymin", "xmax", "ymax"))
    hit = (spatial_join(polys.select(F.col(ring).alias("other_ring")), boxed.select("h", "v", "ring"), size,
                        "other_ring", "ring").select("h", "v").distinct().withColumn("_hit", F.lit(1)))
    return (boxed.join(hit, ["h", "v"], "left").withColumn("mask", F.coalesce("_hit", F.lit(0)))
            .select("h", "v", "mask", "xmin", "ymin", "xmax", "ymax", "ring"))


def make_tiles(aoi: DataFrame, size: float, centered: bool = True, x_offset: float = 0, y_offset: float = 0,
               epsg: int | None = None, ring: str = "ring") -> DataFrame:
    """Square tiles over the area; ``h`` counts from the left, ``v`` from the top, ``mask`` = meets the area."""
    left, top, nx, ny = grid_frame(_bounds_of(aoi, ring), size, centered, x_offset, y_offset)
    return _tile_grid(aoi, left, top, nx, ny, size, ring).withColumn("epsg", F.lit(epsg).cast("int"))


def rows_from_area(polys: DataFrame, size: float, keys: Sequence[str], ring: str = "ring") -> DataFrame:
    """One row per tile of a fixed grid that the bounding box of an area touches."""
    cells = _cells(polys.select(*keys, ring), ring, size, "b")
    return cells.select(*keys, F.col("_cx").alias("tx"), F.col("_cy").alias("ty"))


def degree_tiles(aoi: DataFrame, ring: str = "ring") -> DataFrame:
    """Names of the 1-degree tiles that meet the area, from their upper-left corner."""
    xmin, ymin, xmax, ymax = _bounds_of(aoi, ring)
    left, top = math.floor(xmin), math.ceil(ymax)
    tiles = _tile_grid(aoi, left, top, math.ceil(xmax) - left, top - math.floor(ymin), 1.0, ring)
    return tiles.where("mask = 1").select(geo_tile_name("ymax", "xmin").alias("tile"))


def tile_burst_map(tiles: DataFrame, bursts: DataFrame, burst: str = "burst_id", cell: float | None = None) -> DataFrame:
    """Every tile with each burst that meets it, one row per pair; a tile that none meets has one row with NULL."""
    if cell is None:
        first = tiles.select(F.col("xmax") - F.col("xmin")).first()
        cell = float(first[0])
    pairs = spatial_join(bursts.select(burst, F.col("ring").alias("other_ring")), tiles.select("h", "v", "ring"),
                         cell, "other_ring", "ring")
    return tiles.select("h", "v", "mask").join(pairs.select("h", "v", burst).distinct(), ["h", "v"], "left")


# ---- coverings -----------------------------------------------------------------------------

def _row_from(y: np.ndarray, size: float) -> np.ndarray:
    """The first grid row whose centre is not below ``y``, exact also where the division rounds."""
    near = np.ceil(y / size - 0.5)
    near -= (near - 0.5) * size >= y
    return near + ((near + 0.5) * size < y)


class RingEdges:
    """The edges of a batch of polygons that cross the centre line of any grid row, in the order of the polygons."""

    def __init__(self, rings: pa.Array, size: float):
        count = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = rings.flatten()
        x, y = (pc.struct_field(flat, n).to_numpy(zero_copy_only=False).astype(float) for n in ("x", "y"))
        poly = np.repeat(np.arange(len(count)), count)
        stop = np.cumsum(count)
        after = np.arange(1, len(x) + 1)
        ends = count > 0
        after[stop[ends] - 1] = (stop - count)[ends]                # the last vertex is joined with the first
        low, high = np.minimum(y, y[after]), np.maximum(y, y[after])
        first, last = _row_from(low, size), _row_from(high, size) - 1
        kept = np.flatnonzero((first <= last) & ~np.isnan(x + x[after]))          # NULL between rings has no number
        self.size, self.poly = size, poly[kept]
        self.first, self.last = first[kept].astype(np.int64), last[kept].astype(np.int64)
        self.x, self.y, self.dx, self.dy = x[kept], y[kept], (x[after] - x)[kept], (y[after] - y)[kept]

    def runs(self, part: slice, low: int | None = None, high: int | None = None) -> tuple[np.ndarray, ...]:
        """(polygon, y, x0, x1) of the runs that some edges bound, in rows ``low`` to ``high``: sorted crossings in pairs."""
        first, last = self.first[part], self.last[part]
        if low is not None:
            first, last = np.maximum(first, low), np.minimum(last, high)
        rows = np.maximum(last - first + 1, 0)
        of = np.repeat(np.arange(len(rows)), rows)
        y = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows) + first[of]
        x = self.x[part][of] + self.dx[part][of] * ((y + 0.5) * self.size - self.y[part][of]) / self.dy[part][of]
        poly = self.poly[part][of]
        order = np.lexsort((x, y, poly))
        poly, y, cell = poly[order], y[order], np.ceil(x[order] / self.size - 0.5).astype(np.int64)
        place = np.arange(len(order))
        new = np.ones(len(order), bool)
        new[1:] = (poly[1:] != poly[:-1]) | (y[1:] != y[:-1])
        paired = (place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0
        lead = np.flatnonzero(paired[:-1] & ~new[1:])               # a ring that is not closed may leave one over
        lead = lead[cell[lead] < cell[lead + 1]]
        return poly[lead], y[lead], cell[lead], cell[lead + 1] - 1

    def pieces(self, limit: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Runs of some polygons at a time, about ``limit`` crossings; a larger polygon goes band by band."""
        upto = np.cumsum(self.last - self.first + 1)
        heads = np.flatnonzero(np.append(True, self.poly[1:] != self.poly[:-1])) if len(upto) else np.zeros(0, np.int64)
        stops = np.append(heads[1:], len(upto))
        i = 0
        while i < len(heads):
            done = upto[heads[i] - 1] if heads[i] else 0
            j = max(int(np.searchsorted(upto[stops - 1], done + limit, "right")), i + 1)
            part = slice(heads[i], stops[j - 1])
            total = int(upto[stops[j - 1] - 1] - done)
            low, high = int(self.first[part].min()), int(self.last[part].max())
            step = max((high - low + 1) * limit // total, 1) if total > limit else high - low + 1
            for start in range(low, high + 1, step):
                yield self.runs(part, start, start + step - 1)
            i = j


def cover_runs(polys: DataFrame, size: float, keys: Sequence[str], ring: str = "ring") -> DataFrame:
    """Runs of cells with their centre inside the polygon, per grid row; only the polygons are dealt over the tasks, by their height.

    Scan conversion by edges: each edge gives its crossing with the centre line of every grid row that it spans. Sorted by polygon,
    row and place, the crossings follow one another in pairs, and each pair bounds a run. No ring is copied; the work
    is the number of edges times the rows they span, in numpy over whole Arrow batches, ``CROSSINGS`` at a time.
    """
    box = ring_bounds(F.col("_ring"))
    source = dealt(polys.select(*keys, F.col(ring).alias("_ring")), F.coalesce((box["ymax"] - box["ymin"]) / float(size), F.lit(0.0)) + 1,
                   TASK_RUNS)
    names, limit = [*keys, "y", "x0", "x1"], CROSSINGS
    schema = StructType([*source.schema.fields[:-1], *[StructField(n, LongType()) for n in names[-3:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for poly, y, x0, x1 in RingEdges(batch.column(batch.num_columns - 1), float(size)).pieces(limit):
                at = pa.array(poly)
                yield pa.RecordBatch.from_arrays([*[c.take(at) for c in batch.columns[:-1]], *map(pa.array, (y, x0, x1))], names)

    return source.mapInArrow(run, schema)


def cells_of(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return runs.select(*keys, F.explode(F.sequence("x0", "x1")).alias("cx"), F.col("y").alias("cy"))


def cover_cells(polys: DataFrame, size: float, keys: Sequence[str], ring: str = "ring") -> DataFrame:
    """Grid cells whose centre lies in the polygon."""
    return cells_of(cover_runs(polys, size, keys, ring), keys)


def _in_blocks(runs: DataFrame) -> DataFrame:
    """Runs cut at block borders, so that work on a grid row splits along x too."""
    n = float(RUN_BLOCK)
    split = runs.withColumn("xb", F.explode(F.sequence(F.floor(F.col("x0") / n), F.floor(F.col("x1") / n))))
    return split.withColumns({"x0": F.greatest("x0", F.col("xb") * RUN_BLOCK),
                              "x1": F.least("x1", F.col("xb") * RUN_BLOCK + (RUN_BLOCK - 1))})


def _segments(runs: DataFrame, keys: Sequence[str], owner: Column) -> DataFrame:
    """Pieces between run ends with the number of covering runs and the XOR of their owners.

    Ends at the same place are summed before the shuffle, so a window holds at most one row per
    cell border of its block, however many polygons lie on top of each other.
    """
    ends = F.array(F.struct(F.col("x0").alias("x"), F.lit(1).alias("d")),
                   F.struct((F.col("x1") + 1).alias("x"), F.lit(-1).alias("d")))
    at = [*keys, "y", "xb"]
    events = (_in_blocks(runs).withColumn("_o", owner).withColumn("_e", F.explode(ends))
              .groupBy(*at, F.col("_e.x").alias("x")).agg(F.sum("_e.d").alias("_d"), F.bit_xor("_o").alias("_x")))
    order = Window.partitionBy(*at).orderBy("x")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (events.select(*at, F.col("x").alias("x0"), (F.lead("x").over(order) - 1).alias("x1"),
                          F.sum("_d").over(upto).alias("n"), F.bit_xor("_x").over(upto).alias("owner"))
            .where("x1 >= x0 and n > 0"))


def dissolve(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Union of coverings per key as disjoint runs."""
    return _segments(runs, keys, F.lit(0).cast("bigint")).select(*keys, "y", "x0", "x1")


def covered_area(runs: DataFrame, size: float, keys: Sequence[str]) -> DataFrame:
    """Area of disjoint runs per key."""
    return runs.groupBy(*keys).agg((F.sum(F.col("x1") - F.col("x0") + 1) * float(size) ** 2).alias("area"))


def overlap_ratio(runs: DataFrame, key: str) -> DataFrame:
    """For all pairs of overlapping frames the share of ``key`` that ``other`` covers.

    ``runs`` must be disjoint per frame (see :func:`dissolve`).
    """
    cut = _in_blocks(runs)
    other = cut.select(F.col(key).alias("other"), "y", "xb", F.col("x0").alias("_u0"), F.col("x1").alias("_u1"))
    length = F.least("x1", "_u1") - F.greatest("x0", "_u0") + 1
    shared = (cut.join(other, ["y", "xb"]).where((F.col("x0") <= F.col("_u1")) & (F.col("_u0") <= F.col("x1")))
              .groupBy(key, "other").agg(F.sum(length).alias("_shared")))
    own = runs.groupBy(key).agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("_own"))
    return attach(shared, own, [key]).select(key, "other", (F.col("_shared") / F.col("_own")).alias("ratio"))


def _meeting(cut: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Pieces of ``cut`` that overlap pieces (_u0, _u1) of ``other`` in a block, with the overlap as x0, x1."""
    both = shuffled_join(cut, other, on).where((F.col("x0") <= F.col("_u1")) & (F.col("_u0") <= F.col("x1")))
    return both.withColumns({"x0": F.greatest("x0", "_u0"), "x1": F.least("x1", "_u1")}).drop("_u0", "_u1")


def containment_candidates(runs: DataFrame, key: str, threshold: float = 0.95) -> DataFrame:
    """Pairs (``key``, other) of different frames among which are all that cover more than ``threshold`` of ``key``.

    A frame that covers so much leaves out less than a share 1 - threshold of the cells, hence holds one of any
    floor((1 - threshold) * cells) + 1 of them. The rarest cells of each frame, those that the fewest frames cover, are taken for
    that and joined with all runs; a frame too small to cover the share is left out as well.
    """
    own = runs.groupBy(key).agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("_size"))
    cut = attach(_in_blocks(runs), own, [key])                  # before depth cuts the runs into many more
    depth = _segments(runs, [], F.lit(0).cast("bigint")).select("y", "xb", F.col("x0").alias("_u0"), F.col("x1").alias("_u1"), "n")
    rarest = Window.partitionBy(key).orderBy("n", "y", "x0").rowsBetween(Window.unboundedPreceding, -1)
    pieces = _meeting(cut, depth, ["y", "xb"])
    need = F.floor((1 - threshold) * F.col("_size")) + 1 - F.coalesce(F.sum(F.col("x1") - F.col("x0") + 1).over(rarest), F.lit(0))
    prefix = (pieces.withColumn("_need", need).where("_need > 0 AND n > 1")               # alone in a cell: nobody to meet
              .withColumn("x1", F.least("x1", F.col("x0") + F.col("_need") - 1)))
    other = cut.select(F.col(key).alias("other"), "y", "xb", F.col("x0").alias("_u0"), F.col("x1").alias("_u1"), "_size")
    met = _meeting(prefix.select(key, F.col("_size").alias("_own"), "y", "xb", "x0", "x1"), other, ["y", "xb"])
    return met.where((F.col("other") != F.col(key)) & (F.col("_size") > threshold * F.col("_own"))).select(key, "other").distinct()


def containment(runs: DataFrame, key: str, threshold: float = 0.95) -> DataFrame:
    """(``key``, other, ratio) where ``other`` covers more than ``threshold`` of ``key``, each frame itself included.

    The result is that of :func:`overlap_ratio` above the threshold; only the candidates of :func:`containment_candidates` are
    counted. ``runs`` must be disjoint per frame.
    """
    runs = checkpointed(runs)                                   # read five times
    pairs = checkpointed(containment_candidates(runs, key, threshold))
    cut = _in_blocks(runs)
    mine = attach(cut, pairs, [key])
    other = cut.select(F.col(key).alias("other"), "y", "xb", F.col("x0").alias("_u0"), F.col("x1").alias("_u1"))
    shared = checkpointed(_meeting(mine, other, ["other", "y", "xb"]).groupBy(key, "other")
                          .agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("_shared")))
    own = runs.groupBy(key).agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("_own"))
    ratios = attach(shared, own, [key]).select(key, "other", (F.col("_shared") / F.col("_own")).alias("ratio"))
    return (ratios.where(F.col("ratio") > threshold)
            .unionByName(own.select(key, F.col(key).alias("other"), F.lit(1.0).alias("ratio"))))


def merge_neighbors(ratios: DataFrame, key: str, threshold: float = 0.95) -> DataFrame:
    """Membership (``group_id``, frame) after merging frames that cover each other.

    The neighbours of a frame are the frames that cover more than ``threshold`` of it. Each
    distinct neighbour set of two or more becomes one group; a frame in no such set stays alone.
    Sets are compared by an order-free hash, so no list is built.
    """
    near = checkpointed(ratios.where(F.col("ratio") > threshold).select(key, "other"))
    sets = near.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("other")).alias("_a"),
                                 F.bit_xor(F.xxhash64("other", F.lit("set"))).alias("_b"))
    group = F.concat_ws(":", "_n", F.hex("_a"), F.hex("_b")).alias("group_id")
    signed = attach(near, sets, [key])
    merged = signed.where("_n > 1").select(group, F.col("other").alias(key)).distinct()
    alone = shuffled_join(signed.where("_n = 1").select(group, key), merged.select(key).distinct(), [key], "left_anti").select("group_id", key)
    return merged.unionByName(alone)


def equal_coverings(runs: DataFrame, key: str) -> DataFrame:
    """Per frame the smallest frame with the same covering, as ``shape``.

    Frames that are copies of each other need not be compared in pairs. Coverings are compared
    by an order-free hash of their disjoint runs.
    """
    sums = runs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("y", "x0", "x1")).alias("_a"),
                                 F.bit_xor(F.xxhash64("y", "x0", "x1", F.lit("set"))).alias("_b"))
    first = sums.groupBy("_n", "_a", "_b").agg(F.min(key).alias("shape"))
    return attach(sums, first, ["_n", "_a", "_b"]).select(key, "shape")


def merged_frames(members: DataFrame, frames: DataFrame, key: str, number: str = "frameNumber") -> DataFrame:
    """Merged frames, one row per member: its place by path and frame number, and the group's first path, number of
    members and granules in all.
    """
    rows = shuffled_join(members, frames.select(F.col("pathNumber").alias("_path"), key, F.col(number).alias("_number"),
                                                "num_granules"), [key]).withColumn("_one", F.lit(1))
    totals = rows.groupBy("group_id").agg(F.min("_path").alias("pathNumber"), F.count(F.lit(1)).alias("members"),
                                          F.sum("num_granules").alias("num_granules"))
    placed = running_totals(rows.select("group_id", "_path", "_number", key, "_one"), ["group_id"], ["_path", "_number", key], "_one")
    return attach(placed, totals, ["group_id"]).select(
        "group_id", F.col("upto").alias("position"), "pathNumber", F.col("_number").alias("frameNumber"), "members",
        "num_granules")


def exclusive_overlap(runs: DataFrame, aoi_runs: DataFrame, key: str, size: float) -> DataFrame:
    """Per frame the area inside the AOI that no other frame covers (0 if none).

    Both coverings must be disjoint per frame. The XOR of the owners of a piece covered once is
    its owner.
    """
    hashed = runs.withColumn("_h", F.xxhash64(key))
    single = _segments(hashed, [], F.col("_h")).where("n = 1").select("y", "xb", "x0", "x1", F.col("owner").alias("_h"))
    area = _in_blocks(dissolve(aoi_runs)).select("y", "xb", F.col("x0").alias("_u0"), F.col("x1").alias("_u1"))
    length = F.least("x1", "_u1") - F.greatest("x0", "_u0") + 1
    own = (single.join(area, ["y", "xb"]).where((F.col("x0") <= F.col("_u1")) & (F.col("_u0") <= F.col("x1")))
           .groupBy("_h").agg((F.sum(length) * float(size) ** 2).alias("overlap_with_aoi")))
    frames = hashed.select(key, "_h").distinct()
    return (frames.join(own, "_h", "left")
            .select(key, F.coalesce("overlap_with_aoi", F.lit(0.0)).alias("overlap_with_aoi")))


def uncovered_area(runs: DataFrame, aoi_runs: DataFrame) -> DataFrame:
    """AOI runs that no frame covers."""
    both = (dissolve(aoi_runs).withColumn("_w", F.lit(1).cast("bigint"))
            .unionByName(dissolve(runs).withColumn("_w", F.lit(2).cast("bigint"))))
    return _segments(both, [], F.col("_w")).where("owner = 1").select("y", "x0", "x1")


def skim_granules(aoi: DataFrame, granules: DataFrame, size: float, scene: str = "sceneName",
                  frame_keys: Sequence[str] = ("pathNumber", "frameNumber"), ring: str = "ring",
                  threshold: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Drop the frames that add nothing to the coverage of the area, and their granules.

    Returns the granules to keep and the merged frames with their exclusive area.
    """
    keyed = granules.withColumn("_frame", F.concat_ws("_", *frame_keys))
    frames = keyed.groupBy("_frame").agg(*[F.min(k).alias(k) for k in frame_keys],
                                         F.count(F.lit(1)).alias("num_granules"))
    runs = checkpointed(dissolve(cover_runs(keyed, size, ["_frame"], ring), ["_frame"]))
    shapes = checkpointed(equal_coverings(runs, "_frame"))
    shape_runs = attach(runs, shapes.where("shape = _frame").select("_frame"), ["_frame"], "left_semi")
    shape_runs = shape_runs.withColumnRenamed("_frame", "shape")
    groups = checkpointed(merge_neighbors(containment(shape_runs, "shape", threshold), "shape", threshold))
    members = attach(shapes, groups, ["shape"]).select("group_id", "_frame")
    grouped = dissolve(attach(shape_runs, groups, ["shape"]).drop("shape"), ["group_id"])
    areas = checkpointed(exclusive_overlap(grouped, cover_runs(aoi, size, [], ring), "group_id", size))
    useless = areas.where("overlap_with_aoi = 0").select("group_id")
    dropped = members.join(useless, "group_id", "left_semi").select("_frame").distinct()
    kept = attach(keyed, dropped, ["_frame"], "left_anti").drop("_frame")
    named = merged_frames(members, frames, "_frame")
    return kept, named.join(areas.where("overlap_with_aoi > 0"), "group_id")


def group_granules(granules: DataFrame, size: float, scene: str = "sceneName", ring: str = "ring",
                   keys: Sequence[str] = ("pathNumber", "frameNumber")) -> DataFrame:
    """Each granule with the number of granules of its frame and the area of their united footprint.

    A frame whose footprint is too thin to hold the centre of a cell has the area of its largest polygon.
    """
    keys = list(keys)
    counts = granules.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_granules"), F.max(ring_area(F.col(ring))).alias("_thin"))
    area = covered_area(dissolve(cover_runs(granules, size, keys, ring), keys), size, keys)
    frames = counts.join(area, keys, "left").select(*keys, "num_granules", F.coalesce("area", "_thin").alias("area"))
    return attach(granules.select(*keys, F.col(scene).alias("granule")), frames, keys)
