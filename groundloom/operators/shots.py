"""Lidar shots: beam arrays to rows, quality filter, robust elevation range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundloom.functions.calendar import LIDAR_EPOCH, epoch_seconds
from groundloom.functions.cells import robust_range
from groundloom.scale import attach

ELEVATIONS = ["elev1", "elev2", "elev3", "elev4", "elev5", "elev6"]


def flatten_shots(beams: DataFrame, arrays: Sequence[str], n_rh: int = 101, rh: str | None = "rh",
                  keys: Sequence[str] = ("beam",), time: str | None = "delta_time",
                  epoch: str = LIDAR_EPOCH) -> DataFrame:
    """One row per shot from one row of equally long arrays per beam.

    Only groups named ``BEAM...`` count. Seconds become a date, the height vector becomes
    ``rh0 .. rh100`` and shots with anything missing are dropped.
    """
    zipped = F.arrays_zip(*arrays, *([rh] if rh else []))
    shots = (beams.where(F.col("beam").startswith("BEAM"))
             .select(*keys, F.explode(zipped).alias("_s")).select(*keys, "_s.*"))
    if time:
        shots = shots.withColumn("date", epoch_seconds(time, epoch))
    if rh:
        heights = [F.get(rh, F.lit(i)).alias(f"rh{i}") for i in range(n_rh)]
        shots = shots.select(*[c for c in shots.columns if c != rh], *heights)
    complete = F.lit(True)
    for name, kind in shots.dtypes:
        complete = complete & F.col(name).isNotNull()
        if kind in ("float", "double"):
            complete = complete & ~F.isnan(name)
    return shots.where(complete)


def shot_quality(df: DataFrame, min_sensitivity: float | None = 0.9, max_range: float | None = None,
                 rh: str | None = None) -> DataFrame:
    """Shots that are sensitive enough, have a small elevation range and are above the ground."""
    ok = F.lit(True)
    if min_sensitivity is not None:
        ok = ok & (F.col("sensitivity") >= min_sensitivity)
    if max_range is not None:
        ok = ok & (F.abs("elev_range") < max_range)
    if rh is not None:
        ok = ok & (F.col(rh) > 0)
    return df.where(ok)


def pooled_elev_stats(df: DataFrame, by: Sequence[str], cols: Sequence[str] = ELEVATIONS) -> DataFrame:
    """Mean and sample deviation of all elevation columns taken together, per file.

    Number, mean and variance of each column are combined, so no row is multiplied.
    """
    aggs = []
    for i, c in enumerate(cols):
        value = F.col(c).cast("double")
        aggs += [F.count(value).alias(f"_n{i}"), F.avg(value).alias(f"_m{i}"), F.var_pop(value).alias(f"_v{i}")]
    each = df.groupBy(*by).agg(*aggs)
    number = sum((F.col(f"_n{i}") for i in range(len(cols))), F.lit(0))
    total = sum((F.coalesce(F.col(f"_n{i}") * F.col(f"_m{i}"), F.lit(0.0)) for i in range(len(cols))), F.lit(0.0))
    pooled = each.withColumns({"_n": number, "elev_mean": F.try_divide(total, number)})
    squares = sum((F.coalesce(F.col(f"_n{i}") * (F.col(f"_v{i}") + (F.col(f"_m{i}") - F.col("elev_mean")) ** 2), F.lit(0.0))
                   for i in range(len(cols))), F.lit(0.0))
    spread = F.when(F.col("_n") > 1, F.sqrt(squares / (F.col("_n") - 1)))
    return pooled.select(*by, "elev_mean", spread.alias("elev_sd"))


def process_shots(shots: DataFrame, by: Sequence[str] = ("file_no",), min_sensitivity: float = 0.9,
                  max_range: float = 2.0, rh: str = "rh95") -> DataFrame:
    """Filtered shots with their elevation range, for all files in one job."""
    sharp = shot_quality(shots, min_sensitivity)
    ranged = attach(sharp, pooled_elev_stats(sharp, by), list(by))
    ranged = ranged.withColumn("elev_range", robust_range(ELEVATIONS, "elev_mean", "elev_sd"))
    return shot_quality(ranged, None, max_range, rh)


def success_report(files: DataFrame, name: str = "file", ok: str = "processed") -> DataFrame:
    """Each file with whether it was processed or failed, and how many files have that status."""
    status = files.withColumn("status", F.when(F.col(ok), "processed").otherwise("failed"))
    counts = status.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))
    return attach(status.select("status", F.col(name).alias("file")), counts, ["status"])
