"""Queries: incremental jobs run to completion over the given tables as a stream."""

import math

from pyspark.sql import functions as F

from groundloom.queries.base import ORACLES, Tables, query, rounded
from groundloom.queries import catalogs, lidar                        # noqa: F401  the texts below come from them
from groundloom.session import work_path
from groundloom.streaming import arrivals


FILE_ROWS = 2_000_000


def _arriving(t: Tables, view: str, *spread: str):
    """The rows of a view as a stream of three batches; rows of one key come in several of them.

    A batch has as many files as its rows need, so that no task writes or reads a third of the table.
    """
    folder, rows = work_path(t.spark, "arriving"), t.view(view)
    files = max(math.ceil(rows.count() / 3 / FILE_ROWS), 1)
    rows.repartition(3 * files, F.xxhash64(*spread)).write.option("maxRecordsPerFile", 0).parquet(folder)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query("stream_shots", ORACLES["process_shots"], ready=True)
def _(t: Tables):
    out = work_path(t.spark, "shots")
    arrivals.stream_shots(_arriving(t, "v_shots", "shot"), out, work_path(t.spark, "progress"))
    kept, _ = arrivals.read_shots(t.spark, out)
    return kept.select("file_no", "shot", "elev1", "rh95", rounded("elev_range", 8).alias("elev_range"))


@query("stream_products", ORACLES["latest_processing"], ready=True)
def _(t: Tables):
    table = work_path(t.spark, "products")
    arrivals.stream_products(_arriving(t, "v_products", "proc", "value"), table, work_path(t.spark, "progress"), ["burst", "acq"], "proc")
    return arrivals.read_products(t.spark, table).select("burst", F.col("acq").cast("date").alias("acq"), "proc", "kind", "value")
