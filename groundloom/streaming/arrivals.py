"""Incremental jobs: shot files and products as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from groundloom.operators.catalog import latest_processing
from groundloom.operators.shots import process_shots
from groundloom.scale import attach
from groundloom.session import checkpointed

_DAYS = StructType([StructField("of_day", StringType()), StructField("version", LongType())])


def stream_shots(shots: DataFrame, out: str, checkpoint: str, by: Sequence[str] = ("file_no",)) -> None:
    """Process arriving shots by file; ``shots`` is a streaming table.

    The elevation statistics are those of a whole file, and a file may arrive in several batches. A batch keeps its shots as they
    came and notes which files they are of. The files of the batch, and no others, are processed again from all their shots and
    written as a new version, and one file then lists the version that counts for each shot file: until it is there readers see
    the result before the batch, and a batch that runs again replaces only what it wrote itself. The shots as they came are
    kept, as no batch can know that a file is complete.
    """
    by = list(by)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{out}/arrived/version={batch_id}")
        came = _versions(spark, f"{out}/arrived", batch.schema)
        mine = F.col("version") == batch_id
        came.where(mine).select(*by).distinct().write.mode("overwrite").parquet(f"{out}/files/version={batch_id}")
        files = _versions(spark, f"{out}/files", StructType([batch.schema[c] for c in by])).where(F.col("version") <= batch_id)
        fresh = checkpointed(files.where(mine).select(*by))
        # (file, version) pairs: versions without shots of these files are not read
        wanted = attach(files, fresh, by, "left_semi", derived=False)
        again = attach(came, wanted, [*by, "version"], "left_semi").drop("version")
        process_shots(again, by).write.mode("overwrite").parquet(f"{out}/shots/version={batch_id}")
        counts = (spark.read.parquet(f"{out}/shots/version={batch_id}")
                  .groupBy(*by).agg(F.count(F.lit(1)).alias("n_shots")))
        report = fresh.join(counts, by, "left").withColumn("version", F.lit(batch_id).cast("bigint"))
        earlier = _pointer(spark, out, report.schema, batch_id)
        if earlier is not None:
            report = report.unionByName(attach(earlier, fresh, by, "left_anti", derived=False))
        _commit(report, out, batch_id)

    query = (shots.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def read_shots(spark: SparkSession, out: str, by: Sequence[str] = ("file_no",)) -> tuple[DataFrame, DataFrame]:
    """Processed shots and the report of a :func:`stream_shots` output as of the last committed batch."""
    rows = spark.read.parquet(f"{out}/shots")
    fields = {f.name: f for f in rows.schema}
    pointer = _pointer(spark, out, StructType([*[fields[c] for c in by], StructField("n_shots", LongType()),
                                               StructField("version", LongType())]))
    rows = rows.withColumn("version", F.col("version").cast("bigint"))
    kept = attach(rows, pointer.select(*by, "version"), [*by, "version"], "left_semi").drop("version")
    return kept, pointer.drop("version").withColumn("processed", F.col("n_shots").isNotNull())


def stream_products(products: DataFrame, table: str, checkpoint: str, keys: Sequence[str], proc: str,
                    day: str = "acq", delay: str | None = None) -> None:
    """Add arriving products to a table by acquisition day; a reprocessed scene replaces the older one.

    Only the days of the batch are read and written again, and what is being read is never overwritten: a batch writes its
    days as a new version and then, in one file, the list of the version that counts for each day. Until that file is there
    readers see the table before the batch, and a batch that runs again begins from it. With ``delay`` the watermark on
    the processing time bounds the state that removes repeated deliveries.
    """
    stream = products
    if delay is not None:
        stream = stream.withWatermark(proc, delay).dropDuplicatesWithinWatermark([*keys, proc])

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = batch.withColumn("of_day", F.coalesce(F.col(day).cast("string"), F.lit("null")))
        days = checkpointed(arrived.select("of_day").distinct())
        pointer, rows = _pointer(spark, table, _DAYS, batch_id), arrived
        if pointer is not None:
            kept = _version_rows(spark, table, arrived.schema, attach(pointer, days, ["of_day"], "left_semi", derived=False))
            rows = rows.unionByName(kept)
            pointer = attach(pointer, days, ["of_day"], "left_anti", derived=False)
        merged = latest_processing(rows.drop("of_day"), keys, proc).withColumn(
            "of_day", F.coalesce(F.col(day).cast("string"), F.lit("null")))
        (merged.repartition("of_day", F.pmod(F.xxhash64(*keys), F.lit(8))).write.mode("overwrite").partitionBy("of_day")
         .parquet(f"{table}/rows/version={batch_id}"))
        fresh = days.select("of_day", F.lit(batch_id).cast("bigint").alias("version"))
        _commit(fresh if pointer is None else pointer.unionByName(fresh), table, batch_id)

    query = (stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _commit(pointer: DataFrame, table: str, batch_id: int) -> None:
    """Write the version of each day or file as one file, whose arrival makes the batch count."""
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{table}/current/batch={batch_id}")


def _pointer(spark: SparkSession, table: str, schema: StructType, before: int | None = None) -> DataFrame | None:
    """The list (``schema``) of the last committed batch, or of the last before a number; None without any."""
    if not _exists(spark, f"{table}/current"):
        return None
    lists = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(f"{table}/current")
    known = lists if before is None else lists.where(F.col("batch") < before)
    last = known.agg(F.max("batch")).first()[0]
    return None if last is None else lists.where(F.col("batch") == last).drop("batch")


def _versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField("version", LongType())])).parquet(path)


def _version_rows(spark: SparkSession, table: str, schema: StructType, pointer: DataFrame) -> DataFrame:
    return attach(_versions(spark, f"{table}/rows", schema), pointer, ["of_day", "version"], "left_semi").select(schema.names)


def read_products(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a :func:`stream_products` table as of the last committed batch."""
    found = spark.read.parquet(f"{table}/rows").drop("version", "of_day").schema
    schema = StructType([*found.fields, StructField("of_day", StringType())])
    return _version_rows(spark, table, schema, _pointer(spark, table, _DAYS)).drop("of_day")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except Exception as e:                              # no table yet
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise
