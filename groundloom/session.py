"""Session settings and the shared folder used for checkpoints and work tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "groundloom", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, ANSI, adaptive execution."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        b = b.config(key, value)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster that folder
    would exist on one machine only, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="run-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder for a table that a job writes."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, so a lost executor costs no rerun."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
