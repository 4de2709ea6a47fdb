"""Session helpers: local builder, shared checkpoint folder, adaptive defaults."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Session settings the library is written for; all are safe to override.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session's ``spark.checkpoint.dir`` names. Where it is unset, a local session (tests) gets a
    temporary one; on a cluster there is no folder that all machines share, so ``ValueError`` is raised."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(frame: DataFrame) -> DataFrame:
    """Write a frame as a table of the shared folder and read it again: its lineage is cut, and its size is known.

    The table is deleted when the process ends.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    frame.write.option("compression", "lz4").parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(frame.schema).parquet(path)


def hold(frame: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder: its lineage is cut and its partitioning kept, so that joins on it do not
    shuffle it again."""
    folder, context = shared_folder(frame.sparkSession), frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return frame.checkpoint(eager=True)


def forget() -> None:
    """Delete all tables written by :func:`cut`; frames that read them can no longer be used."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session is gone, and with it the way to its files
            continue


_WRITTEN: list[tuple[SparkSession, str]] = []
atexit.register(forget)
