"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a task takes about ten times this in sorts and hash tables; small inputs get a task per core all the same
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def build_session(app: str = "civicspark", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session options the operators rely on; all of them can change at run time."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session without the setting uses its warehouse, which all executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
        named = spark.sparkContext.getCheckpointDir()
    return named


_scratch: dict = {}  # folder -> how to delete it


def _own_folder(spark: SparkSession) -> str:
    folder = f"{shared_dir(spark)}/civicspark/{spark.sparkContext.applicationId}"
    if folder not in _scratch:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        _scratch[folder] = lambda: files.delete(path, True)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this session; frames that read them are done with."""
    delete = _scratch.pop(_own_folder(spark), None)
    if delete:
        delete()


@atexit.register
def _release_all() -> None:
    for delete in _scratch.values():
        with contextlib.suppress(Exception):  # the JVM may have ended before
            delete()


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, most: int):
    """Tables written inside pass at most ``most`` rows at a time to Python, where rows are wide."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str = "table", by=()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    It cuts the lineage, survives lost executors, and gives Catalyst a true file size: a
    join against the result is broadcast only while it stays under
    ``spark.sql.autoBroadcastJoinThreshold`` and is shuffled beyond it. ``by`` lays it out in
    folders a filter can skip. The table lives until :func:`release` or the end of the program.
    """
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
