"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ridgeworks", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` overrides any of them.

    A key is given with underscores for dots: ``spark_sql_shuffle_partitions=8``.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # few, fat scan tasks: each one ships a d x d partial Gram matrix
        "spark.sql.files.maxPartitionBytes": "512m",
        # bounds the Python side of one Arrow batch whatever the row width
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    }
    settings.update({key.replace("_", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; fall back to a temp folder in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="ridgeworks-checkpoint-")
    context.setCheckpointDir(folder)


def checkpoint(df: DataFrame) -> DataFrame:
    """Run ``df`` once and keep the result in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` once, keep it as Parquet in the shared checkpoint folder and read that: later jobs read
    only the columns they use."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_path(spark: SparkSession, path: str) -> str:
    """``path`` in full as its file system knows it, without scheme and host."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(found).toUri().getPath()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a table in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def discard(table: DataFrame) -> None:
    """Remove a table that ``stored`` wrote, once nothing reads it any more."""
    spark = table.sparkSession
    shared = plain_path(spark, spark.sparkContext.getCheckpointDir())
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        if plain_path(spark, folder).startswith(f"{shared}/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
