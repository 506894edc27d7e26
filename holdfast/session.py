"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROWS_PER_FILE = 100_000  # of tables that many passes read, whatever the files they come from


def local_session(
    cores: str | int = "*", app: str = "holdfast", memory: str = "8g", folder: str | None = None
) -> SparkSession:
    """A single-JVM session for tests and benchmarks; ``folder`` is its checkpoint folder."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    builder = SparkSession.builder
    if folder:
        builder = builder.config(CHECKPOINT_CONF, folder)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        # wide projections compile to methods above the JIT's default size limit
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Where none is named, only a session whose driver is its one executor gets a
    temporary folder; on a cluster, `local-cluster` included, that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if folder:
        return folder
    context = spark.sparkContext
    named = context.getCheckpointDir()
    if named:
        return named
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="holdfast-"))
    return context.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point RDD checkpoints (used by iterative tree fits) at the shared folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def materialize(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used ahead of iterative fits: the copy is columnar, so later passes prune
    columns, and it survives the loss of any executor. ``rows_per_file`` cuts what one
    task writes into several files, so that later passes have a task for each.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/holdfast-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
