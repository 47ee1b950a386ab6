"""Session helpers: table loading and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "gavelbase") -> SparkSession:
    """A local session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """A number of tasks for work that isn't told by its input's size."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the cluster's shared folder, so that a lost executor costs no recomputation.

    The folder is the session's ``spark.checkpoint.dir``; only a local session without one, as in tests, uses a temporary one.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, use: str) -> str:
    """The cluster's shared folder; a temporary one in a local session where none is set. On a cluster a machine's own folder would be lost with it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return os.path.join(tempfile.gettempdir(), f"gavelbase-{use}")
