"""Session helpers: a local builder for tests and the lineage cut used by iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "agentlake") -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of an iterative job in the cluster's shared checkpoint folder.

    The folder is the one the session names in ``spark.checkpoint.dir``. A local
    master without that setting gets a fresh temporary folder; a cluster without it
    is refused, because a machine-local folder does not survive a lost executor.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
    elif sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="agentlake-ckpt-"))
    return df.checkpoint()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a job's own intermediate files, under the cluster's shared
    checkpoint folder; a local master without one uses a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before writing intermediate files")
        folder = tempfile.mkdtemp(prefix="agentlake-files-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: later steps scan
    only the columns they need, and a lost executor costs a re-read, not a recomputation."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
