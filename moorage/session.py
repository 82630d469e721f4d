"""Session settings, and where intermediate results are kept."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "moorage", cpus: int | str | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster use the session that is already there."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="moorage-warehouse-"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A local folder is made up only when the session names none and runs in this one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="moorage-shared-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_location(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/moorage/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Cuts the lineage, survives the loss of executors, and keeps column pruning and filter pushdown for
    the readers, which a checkpoint would not.
    """
    location = new_location(df.sparkSession, name)
    df.write.parquet(location)
    return df.sparkSession.read.schema(df.schema).parquet(location)
