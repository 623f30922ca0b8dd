"""Cutting lineage through the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DIR_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session without that setting (a test on one machine) gets a folder of its own.
    """
    named = spark.conf.get(DIR_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {DIR_CONF} to a folder that all executors share")
    known = spark.sparkContext.getCheckpointDir()
    if not known:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        known = spark.sparkContext.getCheckpointDir()
    return known


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/waymark-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Later readers see one fixed result, whatever is recomputed after a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
