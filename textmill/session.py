"""What the jobs need from the session: a shared folder and enough tasks."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, per_core: int = 4) -> DataFrame:
    """Give CPU-bound work behind a small scan enough tasks.

    Only meant for DataFrames read from files: a scan that already has a split per
    core is left alone, so large inputs never pay for a shuffle here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * per_core)
