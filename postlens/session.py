"""Session helpers: table loading, checkpoint folder, capability probes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in which lineage is cut; the cluster names it in spark.checkpoint.dir.

    Only where the setting is missing (tests on one machine) a temporary folder is made
    and set as the checkpoint folder of this session.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if given:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(given)
        return given
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    made = tempfile.mkdtemp(prefix="postlens-checkpoint-")
    sc.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; it survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows, written once as a table in the shared folder: for what is read several times and costs much to make."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, where a small input has fewer partitions than there are cores; else as they are.

    For work that takes long per row.  Large inputs are never shuffled by this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
