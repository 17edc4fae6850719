"""Session helpers: reading tables and cutting lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan in at least as many partitions as there are cores, for work that is heavy for each row: a small file of one row group
    would keep a single core busy.  A scan that has enough partitions stays as it is, so large tables aren't shuffled for it."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names in ``spark.checkpoint.dir``.  Where it names none, a temporary folder will do in local
    mode (tests); on a cluster it would lie on each machine for itself, so that is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="raqim-checkpoint-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder, so that later branches read it instead of computing it again and survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
