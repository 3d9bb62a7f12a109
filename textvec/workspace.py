"""Where intermediate tables go, and how the package reaches the executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local session without one gets its own."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="textvec-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/textvec-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as a Parquet table and read back.

    The table cuts the lineage and freezes what a recomputation could change (range bounds,
    generated ids), so that a lost executor costs only its own tasks.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("errorifexists").partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Repartition a scan by ``key`` only when it has fewer partitions than the cluster has cores.

    Only for scans: asking a plan with shuffles for its partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a local session.

    On a cluster the package comes with the application (``--py-files``).
    """
    sc = spark.sparkContext
    if (sc.master == "local" or sc.master.startswith("local[")) and sc.applicationId not in _shipped:
        sc.addFile(os.path.dirname(os.path.abspath(__file__)), recursive=True)
        _shipped.add(sc.applicationId)
