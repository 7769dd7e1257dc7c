"""Working folders for data that one Spark job hands to the next."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from siltstone.storage import Storage


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; a cluster
    session must name one, because executors have to see the same files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed when the application ends."""
    path = f"{checkpoint_root(spark)}/siltstone/{label}-{uuid.uuid4().hex[:12]}"
    Storage(spark).delete_on_exit(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
