"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; on a local master without it, a new one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
