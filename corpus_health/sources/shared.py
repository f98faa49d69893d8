"""Where jobs keep tables that several executors must see."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the folder the cluster shares.

    That is `spark.checkpoint.dir`, or the session's warehouse where it is not set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame as a table in a new folder below the shared one: computed once, and not lost with an executor."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)
