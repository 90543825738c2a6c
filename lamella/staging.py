"""Shared scratch folders: where a plan is cut and intermediate tables are written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; where it is unset a folder of the warehouse,
    which executors share as well."""
    root = spark.conf.get(_KEY, None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing folder below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a result is read several times and every reader must see the same rows (positions of a
    global sort, rounds of an iteration), or where recomputing the input would repeat a large shuffle.
    The written table survives the loss of executors and can still be column-pruned and filtered.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
