"""Parquet table access shared by all queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` under ``sf_dir`` (a file or a directory of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy stages at least one partition a core.

    Only an input with splits for fewer than half of the cores, such as one small file
    with a single row group, is hash-partitioned on ``key``, which is unique or nearly so;
    the shuffle then costs less than the idle cores.  Any larger scan is returned
    untouched.  The rows are the same either way.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if 2 * df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, F.col(key))
