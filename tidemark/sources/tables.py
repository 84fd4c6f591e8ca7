"""Parquet table access for the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder (``<sf_dir>/<name>.parquet``)."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def few_splits(df: DataFrame) -> int | None:
    """The number of cores if the input has fewer splits (a small file is one), else
    None: a large input has splits enough and is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return cores if df.rdd.getNumPartitions() < cores else None
