"""Readers of the engine's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the folder; columns and filters that are asked for later reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, *columns: str) -> DataFrame:
    """Rows delivered twice repeat all columns but ``loaded_at``: take the columns needed, without repeats.

    The distinct is partially aggregated before the shuffle, so a row delivered a million times leaves each map task once.
    """
    return df.select(*columns).distinct()
