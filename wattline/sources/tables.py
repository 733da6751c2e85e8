"""Parquet and CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet with column pruning; a missing table is named in the error."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"{name} not found: {path}") from error
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
