"""Incremental ingest: which targets are complete, which files are new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXPECTED_STATION_FILES = 198


def completeness(files: DataFrame, target: str, file: str, expected: int = EXPECTED_STATION_FILES) -> DataFrame:
    """One row per target with its file count and whether it needs another pass."""
    n = F.count_distinct(file).alias("n_files")
    status = F.when(F.col("n_files") >= expected, "complete").otherwise("redo")
    return files.groupBy(target).agg(n).withColumn("status", status)


def new_files(files: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Files not in the manifest yet."""
    return files.join(manifest.select(key).distinct(), key, "left_anti")
