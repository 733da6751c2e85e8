"""Jobs that go from a folder or a layer to the next written layer.

Each writes parquet (snappy) and returns what it wrote, read back. Rejected files are
returned next to it; a job whose files are all rejected fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.plans import bronze
from wattline.plans.gold import ModelReady, model_ready
from wattline.plans.silver import build_silver
from wattline.sources.grid_files import YEAR_IN_NAME, read_grid_text
from wattline.sources.station_files import STATION_IN_NAME, read_station_files
from wattline.sources.tables import write_table


def stored(df: DataFrame, path: str, partition: list[str]) -> DataFrame:
    write_table(df, path, partition)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bronze_grid(
    spark: SparkSession, source: str, out: str, glob: str | None = None, year_pattern: str = YEAR_IN_NAME
) -> tuple[DataFrame, DataFrame]:
    """Yearly grid files of one folder to the bronze table: one folder per year, timestamps in order in each file."""
    text = read_grid_text(spark, source, *([glob] if glob else []), year_pattern=year_pattern)
    return stored(bronze.grid_bronze_for_sink(text), out, ["source_year"]), text.rejects


def bronze_stations(
    spark: SparkSession,
    low: str,
    high: str,
    out: str,
    glob: str | None = None,
    station_pattern: str = STATION_IN_NAME,
) -> tuple[DataFrame, DataFrame]:
    """Station files of both variables to one long bronze table, one folder per year."""
    parts = {v: read_station_files(spark, p, v, glob, station_pattern) for v, p in (("TN", low), ("TX", high))}
    rows = bronze.station_bronze(parts["TN"].rows, parts["TX"].rows).withColumn("source_year", F.year("date"))
    rejects = parts["TN"].rejects.unionByName(parts["TX"].rejects)
    ranged = rows.repartitionByRange("source_year", "date", "station").sortWithinPartitions("source_year", "date")
    return stored(ranged, out, ["source_year"]), rejects


def silver(spark: SparkSession, grid: str, stations: str, out: str, k: int = 3) -> DataFrame:
    """Both bronze tables to the silver table: one row per day, in date order."""
    table, _ = build_silver(spark.read.parquet(grid), spark.read.parquet(stations).drop("source_year"), k)
    return stored(table.withColumn("source_year", F.year("date")).orderBy("date"), out, ["source_year"])


def gold(
    spark: SparkSession, source: str, out: str, train_start: str | None = None, train_end: str | None = None
) -> ModelReady:
    """The silver table to the model-ready table."""
    ready = model_ready(spark.read.parquet(source).drop("source_year"), train_start, train_end)
    table = stored(ready.table.withColumn("source_year", F.year("date")).orderBy("date"), out, ["source_year"])
    return ModelReady(table.drop("source_year"), ready.features, ready.scaled)
