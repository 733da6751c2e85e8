"""Silver to the model-ready table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import cyclicals, guard_leakage, with_prefix, without_forbidden
from wattline.operators.frames import all_present
from wattline.operators.gaps import densify, interpolate_time, lagged
from wattline.operators.joins import training_window

TARGET = "consommation_mw"
LAG = "production_mw_lag1"
CALENDAR = ["dow_sin", "dow_cos", "doy_sin", "doy_cos", "is_weekend"]


@dataclass
class ModelReady:
    """The table, its feature columns, and those that are scaled."""

    table: DataFrame
    features: list[str]
    scaled: list[str]


def model_ready(
    silver: DataFrame,
    train_start: str | None = None,
    train_end: str | None = None,
    keys: tuple[str, ...] = (),
) -> ModelReady:
    """Full calendar, gaps interpolated, calendar features, yesterday's production.

    The window is cut last, so the first lag of a window is known. Interpolation
    may look at the day after a window that ends inside a gap.
    """
    rows = without_forbidden(silver.where(F.col("date").isNotNull()))
    components = with_prefix(rows, "temp_pc_")
    numbers = [TARGET, "production_mw", *components]
    dense = densify(rows.select(*keys, "date", *[F.col(c).cast("double").alias(c) for c in numbers]), keys)
    full = interpolate_time(dense, numbers, keys)
    full = full.withColumns(cyclicals(F.col("date"))).withColumn(LAG, lagged("production_mw", 1, keys))
    features = [*components, *CALENDAR, LAG]
    guard_leakage(features)
    table = full.select(*keys, "date", TARGET, *features).where(all_present(features))
    if train_start is not None or train_end is not None:
        table = training_window(table, train_start, train_end)
    return ModelReady(table, features, [*components, LAG])
