"""Bronze to silver: daily grid features joined with temperature components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import check_schema, day_of, total_or_null
from wattline.operators.frames import one_of_each, ref
from wattline.operators.joins import within_span
from wattline.operators.reduction import (
    Components,
    component_features,
    component_scores,
    fit_components,
    impute_columns,
    load_components,
    save_components,
    station_columns,
)
from wattline.plans.adapters import DAILY_MEANS, PRODUCTION
from wattline.session import cut, work_path


def daily_grid(grid: DataFrame, day: str = "Nature") -> DataFrame:
    """Daily means of consumption, its two forecasts and total production; rows without a valid day drop out."""
    check_schema(grid, dict.fromkeys([day, *DAILY_MEANS, *PRODUCTION]), "grid bronze")
    date = day_of(ref(day))
    numbers = {c: ref(c).try_cast("double") for c in (*DAILY_MEANS, *PRODUCTION)}
    use, ahead, same = (ref(c) for c in DAILY_MEANS)
    return (
        grid.select(date.alias("date"), *[c.alias(n) for n, c in numbers.items()])
        .where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            F.avg(use).alias("consommation_mw"),
            F.avg(ahead).alias("prevision_j1_mw"),
            F.avg(same).alias("prevision_j_mw"),
            F.avg(total_or_null(PRODUCTION)).alias("production_mw"),
        )
    )


def join_one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that fails when a key repeats on either side."""
    return one_of_each(left, keys, "left").join(one_of_each(right, keys, "right"), keys)


def temperature_features(stations: DataFrame, dates: DataFrame, k: int = 3) -> tuple[DataFrame, Components]:
    """Components of the station temperatures inside the grid's span of dates.

    The fit is cut to tables, so scoring does not repeat it and later runs can
    refer to it.
    """
    spark = stations.sparkSession
    inside = within_span(station_columns(stations.where(F.col("date").isNotNull())), dates)
    filled = cut(impute_columns(inside), "station-columns")
    path = work_path(spark, "components")
    save_components(fit_components(filled, k), path)
    fit = load_components(spark, path)
    return component_features(component_scores(filled, fit), k), fit


def build_silver(grid: DataFrame, stations: DataFrame, k: int = 3) -> tuple[DataFrame, Components]:
    """Daily grid features joined one-to-one with temperature components."""
    daily = daily_grid(grid)
    features, fit = temperature_features(stations, daily, k)
    return join_one_to_one(daily, features, ["date"]), fit
