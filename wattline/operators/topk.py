"""Sorts, limits and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of an order; Spark keeps ``n`` rows per task, then merges."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    The rank filter lets Spark add a group limit before the shuffle, so a hot
    group sends at most ``n`` rows per task to its reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def first_middle_last(df: DataFrame, column: str) -> DataFrame:
    """The first, middle and last of a bounded list of distinct dates."""
    everything = Window.partitionBy()
    placed = df.select(column).distinct().select(
        column,
        (F.row_number().over(Window.orderBy(column)) - 1).alias("__i"),
        F.count(F.lit(1)).over(everything).alias("__n"),
    )
    middle = F.floor(F.col("__n") / 2)
    i = F.col("__i")
    return placed.where((i == 0) | (i == middle) | (i == F.col("__n") - 1)).select(column)
