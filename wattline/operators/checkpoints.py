"""Half-year training checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.frames import by_date


def half_year_end(date: Column) -> Column:
    """The 30 June or 31 December that closes the half-year of a date."""
    month = F.when(F.month(date) <= 6, 6).otherwise(12)
    return F.last_day(F.make_date(F.year(date), month, F.lit(1)))


def half_year_ends(
    bounds: DataFrame, last: str, first: str = "2013-12-31", keys: Sequence[str] = ()
) -> DataFrame:
    """Every half-year end from ``first`` to the ``last`` column of a bounds frame."""
    months = F.sequence(
        F.trunc(F.lit(first).cast("date"), "month"),
        F.trunc(F.col(last), "month"),
        F.expr("interval 6 months"),
    )
    ends = F.filter(F.transform(months, lambda x: F.last_day(x)), lambda x: x <= F.col(last))
    reached = bounds.where(F.col(last) >= F.lit(first).cast("date"))
    return reached.select(*keys, F.explode(ends).alias("checkpoint"))


def expanding(df: DataFrame, date: str, first: str, sums: dict[str, Column]) -> DataFrame:
    """Size, span and sums of every expanding training window.

    Each day falls into one half-year, is summed there, and windows grow by a
    running sum over the half-years. That gives the result of joining every row
    with all later checkpoints, without copying a row once.
    """
    closes = F.greatest(half_year_end(F.col(date)), F.lit(first).cast("date"))
    parts = df.groupBy(closes.alias("checkpoint")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )
    plan = half_year_ends(df.agg(F.max(date).alias("last")), "last", first)
    so_far = by_date((), "checkpoint").rowsBetween(Window.unboundedPreceding, 0)
    return plan.join(parts, "checkpoint", "left").select(
        "checkpoint",
        *[F.sum(c).over(so_far).alias(c) for c in ("n_rows", *sums)],
        F.min("first_date").over(so_far).alias("first_date"),
        F.max("last_date").over(so_far).alias("last_date"),
    )
