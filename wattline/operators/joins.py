"""Joins and set operations between series, calendars, runs and requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.frames import bounded, grouped, meet, ref
from wattline.sources.registry import append_order


def within_span(df: DataFrame, other: DataFrame, date: str = "date") -> DataFrame:
    """Rows whose date lies inside the span of ``other``.

    The bounds are a scalar subquery: computed once, pushed to the scan as a
    range filter, no join at all.
    """
    span = other.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi")).alias("s")).scalar()
    return df.where(F.col(date).between(span["lo"], span["hi"]))


def within_days(df: DataFrame, stamp: str, other: DataFrame, date: str = "date") -> DataFrame:
    """Rows whose timestamp lies on a day inside the span of ``other``.

    The bare timestamp is compared, not its date, so row groups can be skipped.
    """
    ends = F.struct(F.min(date).alias("lo"), F.date_add(F.max(date), 1).alias("hi"))
    span = other.agg(ends.alias("s")).scalar()
    kind = df.schema[stamp].dataType
    return df.where((F.col(stamp) >= span["lo"].cast(kind)) & (F.col(stamp) < span["hi"].cast(kind)))


def training_window(
    df: DataFrame, start: str | None = None, end: str | None = None, date: str = "date"
) -> DataFrame:
    """Inclusive window; an empty result is an error."""
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    if df.isEmpty():
        raise ValueError(f"the training window from {start} to {end} holds no rows")
    return df


def intersect_series(target: DataFrame, features: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    return target.join(features, list(keys))


def wide_by_station(long: DataFrame, columns: Sequence[str], name: Column, value: str = "value") -> DataFrame:
    """One column per name from long rows: the outer alignment of every series in one pivot."""
    return (
        long.select("date", name.alias("__name"), value)
        .groupBy("date")
        .pivot("__name", list(columns))
        .agg(F.first(value))
    )


def origins(
    df: DataFrame, horizon: int, step: int, window: int, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Every ``step``-th forecast origin of the last ``window`` days that has ``horizon`` days after it."""
    order = Window.partitionBy(*keys).orderBy(date)
    placed = df.select(
        *keys,
        date,
        (F.row_number().over(order) - 1).alias("__pos"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("__n"),
    )
    first = F.greatest(F.lit(0), F.col("__n") - window - horizon)
    pos = F.col("__pos")
    chosen = (pos >= first) & (pos < F.col("__n") - horizon) & (F.pmod(pos - first, F.lit(step)) == 0)
    return placed.where(chosen).select(*keys, F.col(date).alias("start_date"))


def with_targets(
    starts: DataFrame, series: DataFrame, value: str, horizon: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Each origin with its next ``horizon`` days and their actual values.

    The series is dense, so the target date is the join key: an equi-join, with a
    fixed fan-out of ``horizon`` rows per origin.
    """
    fan = starts.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
    fan = fan.withColumn("date", F.date_add("start_date", F.col("horizon")))
    actual = series.select(*keys, "date", F.col(value).alias("actual"))
    return meet(fan, actual, [*keys, "date"]).withColumnRenamed("date", "target_date")


def spread_national(requests: DataFrame, columns: DataFrame, name: str = "column") -> DataFrame:
    """One national (min, max) pair per request put on every station column by its prefix."""
    names = columns.agg(bounded(F.sort_array(F.collect_set(name)), "station columns")).scalar()
    rows = requests.select("*", F.explode(names).alias(name))
    value = (
        F.when(F.col(name).startswith("TN_"), F.col("temp_min_avg"))
        .when(F.col(name).startswith("TX_"), F.col("temp_max_avg"))
        .otherwise(0.0)
    )
    return rows.withColumn("value", value)


def resolve_runs(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """Requests with the run they ask for, the one appended last when they name none.

    ``found`` is false for an unknown run.
    """
    latest = runs.agg(F.max_by("run_id", append_order(runs))).scalar()
    asked = requests.withColumn("run_id", F.coalesce(F.col("run_id"), latest))
    known = runs.withColumn("found", F.lit(True))
    return asked.join(known, "run_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def union_all_columns(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    return union_all_columns([f.withColumn(tag, F.lit(name)) for name, f in frames.items()])


def distinct_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return grouped(df, keys, *[F.count_distinct(ref(c)).alias(f"n_{c}") for c in columns])
