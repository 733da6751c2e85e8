"""Calendar gaps: densify, interpolate, fill, shift, resample, islands.

Every series operator takes ``keys`` (the series key) and works on daily rows,
at most one per (keys, date); see ``frames.by_date`` for why that bounds a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.frames import bounded, by_date, grouped, ref


def calendar(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Every day from the first to the last date of each key."""
    span = grouped(df, keys, F.min(date).alias("__lo"), F.max(date).alias("__hi"))
    days = F.explode(F.sequence("__lo", "__hi")).alias(date)
    return span.where(F.col("__lo").isNotNull()).select(*keys, days)


def days_until_next(keys: Sequence[str] = (), date: str = "date") -> Column:
    """Last day before the next row of the series, or the row's own day at the end."""
    return F.coalesce(F.date_sub(F.lead(date).over(by_date(keys, date)), 1), F.col(date))


def densify(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """One row per calendar day; new days are null.

    Each row opens the days up to the next row itself, so the input is read once
    and shuffled once, on the key the windows that follow need as well.
    """
    known = df.where(F.col(date).isNotNull())
    ends = known.withColumn("__end", days_until_next(keys, date))
    days = F.explode(F.sequence(F.col(date), F.greatest("__end", date))).alias("__day")
    rows = ends.select("*", days)
    own = F.col("__day") == F.col(date)
    cells = [
        F.col("__day").alias(c) if c == date else ref(c) if c in keys else F.when(own, ref(c)).alias(c)
        for c in df.columns
    ]
    return rows.select(*cells)


def missing_dates(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Calendar days of the covered span that have no row."""
    known = df.where(F.col(date).isNotNull()).select(*keys, date)
    ends = known.withColumn("__end", days_until_next(keys, date)).where(F.col("__end") > F.col(date))
    gap = F.explode(F.sequence(F.date_add(date, 1), F.col("__end"))).alias(date)
    return ends.select(*keys, gap)


def interpolate_time(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Linear in elapsed days inside gaps; leading nulls stay, trailing take the last value.

    The look-ahead side is a running frame over the descending order: a frame
    that ends at "unbounded following" would be re-scanned for every row.
    """
    seen = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, 0)
    marks: dict[str, Column] = {}
    for c in columns:
        point = F.when(F.col(c).isNotNull(), F.struct(F.col(date).alias("d"), F.col(c).alias("v")))
        marks[f"__p_{c}"] = F.last(point, True).over(seen)
        marks[f"__n_{c}"] = F.last(point, True).over(ahead)

    def value(c: str) -> Column:
        p, n = F.col(f"__p_{c}"), F.col(f"__n_{c}")
        step = F.datediff(F.col(date), p["d"]) / F.datediff(n["d"], p["d"])
        line = F.when(p["d"] < n["d"], p["v"] + (n["v"] - p["v"]) * step)
        return F.coalesce(F.col(c), line, p["v"])

    return df.withColumns(marks).withColumns({c: value(c) for c in columns}).select(*df.columns)


def fill_both(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Forward fill, then backward fill what leads, over the rows present."""
    seen = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {c: F.coalesce(F.last(c, True).over(seen), F.last(c, True).over(ahead)) for c in columns}
    )


def lagged(column: str, k: int, keys: Sequence[str] = (), date: str = "date") -> Column:
    """Value ``k`` rows earlier in the series."""
    return F.lag(column, k).over(by_date(keys, date))


def differenced(
    df: DataFrame, column: str, steps: Sequence[int], name: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Apply x - lag(x, k) for each k in turn; the head becomes null."""
    out = df.withColumn(name, F.col(column))
    for k in steps:
        out = out.withColumn(name, F.col(name) - lagged(name, k, keys))
    return out


def daily_sum(df: DataFrame, day: Column, value: Column, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Daily sum with empty days present as zero."""
    sums = df.groupBy(*keys, day.alias("date")).agg(F.sum(value).alias(name))
    return densify(sums, keys).withColumn(name, F.coalesce(F.col(name), F.lit(0.0)))


def monthly_mean(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    month = F.trunc("date", "month").alias("month")
    return df.groupBy(*keys, month).agg(*[F.avg(c).alias(c) for c in columns])


def islands(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Collapse dates into continuous ranges ``(start, end, n_days)``."""
    days = df.select(*keys, date).where(F.col(date).isNotNull()).distinct()
    anchor = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    run = anchor - F.row_number().over(by_date(keys, date))
    return (
        days.withColumn("__run", run)
        .groupBy(*keys, "__run")
        .agg(
            F.min(date).alias("start"),
            F.max(date).alias("end"),
            F.count(F.lit(1)).alias("n_days"),
        )
        .drop("__run")
    )


def longest_island(ranges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Longest range (earliest on ties) and the window all ranges span."""
    best = F.max_by(
        F.struct("start", "end", "n_days"),
        F.struct(F.col("n_days"), -F.datediff(F.col("start"), F.lit("1970-01-01").cast("date"))),
    )
    return grouped(
        ranges,
        keys,
        best.alias("__b"),
        F.min("start").alias("window_start"),
        F.max("end").alias("window_end"),
    ).select(*keys, "__b.*", "window_start", "window_end")


def on_shared_dates(df: DataFrame, station: str, value: str, date: str = "date") -> DataFrame:
    """Long station rows completed to every (station, date seen by any station).

    Stations are a bounded list, dates are calendar-bounded: each date row carries
    the list and explodes it, so the grid is built without a cross join.
    """
    names = df.agg(bounded(F.sort_array(F.collect_set(station)), "stations").alias("__all")).scalar()
    grid = df.select(date).distinct().select(date, F.explode(names).alias(station))
    return grid.join(df.select(date, station, value), [date, station], "left")


def complete_days(df: DataFrame, station: str, value: str = "value", date: str = "date") -> DataFrame:
    """Dates on which every station of the frame has a value."""
    total = df.agg(F.count_distinct(station)).scalar()
    seen = df.where(F.col(value).isNotNull()).groupBy(date).agg(F.count_distinct(station).alias("__n"))
    return seen.where(F.col("__n") == total).select(date)


def unseen_days(df: DataFrame, station: str, date: str = "date") -> DataFrame:
    """(station, date) pairs without a row inside the span covered by any station.

    Each row opens the days up to the station's next row; the first row also opens the
    days from the start of the span, the last one those to its end.
    """
    span = df.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi")).alias("s")).scalar()
    seen = df.select(station, date).distinct()
    w = by_date([station], date)
    after = F.date_sub(F.coalesce(F.lead(date).over(w), F.date_add(span["hi"], 1)), 1)
    first = F.lag(date).over(w).isNull()
    none = F.array().cast("array<date>")
    rest = F.when(F.col("__to") > F.col(date), F.sequence(F.date_add(date, 1), "__to")).otherwise(none)
    bounded = seen.withColumns({"__lo": span["lo"], "__to": after, "__first": first})
    head = F.when(F.col("__first") & (F.col("__lo") < F.col(date)), F.sequence("__lo", F.date_sub(date, 1)))
    return bounded.select(station, F.explode(F.concat(F.coalesce(head, none), rest)).alias(date))
