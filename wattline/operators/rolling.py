"""Moving windows over daily series: means, drift, decomposition, run deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.frames import attach, by_date, grouped, meet
from wattline.operators.ordered import series_blocks


def moving_mean(c: Column, keys: Sequence[str], rows: int, min_rows: int, date: str = "date") -> Column:
    frame = by_date(keys, date).rowsBetween(-(rows - 1), 0)
    return F.when(F.count(c).over(frame) >= min_rows, F.avg(c).over(frame))


def rolling_errors(
    log: DataFrame, keys: Sequence[str] = (), rows: int = 30, drop_warmup: bool = True
) -> DataFrame:
    """Rolling MAE and RMSE; the first ``rows`` rows are dropped unless told otherwise."""
    mae = moving_mean(F.col("abs_error"), keys, rows, rows // 2)
    rmse = F.sqrt(moving_mean(F.col("error") * F.col("error"), keys, rows, rows // 2))
    out = log.select(
        *keys,
        "date",
        mae.alias("rolling_mae"),
        rmse.alias("rolling_rmse"),
        F.row_number().over(by_date(keys)).alias("__n"),
    )
    if drop_warmup:
        out = out.where(F.col("__n") > rows)
    return out.drop("__n")


def alerts(rolled: DataFrame, baseline: DataFrame, keys: Sequence[str] = (), factor: float = 2.0) -> DataFrame:
    """Days with rolling MAE above ``baseline × factor``, and their share."""
    rows = attach(rolled, baseline, keys)
    above = F.count_if(F.col("rolling_mae") > F.col("baseline") * factor)
    return grouped(
        rows,
        keys,
        above.alias("n_alerts"),
        F.count(F.lit(1)).alias("n_days"),
        (F.try_divide(above, F.count(F.lit(1))) * 100).alias("alert_pct"),
    )


def last_rows(df: DataFrame, n: int, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(date)))
    return df.withColumn("__n", newest).where(F.col("__n") <= n).drop("__n")


def row_range(
    df: DataFrame, first: int, last: int | None = None, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Rows ``first`` to ``last`` (1-based, inclusive) in date order."""
    out = df.withColumn("__n", F.row_number().over(by_date(keys, date))).where(F.col("__n") >= first)
    if last is not None:
        out = out.where(F.col("__n") <= last)
    return out.drop("__n")


def after_warmup(df: DataFrame, rows: int = 60, keys: Sequence[str] = ()) -> DataFrame:
    return row_range(df, rows + 1, None, keys)


def latest_change(runs: DataFrame, metrics: Sequence[str], at: str = "trained_at") -> DataFrame:
    """Last value of each metric with its change from the run before."""
    long = runs.unpivot([at], list(metrics), "metric", "value").where(F.col("value").isNotNull())
    w = Window.partitionBy("metric").orderBy(at)
    moved = long.withColumns(
        {
            "previous": F.lag("value").over(w),
            "__last": F.row_number().over(Window.partitionBy("metric").orderBy(F.desc(at))),
        }
    )
    delta = F.col("value") - F.col("previous")
    pct = F.when(F.col("previous") == 0, 0.0).otherwise(F.try_divide(delta, F.col("previous")) * 100)
    return moved.where((F.col("__last") == 1) & F.col("previous").isNotNull()).select(
        "metric", "previous", F.col("value").alias("latest"), delta.alias("delta"), pct.alias("pct_change")
    )


def normalised_by_min(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Divide by the column minimum where that is positive."""
    lows = df.agg(*[F.min(c).alias(f"__min_{c}") for c in columns])
    out = attach(df, lows)
    for c in columns:
        low = F.col(f"__min_{c}")
        out = out.withColumn(c, F.when(low > 0, F.col(c) / low).otherwise(F.col(c)))
    return out.select(*df.columns)


def decompose(df: DataFrame, value: str, period: int = 7, keys: Sequence[str] = ()) -> DataFrame:
    """Classical additive decomposition with an odd period.

    Trend is the centred moving mean. Its two edges lie on the line through the
    nearest ``period`` trend points (at the end, those before the last one).
    Seasonal is the mean of the detrended values by position in the period,
    centred to zero. A long series is many blocks, each with half a period on both sides.
    """
    half = period // 2
    sizes = grouped(df, keys, F.count(F.lit(1)).alias("n"))
    series = df.select(*keys, "date", F.col(value).alias("observed"))
    blocks = series_blocks(series, keys, "date", half, half)
    frame = Window.partitionBy(*keys, "block").orderBy("pos").rowsBetween(-half, half)
    mean = F.when(F.count("observed").over(frame) == period, F.avg("observed").over(frame)).alias("ma")
    rows = blocks.select(*keys, "date", "observed", "pos", "own", mean).where("own").drop("own")
    rows = attach(rows, sizes, keys)
    pos, n = F.col("pos"), F.col("n")
    at_head = pos.between(half, half + period - 1)
    at_tail = pos.between(n - half - 1 - period, n - half - 2)
    lines = grouped(
        rows,
        keys,
        *[
            f(F.when(side, F.col("ma")), F.when(side, pos)).alias(f"__{name}_{tag}")
            for tag, side in (("h", at_head), ("t", at_tail))
            for name, f in (("k", F.regr_slope), ("b", F.regr_intercept))
        ],
    )
    head = F.col("__k_h") * pos + F.col("__b_h")
    tail = F.col("__k_t") * pos + F.col("__b_t")
    trend = F.when(pos < half, head).when(pos > n - half - 1, tail).otherwise(F.col("ma"))
    flat = attach(rows, lines, keys).select(*keys, "date", "observed", "pos", trend.alias("trend"))
    phase = F.col("pos") % period
    by_phase = flat.groupBy(*keys, phase.alias("phase")).agg(F.avg(F.col("observed") - F.col("trend")).alias("__a"))
    centre = by_phase.withColumn("seasonal", F.col("__a") - F.avg("__a").over(Window.partitionBy(*keys)))
    out = meet(flat.withColumn("phase", phase), centre.drop("__a"), [*keys, "phase"])
    residual = F.col("observed") - F.col("trend") - F.col("seasonal")
    return out.select(*keys, "date", "observed", "trend", "seasonal", residual.alias("residual"))


def autocovariance(df: DataFrame, value: str, lags: int, keys: Sequence[str] = ()) -> DataFrame:
    """Autocovariance (divisor n) for lags 0..``lags``: one pass, one aggregate.

    Returns one row per (keys, lag) with ``n``, ``autocov`` and ``acf``. A long series is
    many blocks that overlap by ``lags`` rows.
    """
    mean = grouped(df, keys, F.avg(value).alias("__m"), F.count(value).alias("n"))
    blocks = series_blocks(df.select(*keys, "date", F.col(value).alias("__v")), keys, "date", lags)
    x = attach(blocks, mean, keys).select(*keys, "block", "pos", "own", "n", (F.col("__v") - F.col("__m")).alias("__x"))
    w = Window.partitionBy(*keys, "block").orderBy("pos")
    shifted = x.select(
        *keys, "own", "n", "__x", *[F.lag("__x", k).over(w).alias(f"__l{k}") for k in range(1, lags + 1)]
    ).where("own")
    products = [F.sum(F.col("__x") * F.col("__x"))]
    products += [F.sum(F.col("__x") * F.col(f"__l{k}")) for k in range(1, lags + 1)]
    sums = grouped(shifted, keys, F.max("n").alias("n"), F.array(*products).alias("__s"))
    long = sums.select(*keys, "n", F.col("__s")[0].alias("__s0"), F.posexplode("__s").alias("lag", "__v"))
    return long.where(F.col("__v").isNotNull()).select(
        *keys,
        "lag",
        "n",
        (F.col("__v") / F.col("n")).alias("autocov"),
        F.try_divide("__v", "__s0").alias("acf"),
    )
