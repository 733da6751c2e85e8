"""Error metrics, residual statistics and run comparison aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import EPSILON, health_text
from wattline.operators.frames import attach, attach_stats, grouped


def mae(error: str = "error") -> Column:
    return F.avg(F.abs(F.col(error)))


def rmse(error: str = "error") -> Column:
    return F.sqrt(F.avg(F.col(error) * F.col(error)))


def mape(error: str = "error", actual: str = "actual") -> Column:
    return F.avg(F.abs(F.col(error)) / F.greatest(F.abs(F.col(actual)), F.lit(EPSILON))) * 100


def error_metrics(
    log: DataFrame,
    keys: Sequence[str] = (),
    names: Sequence[str] = ("mae", "rmse", "mape"),
    digits: Sequence[int] = (2, 2, 4),
    count: str | None = None,
) -> DataFrame:
    """MAE, RMSE and MAPE per group; pairs with a null side are left out."""
    pairs = log.where(F.col("actual").isNotNull() & F.col("predicted").isNotNull()).withColumn(
        "error", F.col("predicted") - F.col("actual")
    )
    found = [F.round(m, d).alias(n) for m, n, d in zip((mae(), rmse(), mape()), names, digits)]
    if count:
        found.append(F.count(F.lit(1)).alias(count))
    out = grouped(pairs, keys, *found)
    return out if keys else out.where(F.col(names[0]).isNotNull())


def sample_skewness(c: str) -> Column:
    """Bias-corrected skewness; null below three values or without spread."""
    n = F.count(c).cast("double")
    return F.when((n > 2) & (F.stddev_pop(c) > 0), F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: str) -> Column:
    """Bias-corrected excess kurtosis; null below four values or without spread."""
    n = F.count(c).cast("double")
    scale = F.try_divide(n - 1, (n - 2) * (n - 3))
    return F.when((n > 3) & (F.stddev_pop(c) > 0), scale * ((n + 1) * F.kurtosis(c) + 6))


def residual_statistics(
    df: DataFrame, residual: str, keys: Sequence[str] = (), digits: Sequence[int] | None = (2, 4, 1)
) -> DataFrame:
    """Moments, range and the share within one and two sigma (not centred)."""
    r = df.select(*keys, F.col(residual).alias("__r")).where(F.col("__r").isNotNull())
    moments = grouped(
        r,
        keys,
        F.avg("__r").alias("mean"),
        F.stddev_samp("__r").alias("std"),
        F.min("__r").alias("min"),
        F.max("__r").alias("max"),
        sample_skewness("__r").alias("skewness"),
        sample_kurtosis("__r").alias("kurtosis"),
    )
    size = F.abs("__r")
    within = grouped(
        attach_stats(r, moments.select(*keys, F.col("std").alias("__sd")), keys),
        keys,
        *[
            (F.avg((size <= k * F.col("__sd")).cast("double")) * 100).alias(f"within_{k}sigma_pct")
            for k in (1, 2)
        ],
    )
    out = attach(within, moments, keys)
    if digits is None:
        return out
    d2, d4, d1 = digits
    plan = {"mean": d2, "std": d2, "min": d2, "max": d2, "skewness": d4, "kurtosis": d4}
    plan |= {"within_1sigma_pct": d1, "within_2sigma_pct": d1}
    return out.select(*keys, *[F.round(c, n).alias(c) for c, n in plan.items()])


def with_health(stats: DataFrame) -> DataFrame:
    outside = F.lit(100.0) - F.col("within_2sigma_pct")
    return stats.withColumn("health", health_text(F.col("skewness"), F.col("kurtosis"), outside))


def calibration(log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bias, spread and shared axis range of predicted against actual."""
    return grouped(
        log,
        keys,
        F.avg("error").alias("bias"),
        F.stddev_samp("error").alias("sigma"),
        F.least(F.min("actual"), F.min("predicted")).alias("axis_min"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("axis_max"),
    )


def best_and_worst(runs: DataFrame, metrics: Sequence[str], run: str = "run_id", at: str = "trained_at") -> DataFrame:
    """Best and worst run per metric; ties go to the earliest, then to the smallest id."""
    long = runs.unpivot([run, at], list(metrics), "metric", "value").where(F.col("value").isNotNull())
    return long.groupBy("metric").agg(
        F.min_by(run, F.struct("value", at, run)).alias("best_run"),
        F.min("value").alias("best_value"),
        F.min_by(run, F.struct(-F.col("value"), at, run)).alias("worst_run"),
        F.max("value").alias("worst_value"),
    )


def linear_trend(runs: DataFrame, metrics: Sequence[str], at: str = "trained_at") -> DataFrame:
    """Degree-1 fit of each metric on days since the first run; three runs at least."""
    long = runs.unpivot([at], list(metrics), "metric", "value").where(F.col("value").isNotNull())
    first = long.groupBy("metric").agg(F.min(at).alias("__first"))
    days = F.datediff(F.col(at), F.col("__first"))
    fit = (
        long.join(first, "metric")
        .groupBy("metric")
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.regr_slope("value", days).alias("slope"),
            F.regr_intercept("value", days).alias("intercept"),
        )
    )
    way = F.when(F.col("slope") > 0, "rising").otherwise("falling")
    return fit.where(F.col("n_runs") >= 3).withColumn("direction", way)


def alert_thresholds(runs: DataFrame, metrics: Sequence[str], factor: float = 2.0) -> DataFrame:
    long = runs.unpivot(["run_id"], list(metrics), "metric", "baseline").where(F.col("baseline").isNotNull())
    return long.withColumn("alert", F.round(F.col("baseline") * factor, 2))
