"""A run's monitoring report as long rows: section, item, key, value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.diagnostics import acf, stationarity_report
from wattline.operators.distribution import histogram, normal_qq, qq_line
from wattline.operators.frames import by_date
from wattline.operators.metrics import alert_thresholds, calibration, error_metrics, residual_statistics, with_health
from wattline.operators.peaks import with_context
from wattline.operators.profile import describe
from wattline.operators.rolling import after_warmup, alerts, rolling_errors
from wattline.session import cut


def melted(df: DataFrame, section: str, item: list[str], values: list[str]) -> DataFrame:
    name = F.concat_ws("|", *[F.col(c).cast("string") for c in item]) if item else F.lit("all")
    wide = df.select(name.alias("item"), *[F.col(c).cast("double").alias(c) for c in values])
    return wide.unpivot(["item"], values, "metric", "value").withColumn("section", F.lit(section))


def monitoring_report(
    insample: DataFrame, run: DataFrame, recursive: DataFrame, rows: int = 30, factor: float = 2.0, lags: int = 40
) -> DataFrame:
    """All sections of one run's report.

    Overview (described target and its moving mean's range), residual statistics, error
    distribution, calibration, drift against the baseline, seasonality of errors, residual
    correlogram and Q-Q line, stationarity of the residuals, degradation by horizon, alert
    thresholds, and the health verdict as its numbers: skewness, kurtosis, share outside two sigma.
    ``insample`` and ``recursive`` feed several sections: pass them materialised.
    """
    warm = cut(after_warmup(insample, 60), "warm")
    moving = warm.select(F.avg("actual").over(by_date().rowsBetween(1 - rows, 0)).alias("mean"))
    span = moving.agg(F.min("mean").alias("lowest_moving_mean"), F.max("mean").alias("highest_moving_mean"))
    overview = describe(warm, "actual")
    verdict = health_verdict(warm).withColumn("outside_2sigma_pct", 100 - F.col("within_2sigma_pct"))
    health = verdict.withColumn("ok", (F.col("health") == "OK").cast("double"))
    unit_roots = stationarity_report(warm.select("date", "residual"), "residual")
    stats = residual_statistics(warm, "residual")
    drift = alerts(rolling_errors(warm, rows=rows), run.select(F.col("mae").alias("baseline")), factor=factor)
    season = with_context(warm).groupBy("month", "dow").agg(F.avg("abs_error").alias("mean_abs_error"))
    horizon = error_metrics(recursive, ["horizon"], digits=(1, 1, 3), count="n")
    limits = alert_thresholds(run, ["mae", "rmse", "mape"], factor)
    parts = [
        melted(overview, "overview", [], overview.columns),
        melted(span, "overview", [], span.columns),
        melted(histogram(warm, "error", 40), "error_distribution", ["bin"], ["left_edge", "n", "density"]),
        melted(calibration(warm.withColumnRenamed("fitted", "predicted")), "calibration", [], ["bias", "sigma", "axis_min", "axis_max"]),
        melted(acf(warm, "residual", lags), "correlogram", ["lag"], ["acf", "band"]),
        melted(qq_line(normal_qq(warm, "residual")), "qq", [], ["slope", "intercept", "r"]),
        melted(unit_roots, "stationarity", ["test"], ["statistic", "p", "lags"]),
        melted(health, "health", [], ["skewness", "kurtosis", "outside_2sigma_pct", "ok"]),
        melted(stats, "residuals", [], [c for c in stats.columns]),
        melted(drift, "drift", [], ["n_alerts", "n_days", "alert_pct"]),
        melted(season, "seasonality", ["month", "dow"], ["mean_abs_error"]),
        melted(horizon, "horizon", ["horizon"], ["mae", "rmse", "mape", "n"]),
        melted(limits, "thresholds", ["metric"], ["baseline", "alert"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("section", "item", "metric", "value")


def health_verdict(warm: DataFrame) -> DataFrame:
    return with_health(residual_statistics(warm, "residual", digits=None))
