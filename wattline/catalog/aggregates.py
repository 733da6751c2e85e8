"""Aggregation queries (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.catalog.registry import FUELS, query
from wattline.operators import distribution, metrics, peaks, profile, rolling
from wattline.operators.ordered import opened, ranked_values
from wattline.plans import adapters as src
from wattline.plans.silver import daily_grid


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("a01_daily_coverage", "SELECT date, count(*) AS n_intervals FROM readings GROUP BY 1", "readings")
def a01(spark, sf):
    return src.readings(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n_intervals"))


@query("a02_date_range", "SELECT min(date) AS first_date, max(date) AS last_date FROM prod", "prod")
def a02(spark, sf):
    day = F.col("l_shipdate").cast("date")
    return src.table(spark, sf, "lineitem").agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))


TOTAL = (
    "CASE WHEN coalesce(" + ", ".join(f'"{c}"' for c in FUELS) + ") IS NOT NULL THEN "
    + " + ".join(f'coalesce("{c}", 0)' for c in FUELS) + " END"
)
DAILY_GRID = f"""SELECT "Nature" AS date, avg("Consommation") AS consommation_mw, avg("Prévision J-1") AS prevision_j1_mw,
  avg("Prévision J") AS prevision_j_mw, avg({TOTAL}) AS production_mw FROM grid GROUP BY 1"""


@query("a03_daily_mean", DAILY_GRID, "grid")
def a03(spark, sf):
    return daily_grid(src.grid(spark, sf))


@query(
    "a04_null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", 'double' AS dtype, count(*) FILTER (\"{c}\" IS NULL) AS n_null,"
        f" avg(CASE WHEN \"{c}\" IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS null_rate FROM grid"
        for c in FUELS
    ),
    "grid",
)
def a04(spark, sf):
    found = profile.null_profile(src.grid(spark, sf), src.PRODUCTION)
    return found.orderBy(F.desc("null_rate"), "column")


@query(
    "a05_table_summary",
    """
SELECT unnest(['date_min', 'date_max', 'n_rows', 'n_dates']) AS item, unnest([CAST(min(date) AS VARCHAR), CAST(max(date) AS VARCHAR),
  CAST(count(*) AS VARCHAR), CAST(count(DISTINCT date) AS VARCHAR)]) AS value FROM stations
""",
    "stations",
)
def a05(spark, sf):
    return profile.table_summary(src.stations(spark, sf))


STATS = """count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
  min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 5) AS q25, round(quantile_cont(l_extendedprice, 0.5), 5) AS q50,
  round(quantile_cont(l_extendedprice, 0.75), 5) AS q75, max(l_extendedprice) AS max FROM lineitem"""


@query("a06_describe", f"SELECT {STATS}")
def a06(spark, sf):
    out = profile.describe(src.table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(rounded(out, 4, "mean", "std"), 5, "q25", "q50", "q75")


@query("a06_describe_keyed", f"SELECT l_returnflag, {STATS} GROUP BY 1")
def a06_keyed(spark, sf):
    out = profile.describe(src.table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return rounded(rounded(out, 4, "mean", "std"), 5, "q25", "q50", "q75")


@query("a06_null_key", f"SELECT nullif(l_returnflag, 'R') AS k, {STATS} GROUP BY 1")
def a06_null(spark, sf):
    """A group whose key is null is a group like any other, here and in the queries of this name below."""
    out = profile.describe(with_null_key(spark, sf), "l_extendedprice", ["k"])
    return rounded(rounded(out, 4, "mean", "std"), 5, "q25", "q50", "q75")


def with_null_key(spark, sf):
    rows = src.table(spark, sf, "lineitem")
    return rows.select(F.nullif("l_returnflag", F.lit("R")).alias("k"), "l_extendedprice")


CORR = ["Consommation", "Prévision J-1", "Fioul", "Gaz", "Nucléaire"]


@query(
    "a07_correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(\"{a}\", \"{b}\"), 6) AS r FROM grid" for a in CORR for b in CORR
    ),
    "grid",
)
def a07(spark, sf):
    return rounded(profile.correlation(src.grid(spark, sf), CORR), 6, "r")


MAPE = "avg(abs_error / greatest(abs(actual), 2.220446049250313e-16)) * 100"


@query(
    "a08_insample_metrics",
    f"SELECT round(avg(abs_error), 2) AS mae, round(sqrt(avg(sq_error)), 2) AS rmse, round({MAPE}, 4) AS mape FROM fc1",
    "fc1",
)
def a08(spark, sf):
    return metrics.error_metrics(src.fc1(spark, sf))


@query(
    "a09_horizon_metrics",
    f"SELECT horizon, round(avg(abs_error), 1) AS mae, round(sqrt(avg(sq_error)), 1) AS rmse, round({MAPE}, 3) AS mape, count(*) AS n FROM fc GROUP BY 1",
    "fc",
)
def a09(spark, sf):
    return metrics.error_metrics(src.fc(spark, sf), ["horizon"], digits=(1, 1, 3), count="n")


@query(
    "a10_backtest_summary",
    f"""
SELECT model, horizon, count(*) AS n_points, round(avg(abs_error), 4) AS mae, round(sqrt(avg(sq_error)), 4) AS rmse, round({MAPE}, 6) AS mape,
  round(any_value(threshold_global), 4) AS threshold_global, round(median(peak_threshold), 4) AS threshold_median,
  count(*) FILTER (is_peak) AS n_peaks, round(avg(abs_error) FILTER (is_peak), 4) AS peak_mae,
  round(sqrt(avg(sq_error) FILTER (is_peak)), 4) AS peak_rmse,
  round(avg(CASE WHEN predicted < actual THEN 1.0 ELSE 0.0 END) FILTER (is_peak), 6) AS under_rate_peak
FROM model_peaks GROUP BY 1, 2
""",
    "model_peaks",
)
def a10(spark, sf):
    keys = ["model", "horizon"]
    out = peaks.backtest_summary(peaks.with_peaks(src.forecast_log(spark, sf), keys, 28), keys)
    out = rounded(out, 6, "mape", "under_rate_peak")
    return rounded(out, 4, "mae", "rmse", "threshold_global", "threshold_median", "peak_mae", "peak_rmse")


@query(
    "a11_monthly_errors",
    """
SELECT horizon, CAST(month(date) AS INTEGER) AS month, round(avg(abs_error), 1) AS mean, round(median(abs_error), 1) AS median,
  round(stddev_samp(abs_error), 1) AS std FROM fc GROUP BY 1, 2
""",
    "fc",
)
def a11(spark, sf):
    rows = src.fc(spark, sf).groupBy("horizon", F.month("date").alias("month"))
    return rows.agg(
        F.round(F.avg("abs_error"), 1).alias("mean"),
        F.round(F.median("abs_error"), 1).alias("median"),
        F.round(F.stddev_samp("abs_error"), 1).alias("std"),
    )


@query(
    "a12_month_weekday",
    "SELECT CAST(month(date) AS INTEGER) AS month, "
    + ", ".join(f'round(avg(abs_error) FILTER (isodow(date) = {d + 1}), 4) AS "{d}"' for d in range(7))
    + " FROM fc1 GROUP BY 1",
    "fc1",
)
def a12(spark, sf):
    rows = peaks.with_context(src.fc1(spark, sf))
    return rows.groupBy("month").pivot("dow", list(range(7))).agg(F.round(F.avg("abs_error"), 4))


@query(
    "a13_threshold_summary",
    """
SELECT horizon, round(median(peak_threshold), 4) AS threshold_median, round(min(peak_threshold), 4) AS threshold_min,
  round(max(peak_threshold), 4) AS threshold_max, count(*) FILTER (is_peak) AS n_peaks, count(*) AS n_points,
  round(100 * count(*) FILTER (is_peak) / count(*), 6) AS peak_share_pct FROM fc_peaks GROUP BY 1
""",
    "fc_peaks",
)
def a13(spark, sf):
    out = peaks.threshold_summary(peaks.with_peaks(src.fc(spark, sf), ["horizon"], 28), ["horizon"])
    return rounded(rounded(out, 4, "threshold_median", "threshold_min", "threshold_max"), 6, "peak_share_pct")


RESIDUAL_SQL = """
SELECT {k} round(avg(r), 2) AS mean, round(stddev_samp(r), 2) AS std, round(min(r), 2) AS min, round(max(r), 2) AS max,
  round(skewness(r), 4) AS skewness, round(kurtosis(r), 4) AS kurtosis,
  round(100 * avg(CASE WHEN abs(r) <= sd THEN 1.0 ELSE 0.0 END), 1) AS within_1sigma_pct,
  round(100 * avg(CASE WHEN abs(r) <= 2 * sd THEN 1.0 ELSE 0.0 END), 1) AS within_2sigma_pct
FROM (SELECT {k} actual - predicted AS r, stddev_samp(actual - predicted) OVER ({p}) AS sd FROM {t}) AS x {g}
"""


@query("a14_residual_statistics", RESIDUAL_SQL.format(k="", p="", t="fc1", g=""), "fc1")
def a14(spark, sf):
    r = src.fc1(spark, sf).select((F.col("actual") - F.col("predicted")).alias("residual"))
    return metrics.residual_statistics(r, "residual")


@query(
    "a14_residual_statistics_keyed",
    RESIDUAL_SQL.format(k="model, horizon,", p="PARTITION BY model, horizon", t="flog", g="GROUP BY 1, 2"),
    "flog",
)
def a14_keyed(spark, sf):
    r = src.forecast_log(spark, sf).withColumn("residual", F.col("actual") - F.col("predicted"))
    return metrics.residual_statistics(r, "residual", ["model", "horizon"])


@query(
    "a14_null_key",
    RESIDUAL_SQL.replace("{k} actual - predicted AS r", "k, r").replace("stddev_samp(actual - predicted)", "stddev_samp(r)").format(
        k="k,", p="PARTITION BY k", t="(SELECT nullif(l_returnflag, 'R') AS k, l_extendedprice - 30000 AS r FROM lineitem) AS l", g="GROUP BY 1"
    ),
)
def a14_null(spark, sf):
    rows = with_null_key(spark, sf).withColumn("residual", F.col("l_extendedprice") - 30000)
    return metrics.residual_statistics(rows, "residual", ["k"])


@query(
    "a15_peak_detection",
    """
SELECT *, 2 * precision * recall / nullif(precision + recall, 0) AS f1 FROM (
  SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall FROM (
    SELECT horizon, count(*) FILTER (is_peak AND predicted >= peak_threshold) AS tp,
      count(*) FILTER (NOT is_peak AND predicted >= peak_threshold) AS fp,
      count(*) FILTER (is_peak AND predicted < peak_threshold) AS fn,
      count(*) FILTER (NOT is_peak AND predicted < peak_threshold) AS tn FROM fc_peaks GROUP BY 1) AS c) AS d
""",
    "fc_peaks",
)
def a15(spark, sf):
    return peaks.detection_quality(peaks.with_peaks(src.fc(spark, sf), ["horizon"], 28), ["horizon"])


@query(
    "a16_alert_count",
    """
SELECT horizon, n_alerts, n_days, 100.0::DOUBLE * n_alerts / n_days AS alert_pct FROM (
  SELECT r.horizon, count(*) FILTER (rolling_mae > baseline * 1.2) AS n_alerts, count(*) AS n_days
  FROM fc_rolled r JOIN (SELECT horizon, avg(abs_error) AS baseline FROM fc GROUP BY 1) b ON b.horizon = r.horizon GROUP BY 1) AS x
""",
    "fc_rolled",
)
def a16(spark, sf):
    log = src.fc(spark, sf)
    base = log.groupBy("horizon").agg(F.avg("abs_error").alias("baseline"))
    out = rolling.alerts(rolling.rolling_errors(log, ["horizon"]), base, ["horizon"], factor=1.2)
    return out.withColumn("alert_pct", F.lit(100.0) * F.col("n_alerts") / F.col("n_days"))


RUN_METRICS = ["mae", "rmse", "mape"]


def long_sql(cols: str, value: str) -> str:
    return " UNION ALL ".join(f"SELECT {cols}, '{m}' AS metric, {m} AS {value} FROM runs" for m in RUN_METRICS)


@query(
    "a17_alert_thresholds",
    f"SELECT run_id, metric, baseline, round(baseline * 2.0::DOUBLE, 2) AS alert FROM ({long_sql('run_id', 'baseline')}) AS l",
    "runs",
)
def a17(spark, sf):
    return metrics.alert_thresholds(src.runs(spark, sf), RUN_METRICS)


@query(
    "a18_calibration",
    """
SELECT horizon, round(avg(error), 4) AS bias, round(stddev_samp(error), 4) AS sigma,
  least(min(actual), min(predicted)) AS axis_min, greatest(max(actual), max(predicted)) AS axis_max FROM fc GROUP BY 1
""",
    "fc",
)
def a18(spark, sf):
    return rounded(metrics.calibration(src.fc(spark, sf), ["horizon"]), 4, "bias", "sigma")


@query(
    "a19_best_and_worst",
    f"""
SELECT metric, first(run_id ORDER BY value, trained_at) AS best_run, min(value) AS best_value,
  first(run_id ORDER BY value DESC, trained_at) AS worst_run, max(value) AS worst_value
FROM ({long_sql('run_id, trained_at', 'value')}) AS l GROUP BY 1
""",
    "runs",
)
def a19(spark, sf):
    return metrics.best_and_worst(src.runs(spark, sf), RUN_METRICS)


@query(
    "a19_same_day_ties",
    """
SELECT 'mae' AS metric, first(run_id ORDER BY value, trained_at, run_id) AS best_run, min(value) AS best_value,
  first(run_id ORDER BY value DESC, trained_at, run_id) AS worst_run, max(value) AS worst_value
FROM (SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS trained_at, CAST(event_id % 3 AS DOUBLE) AS value FROM events) AS e
""",
)
def a19_ties(spark, sf):
    """Many runs of one day with equal metrics: the time of day decides, then the id."""
    runs = src.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("trained_at"),
        (F.col("event_id") % 3).cast("double").alias("mae"),
    )
    return metrics.best_and_worst(runs, ["mae"])


@query(
    "a20_linear_trend",
    f"""
SELECT metric, count(*) AS n_runs, round(regr_slope(value, d), 8) AS slope, round(regr_intercept(value, d), 4) AS intercept,
  CASE WHEN regr_slope(value, d) > 0 THEN 'rising' ELSE 'falling' END AS direction
FROM (SELECT metric, value, trained_at - min(trained_at) OVER () AS d FROM ({long_sql('trained_at', 'value')}) AS l) AS x GROUP BY 1
""",
    "runs",
)
def a20(spark, sf):
    out = metrics.linear_trend(src.runs(spark, sf), RUN_METRICS)
    return rounded(rounded(out, 8, "slope"), 4, "intercept")


HIST = """
, ends AS (SELECT {k} min(v) AS lo, max(v) AS hi, count(*) AS total, (max(v) - min(v)) / {n} AS width FROM ({t}) AS s {g}),
edges AS (SELECT *, CAST(unnest(generate_series(0, {n} - 1)) AS INTEGER) AS bin FROM ends),
counts AS (SELECT {sk} CAST(least(floor((v - lo) / width), {n} - 1) AS INTEGER) AS bin, count(*) AS n FROM ({t}) AS s {j} GROUP BY ALL)
SELECT {ek} edges.bin, round(lo + width * edges.bin, 6) AS left_edge, coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * width), 10) AS density
FROM edges LEFT JOIN counts ON counts.bin = edges.bin {jk}
"""


@query(
    "a21_histogram",
    HIST.format(k="", sk="", ek="", n=40, t="SELECT abs_error AS v FROM fc1", g="", j=", ends", jk=""),
    "fc1",
)
def a21(spark, sf):
    out = distribution.histogram(src.fc1(spark, sf), "abs_error", 40)
    return rounded(rounded(out, 6, "left_edge"), 10, "density")


@query(
    "a21_histogram_keyed",
    ("WITH base AS (SELECT l_returnflag AS k, l_extendedprice AS v FROM lineitem)" + HIST).format(
        k="k,", sk="s.k,", ek="edges.k,", n=60, t="SELECT * FROM base", g="GROUP BY k",
        j="JOIN ends ON ends.k = s.k", jk="AND counts.k = edges.k",
    ),
)
def a21_keyed(spark, sf):
    rows = src.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("k"), "l_extendedprice")
    out = distribution.histogram(rows, "l_extendedprice", 60, ["k"])
    return rounded(rounded(out, 6, "left_edge"), 10, "density")


@query(
    "a21_null_key",
    "SELECT nullif(k, '~') AS k, bin, left_edge, n, density FROM ("
    + ("WITH base AS (SELECT coalesce(nullif(l_returnflag, 'R'), '~') AS k, l_extendedprice AS v FROM lineitem)" + HIST).format(
        k="k,", sk="s.k,", ek="edges.k,", n=60, t="SELECT * FROM base", g="GROUP BY k",
        j="JOIN ends ON ends.k = s.k", jk="AND counts.k = edges.k",
    )
    + ") AS h",
)
def a21_null(spark, sf):
    out = distribution.histogram(with_null_key(spark, sf), "l_extendedprice", 60, ["k"])
    return rounded(rounded(out, 6, "left_edge"), 10, "density")


@query(
    "a22_box_statistics",
    """
SELECT l_returnflag, round(any_value(q1), 5) AS q1, round(any_value(q2), 5) AS median, round(any_value(q3), 5) AS q3,
  min(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (NOT l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT l.*, q1, q2, q3 FROM lineitem l JOIN (SELECT l_returnflag AS f, quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1) q ON f = l_returnflag) AS x
GROUP BY 1
""",
)
def a22(spark, sf):
    out = distribution.box_statistics(src.table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return rounded(out, 5, "q1", "median", "q3")


@query(
    "a22_null_key",
    """
SELECT k, round(any_value(q1), 5) AS q1, round(any_value(q2), 5) AS median, round(any_value(q3), 5) AS q3,
  min(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (NOT l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT l.*, nullif(l_returnflag, 'R') AS k, q1, q2, q3 FROM lineitem l JOIN (SELECT nullif(l_returnflag, 'R') AS f, quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1) q ON f IS NOT DISTINCT FROM nullif(l_returnflag, 'R')) AS x
GROUP BY 1
""",
)
def a22_null(spark, sf):
    out = distribution.box_statistics(with_null_key(spark, sf), "l_extendedprice", ["k"])
    return rounded(out, 5, "q1", "median", "q3")


@query(
    "a23_kernel_density",
    """
, s AS (SELECT min(error) AS lo, max(error) AS hi, count(*) AS n, stddev_samp(error) * pow(count(*), -0.2) AS h FROM fc1),
g AS (SELECT CAST(unnest(generate_series(0, 199)) AS INTEGER) AS i)
SELECT i, round(x, 4) + 0.0 AS x, round(sum(exp(-((x - error) / h) * ((x - error) / h) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 12) AS density
FROM (SELECT i, lo + (hi - lo) * i / 199 AS x, n, h FROM g, s) AS p, fc1 GROUP BY i, x
""",
    "fc1",
)
def a23(spark, sf):
    out = distribution.kernel_density(src.fc1(spark, sf), "error", error=None)
    return rounded(rounded(out, 4, "x"), 12, "density")


@query(
    "a23_binned_density",
    """
, s AS (SELECT l_returnflag AS k, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n, stddev_samp(l_extendedprice) * pow(count(*), -0.2) AS h FROM lineitem GROUP BY 1),
p AS (SELECT k, CAST(unnest(generate_series(0, 39)) AS INTEGER) AS i, lo, hi, n, h FROM s)
SELECT p.k, i, round(any_value(lo + (hi - lo) * i / 39), 4) AS x,
  round(sum(exp(-pow((lo + (hi - lo) * i / 39 - l_extendedprice) / h, 2) / 2)) / any_value(n), 5) AS share
FROM p JOIN lineitem ON l_returnflag = p.k GROUP BY 1, 2
""".replace(", s AS", "WITH s AS", 1),
)
def a23_binned(spark, sf):
    """Kernel sums over the whole table from fine bins, as shares of a kernel's peak."""
    rows = src.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("k"), "l_extendedprice")
    out = distribution.kernel_density(rows, "l_extendedprice", 40, ["k"], error=1e-10)
    peak = rows.groupBy("k").agg((F.stddev_samp("l_extendedprice") * F.pow(F.count(F.lit(1)), F.lit(-0.2)) * F.sqrt(2 * F.pi())).alias("peak"))
    share = F.round(F.col("density") * F.col("peak"), 5).alias("share")
    return out.join(peak, "k").select("k", "i", F.round("x", 4).alias("x"), share)


@query(
    "a24_normal_overlay",
    """
, s AS (SELECT min(error) AS lo, max(error) AS hi, avg(error) AS mu, stddev_samp(error) AS sd FROM fc1)
SELECT i, round(x, 4) + 0.0 AS x, round(exp(-((x - mu) / sd) * ((x - mu) / sd) / 2) / (sd * sqrt(2 * pi())), 12) AS density
FROM (SELECT CAST(i AS INTEGER) AS i, lo + (hi - lo) * i / 199 AS x, mu, sd FROM s, (SELECT unnest(generate_series(0, 199)) AS i) AS g) AS p
""",
    "fc1",
)
def a24(spark, sf):
    out = distribution.normal_overlay(src.fc1(spark, sf), "error")
    return rounded(rounded(out, 4, "x"), 12, "density")


def horner(coefficients, x):
    """A polynomial as SQL, lowest power first."""
    out = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def quotient(parts, x):
    return f"{horner(parts[0], x)} / {horner(parts[1], x)}"


QQ_SQL = f"""
, o AS (SELECT error AS observed, CAST(row_number() OVER (ORDER BY error) AS INTEGER) AS i, count(*) OVER () AS n FROM fc1),
p AS (SELECT *, CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n)
  ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM o),
t AS (SELECT *, p - 0.5::DOUBLE AS q, sqrt(-ln(least(p, 1 - p))) AS r FROM p),
z AS (SELECT i, observed, CASE WHEN abs(q) <= 0.425 THEN q * {quotient(distribution.MIDDLE, "(0.180625::DOUBLE - q * q)")}
  ELSE sign(q) * CASE WHEN r <= 5 THEN {quotient(distribution.NEAR, "(r - 1.6::DOUBLE)")} ELSE {quotient(distribution.FAR, "(r - 5.0::DOUBLE)")} END END AS theoretical FROM t)
"""


@query("a25_normal_qq", QQ_SQL + "SELECT i, round(theoretical, 9) AS theoretical, observed FROM z", "fc1")
def a25(spark, sf):
    return rounded(distribution.normal_qq(src.fc1(spark, sf), "error"), 9, "theoretical")


@query(
    "a25_normal_qq_line",
    QQ_SQL
    + "SELECT round(regr_slope(observed, theoretical), 4) AS slope, round(regr_intercept(observed, theoretical), 4) AS intercept,"
    " round(corr(observed, theoretical), 9) AS r FROM z",
    "fc1",
)
def a25_line(spark, sf):
    line = distribution.qq_line(distribution.normal_qq(src.fc1(spark, sf), "error"))
    return rounded(rounded(line, 4, "slope", "intercept"), 9, "r")


@query(
    "a25_normal_qq_lineitem",
    """
SELECT k, CAST(i AS INTEGER) AS i, round(l_extendedprice, 2) AS observed, count(*) OVER (PARTITION BY k) AS n FROM
  (SELECT l_returnflag AS k, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS i FROM lineitem) AS r
""",
)
def a25_lineitem(spark, sf):
    """Ranks of a fact table's values per key, ranked by ranges of values."""
    rows = src.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("k"), "l_extendedprice")
    out = opened(ranked_values(rows, ["k"], "l_extendedprice"), "i")
    return out.select("k", (F.col("i") + 1).cast("int").alias("i"), F.round("l_extendedprice", 2).alias("observed"), F.col("total").alias("n"))


@query(
    "a26_worst_peak_mean",
    """
SELECT horizon, round(avg(abs_error), 4) AS mean_abs_error FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY abs_error DESC, date) AS rn
FROM fc_peaks WHERE is_peak) AS x WHERE rn <= 20 GROUP BY 1
""",
    "fc_peaks",
)
def a26(spark, sf):
    worst = peaks.worst_peaks(peaks.with_peaks(src.fc(spark, sf), ["horizon"], 28), ["horizon"])
    return worst.groupBy("horizon").agg(F.round(F.avg("abs_error"), 4).alias("mean_abs_error"))
