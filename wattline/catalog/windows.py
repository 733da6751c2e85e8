"""Window, sort and top-k queries (W, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.catalog.aggregates import RUN_METRICS, rounded
from wattline.catalog.registry import query
from wattline.catalog.relational import ORIGINS
from wattline.functions.columns import parse_date, year_from_name
from wattline.operators import joins, peaks, rolling, topk
from wattline.operators.frames import by_date
from wattline.operators.gaps import densify
from wattline.operators.reduction import components_needed, with_cumulative
from wattline.plans import adapters as src
from wattline.sources.registry import APPENDED, capped


@query(
    "w01_moving_mean",
    "SELECT date, CASE WHEN count(y) OVER w >= 15 THEN round(avg(y) OVER w, 4) END AS mean30 FROM filled"
    " WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)",
    "filled",
)
def w01(spark, sf):
    mean = rolling.moving_mean(F.col("y"), [], 30, 15)
    return src.filled(spark, sf).select("date", F.round(mean, 4).alias("mean30"))


@query(
    "w01_moving_mean_keyed",
    "SELECT series, date, CASE WHEN count(y) OVER w >= 15 THEN round(avg(y) OVER w, 3) END AS mean30 FROM keyed_dense"
    " WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)",
    "keyed_dense",
)
def w01_keyed(spark, sf):
    mean = rolling.moving_mean(F.col("y"), ["series"], 30, 15)
    dense = densify(src.keyed_daily(spark, sf), ["series"])
    return dense.select("series", "date", F.round(mean, 3).alias("mean30"))


@query(
    "w02_rolling_errors",
    "SELECT horizon, date, round(rolling_mae, 4) AS rolling_mae, round(rolling_rmse, 4) AS rolling_rmse FROM fc_rolled",
    "fc_rolled",
)
def w02(spark, sf):
    return rounded(rolling.rolling_errors(src.fc(spark, sf), ["horizon"]), 4, "rolling_mae", "rolling_rmse")


@query(
    "w03_context_statistics",
    "SELECT horizon, date, context_count, round(threshold_context, 5) AS threshold_context FROM fc_peaks",
    "fc_peaks",
)
def w03(spark, sf):
    out = peaks.context_stats(src.fc(spark, sf), ["horizon"])
    return rounded(out, 5, "threshold_context").select("horizon", "date", "context_count", "threshold_context")


@query(
    "w04_contextual_peaks",
    "SELECT horizon, date, round(peak_threshold, 5) AS peak_threshold, is_peak FROM fc_peaks",
    "fc_peaks",
)
def w04(spark, sf):
    out = peaks.with_peaks(src.fc(spark, sf), ["horizon"], 28)
    return rounded(out, 5, "peak_threshold").select("horizon", "date", "peak_threshold", "is_peak")


KEYS = ["model", "horizon"]
SUMMARY = """
, summary AS (SELECT model, horizon, avg(abs_error / greatest(abs(actual), 2.220446049250313e-16)) * 100 AS mape, avg(abs_error) AS mae, sqrt(avg(sq_error)) AS rmse,
  avg(abs_error) FILTER (is_peak) AS peak_mae, sqrt(avg(sq_error) FILTER (is_peak)) AS peak_rmse FROM model_peaks GROUP BY 1, 2),
ranked AS (SELECT *, """ + ", ".join(
    f"CAST(rank() OVER (PARTITION BY horizon ORDER BY {m}) AS INTEGER) AS rank_{m}" for m in peaks.RANKED
) + """ FROM summary),
scored AS (SELECT *, 0.45::DOUBLE * rank_peak_rmse + 0.35::DOUBLE * rank_peak_mae + 0.2::DOUBLE * rank_rmse AS rank_peak_priority FROM ranked)
"""  # fmt: skip


def scored(spark, sf):
    flagged = peaks.with_peaks(src.forecast_log(spark, sf), KEYS, 28)
    return peaks.with_priority(peaks.with_ranks(peaks.backtest_summary(flagged, KEYS)))


RANKS = ", ".join(f"rank_{m}" for m in peaks.RANKED)


@query("w05_ranks", SUMMARY + f"SELECT model, horizon, {RANKS} FROM scored", "model_peaks")
def w05(spark, sf):
    return scored(spark, sf).select(*KEYS, *[f"rank_{m}" for m in peaks.RANKED])


@query(
    "w06_best_models",
    SUMMARY
    + "SELECT horizon, "
    + ", ".join(
        f"first(model ORDER BY {c}, model) AS best_{c.removeprefix('rank_')}"
        for c in ("peak_rmse", "peak_mae", "rmse", "mape", "rank_peak_priority")
    )
    + " FROM scored GROUP BY 1",
    "model_peaks",
)
def w06(spark, sf):
    return peaks.best_models(scored(spark, sf))


@query(
    "w06_priority_score",
    SUMMARY + "SELECT model, horizon, round(rank_peak_priority, 6) AS rank_peak_priority FROM scored",
    "model_peaks",
)
def w06_score(spark, sf):
    return rounded(scored(spark, sf).select(*KEYS, "rank_peak_priority"), 6, "rank_peak_priority")


LONG_RUNS = " UNION ALL ".join(f"SELECT trained_at, '{m}' AS metric, {m} AS value FROM runs" for m in RUN_METRICS)


@query(
    "w07_latest_change",
    f"""
SELECT metric, previous, latest, latest - previous AS delta, CASE WHEN previous = 0 THEN 0 ELSE (latest - previous) / previous * 100 END AS pct_change
FROM (SELECT metric, value AS latest, lag(value) OVER (PARTITION BY metric ORDER BY trained_at) AS previous,
  row_number() OVER (PARTITION BY metric ORDER BY trained_at DESC) AS n FROM ({LONG_RUNS}) AS l) AS x WHERE n = 1
""",
    "runs",
)
def w07(spark, sf):
    return rolling.latest_change(src.runs(spark, sf), RUN_METRICS)


@query(
    "w08_normalised",
    "SELECT run_id, mae / min(mae) OVER () AS mae, rmse / min(rmse) OVER () AS rmse FROM runs",
    "runs",
)
def w08(spark, sf):
    return rolling.normalised_by_min(src.runs(spark, sf).select("run_id", "mae", "rmse"), ["mae", "rmse"])


SHARES = """
, shares AS (SELECT variable, station, var_samp(value) AS v FROM stations GROUP BY 1, 2),
parts AS (SELECT variable, CAST(row_number() OVER (PARTITION BY variable ORDER BY v DESC, station) AS INTEGER) AS component, v / sum(v) OVER (PARTITION BY variable) AS ratio FROM shares),
running AS (SELECT *, sum(ratio) OVER (PARTITION BY variable ORDER BY component) AS cumulative FROM parts)
"""


@query(
    "w09_components_needed",
    SHARES + "SELECT variable, t AS threshold, coalesce(min(component) FILTER (cumulative >= t), max(component)) AS components_needed"
    " FROM running, (SELECT unnest([0.8::DOUBLE, 0.9::DOUBLE, 0.95::DOUBLE]) AS t) AS ts GROUP BY 1, 2",
    "stations",
)
def w09(spark, sf):
    spread = src.stations(spark, sf).groupBy("variable", "station").agg(F.var_samp("value").alias("v"))
    total = spread.groupBy("variable").agg(F.sum("v").alias("total"))
    order = F.row_number().over(by_date(["variable"], F.desc("v"))).alias("component")
    parts = spread.join(total, "variable").select(
        "variable", order, (F.col("v") / F.col("total")).alias("ratio")
    )
    return components_needed(with_cumulative(parts, ["variable"]), [0.8, 0.9, 0.95], ["variable"])


@query(
    "w10_melt",
    " UNION ALL ".join(f"SELECT run_id, '{m}' AS metric, {m} AS value FROM runs" for m in RUN_METRICS),
    "runs",
)
def w10(spark, sf):
    return src.runs(spark, sf).unpivot(["run_id"], RUN_METRICS, "metric", "value")


@query(
    "w11_decomposition",
    """
, ma AS (SELECT date, y, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n,
  CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS ma FROM filled WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
lines AS (SELECT regr_slope(ma, pos) FILTER (pos BETWEEN 3 AND 9) AS kh, regr_intercept(ma, pos) FILTER (pos BETWEEN 3 AND 9) AS bh,
  regr_slope(ma, pos) FILTER (pos BETWEEN n - 11 AND n - 5) AS kt, regr_intercept(ma, pos) FILTER (pos BETWEEN n - 11 AND n - 5) AS bt FROM ma),
tr AS (SELECT date, y, pos, CASE WHEN pos < 3 THEN kh * pos + bh WHEN pos > n - 4 THEN kt * pos + bt ELSE ma END AS trend FROM ma, lines),
ph AS (SELECT pos % 7 AS phase, avg(y - trend) AS a FROM tr GROUP BY 1),
se AS (SELECT phase, a - avg(a) OVER () AS seasonal FROM ph)
SELECT date, y AS observed, round(trend, 3) AS trend, round(seasonal, 3) AS seasonal, round(y - trend - seasonal, 3) + 0.0 AS residual FROM tr JOIN se ON phase = pos % 7
""",
    "filled",
)
def w11(spark, sf):
    out = rolling.decompose(src.filled(spark, sf), "y")
    return rounded(out, 3, "trend", "seasonal", "residual")


@query(
    "w12_autocovariance",
    """
, x AS (SELECT row_number() OVER (ORDER BY date) AS pos, y - avg(y) OVER () AS v, count(*) OVER () AS n FROM filled)
SELECT CAST(k AS INTEGER) AS lag, any_value(a.n) AS n, round(sum(a.v * b.v) / any_value(a.n), 0) + 0.0 AS autocov
FROM generate_series(0, 14) AS g(k), x a JOIN x b ON b.pos = a.pos + k GROUP BY 1
""",
    "filled",
)
def w12(spark, sf):
    out = rolling.autocovariance(src.filled(spark, sf), "y", 14)
    return rounded(out.select("lag", "n", "autocov"), 0, "autocov")


@query(
    "l01_sort_nulls_last",
    'SELECT row_pos, strftime(try_strptime("Date", \'%d/%m/%Y\'), \'%Y-%m-%d\') AS day, 2024 AS source_year FROM raw_text',
    "raw_text",
)
def l01(spark, sf):
    rows = src.raw_text(spark, sf).select(
        "row_pos",
        F.date_format(parse_date(F.col("Date")), "yyyy-MM-dd").alias("day"),
        year_from_name(F.col("source_file")).alias("source_year"),
    )
    return rows.orderBy(F.asc_nulls_last("day"), "source_year", "row_pos")


@query("l02_sort_by_date", "SELECT date, y FROM daily ORDER BY date", "daily")
def l02(spark, sf):
    return src.daily(spark, sf).orderBy("date")


@query(
    "l03_worst_peaks",
    """
SELECT horizon, date, actual, predicted, error, abs_error, error / actual * 100 AS signed_pct_error FROM (
  SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY abs_error DESC, date) AS n FROM fc_peaks WHERE is_peak) AS x WHERE n <= 20
""",
    "fc_peaks",
)
def l03(spark, sf):
    worst = peaks.worst_peaks(peaks.with_peaks(src.fc(spark, sf), ["horizon"], 28), ["horizon"])
    return worst.select("horizon", "date", "actual", "predicted", "error", "abs_error", "signed_pct_error")


@query(
    "l04_top_rows",
    "SELECT station, n_days FROM (SELECT station, count(*) AS n_days FROM station_days GROUP BY 1) AS x ORDER BY n_days, station LIMIT 15",
    "station_days",
)
def l04(spark, sf):
    days = src.stations(spark, sf).where(F.col("variable") == "TN").groupBy("station")
    return topk.top_rows(days.agg(F.count(F.lit(1)).alias("n_days")), [F.asc("n_days"), F.asc("station")], 15)


@query(
    "l04_top_per_group",
    """SELECT l_returnflag, l_orderkey, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag
  ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber) AS n FROM lineitem) AS x WHERE n <= 10""",
)
def l04_group(spark, sf):
    rows = src.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_partkey"), F.asc("l_linenumber")]
    return topk.top_per_group(rows, ["l_returnflag"], order, 10).drop("l_linenumber")


@query(
    "l05_registry_cap",
    """
SELECT run_id, trained_at, last_value(run_id) OVER (ORDER BY late, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  AS latest_run_id, count(*) OVER () AS n_runs
FROM (SELECT run_id, trained_at, month(trained_at) = 6 AND year(trained_at) < 2000 AS late FROM runs ORDER BY late DESC, run_id DESC LIMIT 7) AS x
""",
    "runs",
)
def l05(spark, sf):
    """Old June windows were backfilled after all other runs, so they count as the newest."""
    runs = src.late_backfill(src.runs(spark, sf).select("run_id", "trained_at"))
    return capped(runs, 7).drop(APPENDED)


@query("l06_newest_first", "SELECT run_id, trained_at, mae FROM runs ORDER BY trained_at DESC", "runs")
def l06(spark, sf):
    return src.runs(spark, sf).select("run_id", "trained_at", "mae").orderBy(F.desc("trained_at"))


@query(
    "l07_example_starts",
    ORIGINS + "SELECT start_date FROM (SELECT start_date, row_number() OVER (ORDER BY start_date) - 1 AS i, count(*) OVER () AS n FROM starts) AS x"
    " WHERE i IN (0, n // 2, n - 1)",
    "filled",
)
def l07(spark, sf):
    return topk.first_middle_last(joins.origins(src.filled(spark, sf), 14, 14, 365), "start_date")


@query(
    "l08_first_days",
    "SELECT date, y FROM (SELECT *, row_number() OVER (ORDER BY date) AS n FROM filled) AS x WHERE n <= 730",
    "filled",
)
def l08(spark, sf):
    return rolling.row_range(src.filled(spark, sf), 1, 730)


@query("l09_evaluation_origins", ORIGINS + "SELECT start_date FROM starts", "filled")
def l09(spark, sf):
    return joins.origins(src.filled(spark, sf), 14, 14, 365)


@query(
    "l09_last_steps",
    "SELECT date, y FROM (SELECT *, row_number() OVER (ORDER BY date DESC) AS n FROM filled) AS x WHERE n <= 1000",
    "filled",
)
def l09_steps(spark, sf):
    return rolling.last_rows(src.filled(spark, sf), 1000)
