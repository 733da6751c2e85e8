"""Model, diagnostic and pipeline queries (D, M, X-05, X-06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.catalog.aggregates import rounded
from wattline.catalog.registry import VIEWS, query
from wattline.functions.columns import cyclicals
from wattline.operators import arx, backtest, diagnostics, peaks, rolling
from wattline.operators import regression as reg
from wattline.operators.checkpoints import half_year_ends
from wattline.operators.gaps import densify, interpolate_time, lagged
from wattline.operators.metrics import error_metrics
from wattline.operators.reduction import national_projection
from wattline.plans import adapters as src
from wattline.plans import training
from wattline.plans.gold import CALENDAR, TARGET, ModelReady, model_ready
from wattline.plans.monitoring import monitoring_report
from wattline.plans.silver import build_silver
from wattline.session import cut, stored, work_path

FEATURES = ["temp_pc_01", "temp_pc_02", "temp_pc_03", "production_mw_lag1"]


def gold(spark, sf) -> ModelReady:
    """Model-ready table from the silver layer: grid, both temperature variables, three components; built once a session."""

    def build():
        silver, _ = build_silver(src.grid(spark, sf), cut(src.stations(spark, sf, "region"), "stations"))
        return silver

    return model_ready(stored(spark, f"silver-of-{sf}", build))


def base_spec() -> arx.Spec:
    return arx.Spec(features=tuple(FEATURES))


def fitted_run(spark, sf):
    return training.train(gold(spark, sf), base_spec(), "20010801T000000Z")


ACF_SQL = """
, x AS (SELECT row_number() OVER (ORDER BY date) AS pos, y - avg(y) OVER () AS v, count(*) OVER () AS n FROM filled),
r AS (SELECT CAST(k AS INTEGER) AS lag, any_value(a.n) AS n, sum(a.v * b.v) / (SELECT sum(v * v) FROM x) AS acf
  FROM generate_series(0, 40) AS g(k), x a JOIN x b ON b.pos = a.pos + k GROUP BY 1)
"""


@query(
    "d01_acf",
    ACF_SQL
    + """SELECT lag, round(acf, 6) + 0.0 AS acf, CASE WHEN lag = 0 THEN 0 ELSE round(1.959963984540054::DOUBLE * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
  OVER (ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n), 6) END AS band FROM r""",
    "filled",
)
def d01(spark, sf):
    return rounded(diagnostics.acf(src.filled(spark, sf), "y", 40), 6, "acf", "band")


@query(
    "d02_pacf",
    ACF_SQL
    + """, rl AS (SELECT list(acf ORDER BY lag) AS r, any_value(n) AS n FROM r)
SELECT CAST(lag AS INTEGER) AS lag, round(pacf, 6) + 0.0 AS pacf, CASE WHEN lag = 0 THEN 0 ELSE round(1.959963984540054::DOUBLE / sqrt(n), 6) END AS band FROM (
  WITH RECURSIVE dl AS (
    SELECT 1 AS k, [r[2]] AS phi, r[2] AS top, r, n FROM rl
    UNION ALL
    SELECT k + 1, list_append(list_transform(phi, lambda x, j: x - nxt * phi[k + 1 - j]), nxt), nxt, r, n FROM (
      SELECT *, (r[k + 2] - list_sum(list_transform(phi, lambda x, j: x * r[k + 2 - j])))
        / (1 - list_sum(list_transform(phi, lambda x, j: x * r[j + 1]))) AS nxt FROM dl WHERE k < 40) AS s)
  SELECT k AS lag, top AS pacf, n FROM dl UNION ALL SELECT 0, 1.0, n FROM rl) AS p
""",
    "filled",
)
def d02(spark, sf):
    return rounded(diagnostics.pacf(src.filled(spark, sf), "y", 40), 6, "pacf", "band")


def keyed_filled(spark, sf):
    return interpolate_time(densify(src.keyed_daily(spark, sf), ["series"]), ["y"], ["series"])


@query("d03_adf")
def d03(spark, sf):
    return diagnostics.adf(cut(keyed_filled(spark, sf), "series"), "y", ["series"])


@query("d04_kpss")
def d04(spark, sf):
    return diagnostics.kpss(cut(keyed_filled(spark, sf), "series"), "y", ["series"])


@query(
    "d03_adf_fixed_lag",
    """
, k AS (SELECT series, date, y, y - lag(y) OVER w AS d, lag(y) OVER w AS l FROM keyed_filled WINDOW w AS (PARTITION BY series ORDER BY date)),
d AS (SELECT *, lag(d) OVER (PARTITION BY series ORDER BY date) AS d1 FROM k),
s AS (SELECT series, count(*) AS n, regr_sxx(d, l) AS s11, regr_sxx(d, d1) AS s22, regr_sxy(l, d1) AS s12, regr_sxy(d, l) AS s1y, regr_sxy(d, d1) AS s2y, regr_syy(d, l) AS syy
  FROM d WHERE d1 IS NOT NULL GROUP BY 1),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM s)
SELECT series, 0::INTEGER AS lags, count(*) AS n,
  round(regr_slope(d, l) / sqrt((regr_syy(d, l) - regr_slope(d, l) * regr_sxy(d, l)) / (count(*) - 2) / regr_sxx(d, l)), 6) AS statistic
FROM d WHERE l IS NOT NULL GROUP BY 1
UNION ALL SELECT series, 1, n, round(b1 / sqrt((syy - b1 * s1y - b2 * s2y) / (n - 3) * s22 / det), 6) FROM b
""",
    "keyed_filled",
)
def d03_fixed(spark, sf):
    series = cut(keyed_filled(spark, sf), "series")
    found = [diagnostics.adf(series, "y", ["series"], lags=k) for k in (0, 1)]
    return rounded(found[0].unionByName(found[1]).select("series", "lags", "n", "statistic"), 6, "statistic")


@query("d05_residual_bundle")
def d05(spark, sf):
    r = src.fc1(spark, sf).select("date", (F.col("actual") - F.col("predicted")).alias("residual"))
    return diagnostics.residual_bundle(cut(r, "residuals"), "residual")


# The residuals are the errors with the other sign, so their order turns round and normal quantiles change sign.
@query(
    "d05_residual_sections",
    """
, e AS (SELECT date, actual - predicted AS r FROM fc1 WHERE actual IS NOT NULL AND predicted IS NOT NULL),
s AS (SELECT date, (r - avg(r) OVER ()) / stddev_samp(r) OVER () AS z FROM e),
m AS (SELECT min(z) AS lo, max(z) AS hi, count(*) AS n, stddev_samp(z) * pow(count(*), -0.2) AS h, avg(z) AS mean FROM s),
c AS (SELECT z - mean AS v, row_number() OVER (ORDER BY date) AS pos, n FROM s, m),
acf AS (SELECT CAST(k AS DOUBLE) AS x, sum(a.v * b.v) / (SELECT sum(v * v) FROM c) AS y FROM generate_series(0, 40) AS g(k), c a JOIN c b ON b.pos = a.pos + k GROUP BY 1),
bins AS (SELECT CAST(unnest(generate_series(0, 39)) AS INTEGER) AS i),
held AS (SELECT CAST(least(floor((z - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS i, count(*) AS k FROM s, m GROUP BY 1),
points AS (SELECT unnest(generate_series(0, 199)) AS i)
SELECT 'standardised' AS section, CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE) AS x, round(z, 5) + 0.0 AS y FROM s
UNION ALL SELECT 'histogram', round(lo + (hi - lo) / 40 * bins.i, 5) + 0.0, round(coalesce(k, 0) / (n * (hi - lo) / 40), 5) FROM bins LEFT JOIN held ON held.i = bins.i, m
UNION ALL SELECT 'density', round(lo + (hi - lo) * i / 199, 5) + 0.0, round(sum(exp(-pow((lo + (hi - lo) * i / 199 - z) / h, 2) / 2)) / any_value(n * h * sqrt(2 * pi())), 5) FROM points, m, s GROUP BY i, lo, hi
UNION ALL SELECT 'correlogram', x, round(y, 5) + 0.0 FROM acf
""",
    "fc1",
)
def d05_sections(spark, sf):
    """The bundle without its Q-Q points, which have a query of their own."""
    r = src.fc1(spark, sf).select("date", (F.col("actual") - F.col("predicted")).alias("residual"))
    out = diagnostics.residual_bundle(cut(r, "residuals"), "residual", error=1e-10).where("section <> 'qq'")
    return rounded(out, 5, "x", "y")


@query(
    "d06_residual_health",
    """
SELECT model, horizon, round(std, 4) AS std, CASE WHEN txt = '' THEN 'OK' ELSE txt END AS health FROM (
  SELECT model, horizon, std, concat_ws(', ', CASE WHEN abs(sk) > 1 THEN 'skewness=' || printf('%.2f', sk) END,
    CASE WHEN ku > 3 THEN 'kurtosis=' || printf('%.2f', ku) END, CASE WHEN out > 10 THEN printf('%.1f', out) || '% outside 2 sigma' END) AS txt
  FROM (SELECT model, horizon, any_value(sd) AS std, skewness(r) AS sk, kurtosis(r) AS ku, 100 * avg(CASE WHEN abs(r) > 2 * sd THEN 1.0 ELSE 0.0 END) AS out
    FROM (SELECT model, horizon, actual - predicted AS r, stddev_samp(actual - predicted) OVER (PARTITION BY model, horizon) AS sd FROM flog) AS a GROUP BY 1, 2) AS b) AS c
""",
    "flog",
)
def d06(spark, sf):
    r = src.forecast_log(spark, sf).withColumn("residual", F.col("actual") - F.col("predicted"))
    table = diagnostics.health_table(r, "residual", ["model", "horizon"])
    return table.select("model", "horizon", F.round("std", 4).alias("std"), "health")


@query(
    "m01_least_squares",
    """
, f AS (SELECT station, regr_slope(TX, TN) AS b, regr_intercept(TX, TN) AS a, regr_syy(TX, TN) - regr_slope(TX, TN) * regr_sxy(TX, TN) AS rss, regr_sxx(TX, TN) AS sxx, count(*) AS n FROM station_days GROUP BY 1)
SELECT station, 'TN' AS term, round(b, 6) AS coef, round(sqrt(rss / (n - 2) / sxx), 6) AS se, n FROM f
UNION ALL SELECT station, 'intercept', round(a, 6), round(sqrt(rss / (n - 2) * (1.0 / n + m * m / sxx)), 6), n FROM (SELECT f.*, m FROM f JOIN (SELECT station, avg(TN) AS m FROM station_days GROUP BY 1) AS t USING (station)) AS x
""",
    "station_days",
)
def m01(spark, sf):
    wide = src.stations(spark, sf).groupBy("date", "station").pivot("variable", ["TN", "TX"]).agg(F.first("value"))
    out = reg.least_squares(wide, ["station"], ["TN"], "TX")
    return rounded(out.select("station", "term", "coef", "se", "n"), 6, "coef", "se")


@query(
    "m01_far_from_zero",
    """
SELECT l_returnflag, 'x' AS term, round(regr_slope(y, x), 6) AS coef, count(*) AS n FROM (SELECT l_returnflag,
  CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem) AS t GROUP BY 1
""",
)
def m01_far(spark, sf):
    """A predictor ten million away from zero has the slope it has at zero."""
    rows = src.table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_quantity").cast("double") + 1e7).alias("x"), F.col("l_extendedprice").alias("y")
    )
    out = reg.least_squares(rows, ["l_returnflag"], ["x"], "y").where("term = 'x'")
    return rounded(out.select("l_returnflag", "term", "coef", "n"), 6, "coef")


@query(
    "m02_lag_design",
    """
, b AS (SELECT date, y - lag(y, 7) OVER (ORDER BY date) AS w0, p - lag(p, 7) OVER (ORDER BY date) AS z0_p FROM (SELECT date, y, lag(y, 1) OVER (ORDER BY date) AS p FROM filled) AS t)
SELECT date, w0, z0_p, lag(w0, 1) OVER (ORDER BY date) AS w1, lag(w0, 7) OVER (ORDER BY date) AS w7, lag(w0, 16) OVER (ORDER BY date) AS w16, lag(z0_p, 1) OVER (ORDER BY date) AS z1_p FROM b
""",
    "filled",
)
def m02(spark, sf):
    series = src.filled(spark, sf).withColumn("p", lagged("y", 1))
    rows = arx.design(series, "y", arx.Spec(features=("p",)))
    return rows.select("date", "w0", "z0_p", "w1", "w7", "w16", "z1_p")


@query("m03_fit")
def m03(spark, sf):
    return fitted_run(spark, sf).fits.drop("predictor", "innovation")


@query("m03_fit_keyed")
def m03_keyed(spark, sf):
    """One model per customer nation: every series fitted in the same job."""
    series = keyed_filled(spark, sf).withColumns(cyclicals(F.col("date")))
    spec = arx.Spec(features=("doy_sin", "doy_cos"))
    rows = arx.design(series, "y", spec, ["series"])
    fits = arx.fit(reg.cross_products(rows, ["series"], spec.names), {"final": spec}, ["series"])
    return reg.fit_quality(fits).select("series", "n", "k", "rank", "rss", "aic", "coef")


@query(
    "m04_fit_quality",
    """
, f AS (SELECT station, regr_syy(TX, TN) - regr_slope(TX, TN) * regr_sxy(TX, TN) AS rss, count(*) AS n FROM station_days GROUP BY 1),
l AS (SELECT *, -n / 2 * (ln(2 * pi()) + ln(rss / n) + 1) AS ll FROM f)
SELECT station, round(ll, 4) AS llf, round(-2 * ll + 6, 4) AS aic, round(-2 * ll + 3 * ln(n), 4) AS bic FROM l
""",
    "station_days",
)
def m04(spark, sf):
    wide = src.stations(spark, sf).groupBy("date", "station").pivot("variable", ["TN", "TX"]).agg(F.first("value"))
    fits = reg.least_squares(wide, ["station"], ["TN"], "TX").where(F.col("term") == "TN")
    out = reg.fit_quality(fits.withColumn("k", F.lit(2))).select("station", "llf", "aic", "bic")
    return rounded(out, 4, "llf", "aic", "bic")


@query("m05_fitted")
def m05(spark, sf):
    return fitted_run(spark, sf).insample


@query("m06_recursive_forecast")
def m06(spark, sf):
    run = fitted_run(spark, sf)
    log, _ = backtest.recursive_evaluation(run.rows, run.fits, base_spec())
    return log


def feature_sets(features):
    """The three feature sets of the backtest inside one design."""
    wide = arx.Spec(features=tuple(features))
    return wide, {
        "full": wide,
        "significant": arx.Chosen(wide),
        "parsimonious": wide.of(features=tuple(f for f in features if f not in CALENDAR)),
    }


def walk_forward_log(spark, sf):
    table = gold(spark, sf)
    wide, specs = feature_sets(table.features)
    return backtest.walk_forward(training.design_table(table, wide), wide, specs)


@query("m07_walk_forward")
def m07(spark, sf):
    log = walk_forward_log(spark, sf)
    return error_metrics(log, ["model", "horizon"], count="n")


COEFS = """
, c AS (SELECT variable, station AS term, corr(value, dayofyear(date)) AS coef, CASE WHEN variable = 'TN' THEN CASE WHEN CAST(station AS INTEGER) % 3 = 0 THEN abs(corr(value, dayofyear(date))) END
    WHEN CAST(station AS INTEGER) < 2 THEN 0.01::DOUBLE END AS p FROM stations GROUP BY 1, 2),
t AS (SELECT *, count(p) OVER (PARTITION BY variable) AS known, row_number() OVER (PARTITION BY variable ORDER BY abs(coef) DESC, term) AS place FROM c)
SELECT variable, term, round(coef, 9) AS coef, round(p, 9) AS p, CASE WHEN known >= 3 THEN 'p-value' ELSE 'coefficient' END AS method FROM t
WHERE (known >= 3 AND coalesce(p <= 0.10, false)) OR (known < 3 AND place <= 4) OR term = '000000004'
"""


@query("m08_significant_features", COEFS, "stations")
def m08(spark, sf):
    """Selection over a table of one coefficient per station; TX has too few p-values."""
    r = F.corr("value", F.dayofyear("date").cast("double"))
    number = F.col("station").cast("int")
    coefs = (
        src.stations(spark, sf)
        .groupBy("variable", "station")
        .agg(r.alias("coef"))
        .withColumn(
            "p",
            F.when(F.col("variable") == "TN", F.when(number % 3 == 0, F.abs("coef"))).when(number < 2, 0.01),
        )
        .withColumnRenamed("station", "term")
    )
    return rounded(reg.significant_features(coefs, ["variable"], "000000004"), 9, "coef", "p")


@query(
    "m09_expanding_refits",
    """
, d AS (SELECT date, lag(y) OVER (ORDER BY date) AS x, y FROM filled), k AS (SELECT DISTINCT CAST(date_trunc('year', date) AS DATE) AS step FROM d WHERE x IS NOT NULL)
SELECT step, regr_count(y, x)::BIGINT AS n, round(regr_slope(y, x), 7) AS slope, round(regr_intercept(y, x), 3) AS intercept FROM k JOIN d ON date_trunc('year', d.date) <= step GROUP BY 1
""",
    "filled",
)
def m09(spark, sf):
    """Yearly refits of y on its lag from running cross-product sums."""
    rows = src.filled(spark, sf).select(
        F.trunc("date", "year").alias("step"), F.lit(1.0).alias("one"), lagged("y", 1).alias("x"), "y"
    )
    parts = reg.cross_products(rows, ["step"], ["one", "x", "y"]).withColumn("all", F.lit(0))
    sums = backtest.running_sums(parts, ["all"], "step", 3)
    g = F.col("products")
    n, sx, sy, sxx, sxy = g[0], g[1], g[2], g[4], g[5]
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    return sums.select(
        "step", "n", F.round(slope, 7).alias("slope"), F.round((sy - slope * sx) / n, 3).alias("intercept")
    )


@query(
    "m10_checkpoints",
    "SELECT checkpoint FROM half_years WHERE checkpoint <= (SELECT max(date) FROM daily)",
    "half_years daily",
)
def m10(spark, sf):
    bounds = src.daily(spark, sf).agg(F.max("date").alias("last"))
    return half_year_ends(bounds, "last", src.FIRST_CHECKPOINT)


def history(spark, sf, existing=None):
    return training.historical_runs(gold(spark, sf), base_spec(), src.FIRST_CHECKPOINT, existing)


@query("m11_backfill")
def m11(spark, sf):
    """The backfill resumed: runs before 1998 are registered already."""
    plan = half_year_ends(src.daily(spark, sf).agg(F.max("date").alias("last")), "last", src.FIRST_CHECKPOINT)
    done = plan.where(F.col("checkpoint") < F.lit("1998-01-01").cast("date")).select(
        F.concat(F.date_format("checkpoint", "yyyyMMdd"), F.lit("T000000Z")).alias("run_id")
    )
    found, _, _ = history(spark, sf, done)
    return found


@query("m12_order_search")
def m12(spark, sf):
    """Every order of the grid on the first two years, ranked by AIC."""
    table = gold(spark, sf)
    first = ModelReady(rolling.row_range(table.table, 1, 730), table.features, table.scaled)
    wide, models = backtest.order_grid(base_spec())
    search = backtest.order_search(training.design_table(first, wide), wide, models)
    return search.orderBy("aic", "model")


@query("m13_final_fits")
def m13(spark, sf):
    """The feature set that wins each horizon, fitted on everything."""
    table = gold(spark, sf)
    wide, specs = feature_sets(table.features)
    rows = training.design_table(table, wide)
    log = backtest.walk_forward(rows, wide, specs).withColumnRenamed("target_date", "date")
    keys = ["model", "horizon"]
    summary = peaks.backtest_summary(peaks.with_peaks(cut(log, "walk-forward"), keys), keys)
    picks = peaks.best_models(peaks.with_priority(peaks.with_ranks(summary)))
    sums = backtest.with_probe(reg.cross_products(rows, [], wide.names), rows, specs, 730)
    fits = reg.fit_quality(arx.fit(sums, specs))
    chosen = picks.select("horizon", F.col("best_peak_priority").alias("model"))
    return chosen.join(fits.drop("predictor", "innovation"), "model")


@query("m14_run_row")
def m14(spark, sf):
    return fitted_run(spark, sf).run


@query("m15_batch_scoring")
def m15(spark, sf):
    """Requests of every day scored by the run they name."""
    silver, fit = build_silver(src.grid(spark, sf), cut(src.stations(spark, sf, "region"), "stations"))
    table = model_ready(cut(silver, "silver"))
    spec = training.default_spec()
    _, fits, rows = training.historical_runs(table, spec, src.FIRST_CHECKPOINT)
    state = training.scoring_state(rows, fits, spec)
    runs = cut(training.with_scaler(state, table.table, spec), "scoring-state")
    return training.score_requests(src.requests(spark, sf), runs, national_projection(fit))


@query(
    "m18_seasonal_naive",
    "SELECT date, y AS actual, lag(y, 7) OVER (ORDER BY date) AS predicted FROM filled",
    "filled",
)
def m18(spark, sf):
    return src.filled(spark, sf).select("date", F.col("y").alias("actual"), lagged("y", 7).alias("predicted"))


@query("x05_train_register")
def x05(spark, sf):
    """Train, evaluate and register two runs in the runs table."""
    path = work_path(spark, "runs")
    table = gold(spark, sf)
    training.register(training.train(table, base_spec(), "20010801T000000Z").run, path)
    window = model_ready_until(table, "2000-12-31")
    runs = training.register(training.train(window, base_spec(), "20001231T000000Z").run, path)
    return runs.drop("appended_at", "commit_seq")


def model_ready_until(table: ModelReady, end: str) -> ModelReady:
    return ModelReady(table.table.where(F.col("date") <= F.lit(end).cast("date")), table.features, table.scaled)


@query("x06_monitoring_report")
def x06(spark, sf):
    run = fitted_run(spark, sf)
    insample = cut(run.insample, "insample")
    log, _ = backtest.recursive_evaluation(run.rows, run.fits, base_spec())
    return monitoring_report(insample, cut(run.run, "run"), cut(log, "recursive"))


# One feature and no lag terms: small enough for SQL to solve, so the same code
# paths as above are checked value by value.
VIEWS["mx"] = (
    "filled prod",
    "SELECT f.date, f.y, p.x, row_number() OVER (ORDER BY f.date) - 1 AS pos, count(*) OVER () AS n FROM filled f"
    " JOIN (SELECT date, lag(production) OVER (ORDER BY date) AS x FROM prod) p ON p.date = f.date WHERE x IS NOT NULL",
)
VIEWS["md"] = (
    "mx",
    "SELECT *, y - lag(y, 7) OVER (ORDER BY date) AS w, x - lag(x, 7) OVER (ORDER BY date) AS z FROM mx",
)
VIEWS["mb"] = ("md", "SELECT sum(z * w) / sum(z * z) AS b FROM md WHERE pos >= 8")
VIEWS["mruns"] = (
    "half_years md",
    "SELECT checkpoint, strftime(checkpoint, '%Y%m%d') || 'T000000Z' AS run_id, sum(z * w) / sum(z * z) AS b FROM half_years"
    " JOIN md ON md.date <= checkpoint AND pos >= 8 WHERE checkpoint <= (SELECT max(date) FROM md) GROUP BY 1, 2",
)
LINE = arx.Spec(order=(0, 0, 0), seasonal=(0, 1, 0, 7), features=("production_mw_lag1",), long_ar=1)


def line_gold(spark, sf) -> ModelReady:
    made = interpolate_time(densify(src.prod(spark, sf)), ["production"])
    x = made.select("date", lagged("production", 1).alias("production_mw_lag1")).where("production_mw_lag1 is not null")
    table = src.filled(spark, sf).withColumnRenamed("y", TARGET).join(x, "date")
    return ModelReady(cut(table, "line"), ["production_mw_lag1"], ["production_mw_lag1"])


def line_run(spark, sf):
    return training.train(line_gold(spark, sf), LINE, "20010801T000000Z")


@query(
    "m03_fit_line",
    "SELECT count(*) AS n, round(any_value(b), 8) AS coef, round(sqrt(sum((w - b * z) * (w - b * z)) / count(*)), 3) AS sigma FROM md, mb WHERE pos >= 8",
    "md mb",
)
def m03_line(spark, sf):
    sigma = F.sqrt(F.col("rss") / F.col("n"))
    return line_run(spark, sf).fits.select(
        "n", F.round(F.col("coef")[0], 8).alias("coef"), F.round(sigma, 3).alias("sigma")
    )


@query(
    "m05_fitted_line",
    "SELECT date, y AS actual, round(y - w + b * z, 4) AS fitted FROM md, mb WHERE pos >= 7",
    "md mb",
)
def m05_line(spark, sf):
    return rounded(line_run(spark, sf).insample.select("date", "actual", "fitted"), 4, "fitted")


@query(
    "m06_recursive_line",
    """
SELECT o.date AS start_date, CAST(h AS INTEGER) AS horizon, t.y AS actual, round(t.y - t.w + b * t.z, 4) AS predicted
FROM md o, generate_series(1, 7) AS g(h), mb, md t
WHERE t.pos = o.pos + h AND o.pos >= greatest(0, o.n - 365 - 7) AND o.pos < o.n - 7 AND (o.pos - greatest(0, o.n - 365 - 7)) % 14 = 0
""",
    "md mb",
)
def m06_line(spark, sf):
    run = line_run(spark, sf)
    log, _ = backtest.recursive_evaluation(run.rows, run.fits, LINE, horizon=7)
    return rounded(log.select("start_date", "horizon", "actual", "predicted"), 4, "predicted")


REPORTED = ["calibration", "drift", "seasonality", "horizon", "thresholds", "residuals"]


@query(
    "x06_report_line",
    """
, ins AS (SELECT date, y AS actual, y - w + b * z AS fitted, row_number() OVER (ORDER BY date) AS rn FROM md, mb WHERE pos >= 7),
ev AS (SELECT *, fitted - actual AS error, abs(fitted - actual) AS ae FROM ins),
run AS (SELECT round(avg(ae), 2) AS mae, round(sqrt(avg(error * error)), 2) AS rmse, round(avg(ae / actual) * 100, 4) AS mape FROM ev),
warm AS (SELECT *, stddev_samp(-error) OVER () AS sd FROM ev WHERE rn > 60),
roll AS (SELECT rn, CASE WHEN count(ae) OVER w >= 15 THEN avg(ae) OVER w END AS mae, row_number() OVER (ORDER BY date) AS k FROM warm WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
drift AS (SELECT count(*) FILTER (roll.mae > run.mae * 2) AS a, count(*) AS d FROM roll, run WHERE k > 30),
log AS (SELECT CAST(h AS INTEGER) AS horizon, t.y AS actual, t.y - t.w + b * t.z - t.y AS error FROM md o, generate_series(1, 7) AS g(h), mb, md t
  WHERE t.pos = o.pos + h AND o.pos >= greatest(0, o.n - 365 - 7) AND o.pos < o.n - 7 AND (o.pos - greatest(0, o.n - 365 - 7)) % 14 = 0),
calib AS (SELECT avg(error) AS bias, stddev_samp(error) AS sigma, least(min(actual), min(fitted)) AS axis_min, greatest(max(actual), max(fitted)) AS axis_max FROM warm),
res AS (SELECT round(avg(-error), 2) AS mean, round(stddev_samp(-error), 2) AS std, round(min(-error), 2) AS min, round(max(-error), 2) AS max, round(skewness(-error), 4) AS skewness,
  round(kurtosis(-error), 4) AS kurtosis, round(100 * avg(CASE WHEN ae <= sd THEN 1.0 ELSE 0.0 END), 1) AS within_1sigma_pct, round(100 * avg(CASE WHEN ae <= 2 * sd THEN 1.0 ELSE 0.0 END), 1) AS within_2sigma_pct FROM warm),
hor AS (SELECT horizon, round(avg(abs(error)), 1) AS mae, round(sqrt(avg(error * error)), 1) AS rmse, round(avg(abs(error) / actual) * 100, 3) AS mape, CAST(count(*) AS DOUBLE) AS n FROM log GROUP BY 1)
SELECT section, item, metric, round(value, 3) + 0.0 AS value FROM (
  SELECT 'calibration' AS section, 'all' AS item, metric, value FROM calib UNPIVOT (value FOR metric IN (bias, sigma, axis_min, axis_max))
  UNION ALL SELECT 'residuals', 'all', metric, value FROM res UNPIVOT (value FOR metric IN (mean, std, min, max, skewness, kurtosis, within_1sigma_pct, within_2sigma_pct))
  UNION ALL SELECT 'horizon', CAST(horizon AS VARCHAR), metric, value FROM hor UNPIVOT (value FOR metric IN (mae, rmse, mape, n))
  UNION ALL SELECT 'drift', 'all', metric, value FROM (SELECT CAST(a AS DOUBLE) AS n_alerts, CAST(d AS DOUBLE) AS n_days, 100.0 * a / d AS alert_pct FROM drift) UNPIVOT (value FOR metric IN (n_alerts, n_days, alert_pct))
  UNION ALL SELECT 'seasonality', month(date) || '|' || (isodow(date) - 1), 'mean_abs_error', avg(ae) FROM warm GROUP BY 2
  UNION ALL SELECT 'thresholds', m, 'baseline', v FROM (SELECT mae, rmse, mape FROM run) UNPIVOT (v FOR m IN (mae, rmse, mape))
  UNION ALL SELECT 'thresholds', m, 'alert', round(v * 2, 2) FROM (SELECT mae, rmse, mape FROM run) UNPIVOT (v FOR m IN (mae, rmse, mape))) AS r
""",
    "md mb",
)
def x06_line(spark, sf):
    """Six sections of the report on a run that SQL can follow."""
    run = line_run(spark, sf)
    log, _ = backtest.recursive_evaluation(run.rows, run.fits, LINE, horizon=7)
    report = monitoring_report(cut(run.insample, "insample"), cut(run.run, "run"), cut(log, "recursive"))
    return rounded(report.where(F.col("section").isin(REPORTED)), 3, "value")


# One feature and one lag: a system of two equations, and a forecast that recurses.
VIEWS["ma"] = ("md", "SELECT *, lag(w) OVER (ORDER BY date) AS v FROM md")
VIEWS["mab"] = (
    "ma",
    "SELECT (szw * svv - svw * szv) / (szz * svv - szv * szv) AS b, (svw * szz - szw * szv) / (szz * svv - szv * szv) AS a FROM"
    " (SELECT sum(z * z) AS szz, sum(z * v) AS szv, sum(v * v) AS svv, sum(z * w) AS szw, sum(v * w) AS svw FROM ma WHERE pos >= 8) AS s",
)
LAGGED = arx.Spec(order=(1, 0, 0), seasonal=(0, 1, 0, 7), features=("production_mw_lag1",), long_ar=1)


def lagged_run(spark, sf):
    return training.train(line_gold(spark, sf), LAGGED, "20010801T000000Z")


@query(
    "m03_fit_lagged",
    "SELECT count(*) AS n, round(any_value(b), 8) AS b, round(any_value(a), 8) AS a, round(sqrt(avg((w - b * z - a * v) * (w - b * z - a * v))), 3) AS sigma"
    " FROM ma, mab WHERE pos >= 8",
    "ma mab",
)
def m03_lagged(spark, sf):
    sigma = F.sqrt(F.col("rss") / F.col("n"))
    b, a = (F.round(F.col("coef")[i], 8).alias(c) for i, c in enumerate("ba"))
    return lagged_run(spark, sf).fits.select("n", b, a, F.round(sigma, 3).alias("sigma"))


@query(
    "m05_fitted_lagged",
    "SELECT date, y AS actual, round(y - w + b * z + a * v, 4) AS fitted FROM ma, mab WHERE pos >= 8",
    "ma mab",
)
def m05_lagged(spark, sf):
    return rounded(lagged_run(spark, sf).insample.select("date", "actual", "fitted"), 4, "fitted")


@query(
    "m06_recursive_lagged",
    """
, o AS (SELECT date, pos, w AS w0 FROM ma WHERE pos >= greatest(0, n - 365 - 14) AND pos < n - 14 AND (pos - greatest(0, n - 365 - 14)) % 14 = 0),
wh AS (SELECT o.date, o.pos, o.w0, CAST(g.h AS INTEGER) AS h, any_value(pow(a, g.h) * o.w0) + sum(pow(a, g.h - t.pos + o.pos) * b * t.z) AS what
  FROM o, generate_series(1, 14) AS g(h), mab, ma t WHERE t.pos > o.pos AND t.pos <= o.pos + g.h GROUP BY o.date, o.pos, o.w0, g.h)
SELECT x.date AS start_date, x.h AS horizon, t.y AS actual, round(x.what + CASE WHEN x.h > 7 THEN e.what + u.y ELSE t.y - t.w END, 4) AS predicted
FROM wh x JOIN ma t ON t.pos = x.pos + x.h LEFT JOIN wh e ON e.pos = x.pos AND e.h = x.h - 7 LEFT JOIN ma u ON u.pos = x.pos + x.h - 14
""",
    "ma mab",
)
def m06_lagged(spark, sf):
    """Fourteen days ahead: each day builds on the one before and on the week before."""
    run = lagged_run(spark, sf)
    log, _ = backtest.recursive_evaluation(run.rows, run.fits, LAGGED, horizon=14)
    return rounded(log.select("start_date", "horizon", "actual", "predicted"), 4, "predicted")


@query(
    "m14_run_row_lagged",
    """
SELECT '20010801T000000Z' AS run_id, 'SARIMAX(1, 0, 0)x(0, 1, 0, 7)' AS model_name, min(date) AS training_start, max(date) AS training_end,
  count(*) AS n_training_days, round(avg(abs(e)), 2) AS mae, round(sqrt(avg(e * e)), 2) AS rmse, round(avg(abs(e) / y) * 100, 4) AS mape,
  round(-2 * (-count(*) / 2.0 * (ln(2 * pi()) + ln(sum(e * e) / count(*)) + 1)) + 6, 3) AS aic
FROM (SELECT date, y, b * z + a * v - w AS e FROM ma, mab WHERE pos >= 8) AS r
""",
    "ma mab",
)
def m14_lagged(spark, sf):
    run = lagged_run(spark, sf).run.select(
        "run_id", "model_name", "training_start", "training_end", "n_training_days", "mae", "rmse", "mape", "aic"
    )
    return rounded(run, 3, "aic")


@query(
    "x05_registered_runs",
    """
, w AS (SELECT '20001231T000000Z' AS run_id, DATE '2000-12-31' AS until UNION ALL SELECT '0012', DATE '1999-12-31'),
c AS (SELECT run_id, until, (szw * svv - svw * szv) / (szz * svv - szv * szv) AS b, (svw * szz - szw * szv) / (szz * svv - szv * szv) AS a FROM
  (SELECT run_id, until, sum(z * z) AS szz, sum(z * v) AS szv, sum(v * v) AS svv, sum(z * w.w) AS szw, sum(v * w.w) AS svw
   FROM (SELECT * FROM ma WHERE pos >= 8) AS w JOIN w AS r ON date <= until GROUP BY 1, 2) AS s)
SELECT run_id, count(*) AS n_training_days, round(sqrt(avg(e * e)), 2) AS rmse FROM
  (SELECT run_id, b * z + a * v - ma.w AS e FROM c JOIN ma ON date <= until AND pos >= 8) AS r GROUP BY 1
""",
    "ma",
)
def x05_registered(spark, sf):
    """Two runs trained and appended to the runs table; ids come back as they were written."""
    path, table = work_path(spark, "runs"), line_gold(spark, sf)
    for run_id, end in (("20001231T000000Z", "2000-12-31"), ("0012", "1999-12-31")):
        out = training.register(training.train(model_ready_until(table, end), LAGGED, run_id).run, path)
    return out.select("run_id", "n_training_days", "rmse")


@query(
    "m07_walk_forward_line",
    """
, plan AS (SELECT pos, date, y, w, z, greatest(730, n - 1000) AS first, (pos - greatest(730, n - 1000)) // 30 AS step FROM md),
refits AS (SELECT s.step, sum(t.z * t.w) / sum(t.z * t.z) AS b FROM (SELECT DISTINCT step, first FROM plan WHERE pos >= first) s
  JOIN md t ON t.pos >= 8 AND t.pos < s.first + 30 * s.step GROUP BY 1)
SELECT date AS target_date, y AS actual, round(y - w + b * z, 4) AS predicted FROM plan JOIN refits USING (step) WHERE pos >= first
""",
    "md",
)
def m07_line(spark, sf):
    rows = training.design_table(line_gold(spark, sf), LINE)
    log = backtest.walk_forward(rows, LINE, {"line": LINE}, horizons=(1,))
    return rounded(log.select("target_date", "actual", "predicted"), 4, "predicted")


# Three candidates, two of them to be chosen from: a class of the day's own level, which explains
# it, and a price that does not. Flags turn a candidate's rows of the normal equations into zeros.
VIEWS["mc"] = (
    "mx station_days",
    "SELECT *, y - lag(y, 7) OVER t AS w, x - lag(x, 7) OVER t AS z0, c1 - lag(c1, 7) OVER t AS z1, c2 - lag(c2, 7) OVER t AS z2 FROM"
    " (SELECT mx.date, y, x, pos, n, floor(y / 20000.0) AS c1, lo AS c2 FROM mx JOIN (SELECT date, min(TN) AS lo FROM station_days GROUP BY 1) AS s ON s.date = mx.date) AS r"
    " WINDOW t AS (ORDER BY date)",
)
SUMS = ", ".join(
    [f"sum(z{i} * z{j}) AS s{i}{j}" for i in range(3) for j in range(i, 3)] + [f"sum(z{i} * w) AS r{i}" for i in range(3)]
) + ", sum(w * w) AS ww, count(*) AS n"
INVERSE = """*, (s11 * s22 - s12 * s12) / det AS i00, (s00 * s22 - s02 * s02) / det AS i11, (s00 * s11 - s01 * s01) / det AS i22,
  (s02 * s12 - s01 * s22) / det AS i01, (s01 * s12 - s02 * s11) / det AS i02, (s01 * s02 - s00 * s12) / det AS i12"""
DET = "*, s00 * (s11 * s22 - s12 * s12) - s01 * (s01 * s22 - s02 * s12) + s02 * (s01 * s12 - s02 * s11) AS det"
BETA = "*, i00 * r0 + i01 * r1 + i02 * r2 AS b0, i01 * r0 + i11 * r1 + i12 * r2 AS b1, i02 * r0 + i12 * r1 + i22 * r2 AS b2"


def solved(sums: str) -> str:
    return f"SELECT {BETA} FROM (SELECT {INVERSE} FROM (SELECT {DET} FROM ({sums}) AS s) AS d) AS i"


VIEWS["mprobe"] = (
    "mc",
    "SELECT n, " + ", ".join(
        f"CASE WHEN abs(b{i}) / sqrt((ww - b0 * r0 - b1 * r1 - b2 * r2) / (n - 3) * i{i}{i}) >= 1.6448536269514722::DOUBLE THEN 1 ELSE 0 END AS f{i}" for i in (1, 2)
    ) + f" FROM ({solved(f'SELECT {SUMS} FROM mc WHERE pos >= 8 AND pos < 730')}) AS p",
)
CANDIDATES = arx.Spec(
    order=(0, 0, 0), seasonal=(0, 1, 0, 7), features=("production_mw_lag1", "temp_pc_01", "temp_pc_02"), long_ar=1
)


def candidate_rows(spark, sf):
    lowest = src.stations(spark, sf).where("variable = 'TN'").groupBy("date").agg(F.min("value").alias("temp_pc_02"))
    table = line_gold(spark, sf).table.withColumn("temp_pc_01", F.floor(F.col(TARGET) / 20000).cast("double"))
    made = ModelReady(cut(table.join(lowest, "date"), "candidates"), list(CANDIDATES.features), [])
    return training.design_table(made, CANDIDATES)


@query(
    "m07_selected_features",
    "SELECT 'significant' AS model, n, 'production_mw_lag1' || CASE WHEN f1 = 1 THEN '|temp_pc_01' ELSE '' END || CASE WHEN f2 = 1 THEN '|temp_pc_02' ELSE '' END AS features,"
    " 'p-value' AS method FROM mprobe",
    "mprobe",
)
def m07_selected(spark, sf):
    """What a fit of the first two years picks."""
    found = backtest.probe_features(candidate_rows(spark, sf), {"significant": arx.Chosen(CANDIDATES)})
    return found.select("model", "n", F.array_join("features", "|").alias("features"), "method")


MASKED = """SELECT step, f1, f2, s00, s01 * f1 AS s01, s02 * f2 AS s02, s11 * f1 + 1 - f1 AS s11, s12 * f1 * f2 AS s12, s22 * f2 + 1 - f2 AS s22,
  r0, r1 * f1 AS r1, r2 * f2 AS r2 FROM sums, mprobe"""


@query(
    "m07_walk_forward_selected",
    f"""
, plan AS (SELECT *, greatest(730, n - 1000) AS first, (pos - greatest(730, n - 1000)) // 30 AS step FROM mc),
sums AS (SELECT s.step, {SUMS} FROM (SELECT DISTINCT step, first FROM plan WHERE pos >= first) s JOIN mc t ON t.pos >= 8 AND t.pos < s.first + 30 * s.step GROUP BY 1)
SELECT date AS target_date, y AS actual, round(y - w + b0 * z0 + f1 * b1 * z1 + f2 * b2 * z2, 3) AS predicted
FROM plan JOIN ({solved(MASKED)}) AS fits USING (step) WHERE pos >= first
""",
    "mc mprobe",
)
def m07_walk_selected(spark, sf):
    """The backtest of the model whose features the probe picked, refitted every thirty days."""
    rows = candidate_rows(spark, sf)
    log = backtest.walk_forward(rows, CANDIDATES, {"significant": arx.Chosen(CANDIDATES)}, horizons=(1,))
    return rounded(log.select("target_date", "actual", "predicted"), 3, "predicted")


@query(
    "m13_final_fit_selected",
    f"""
, sums AS (SELECT 0 AS step, {SUMS} FROM mc WHERE pos >= 8)
SELECT round(b0, 7) AS b0, CASE WHEN f1 = 1 THEN round(b1, 3) END AS b1, CASE WHEN f2 = 1 THEN round(b2, 7) END AS b2 FROM ({solved(MASKED)}) AS fits
""",
    "mc mprobe",
)
def m13_selected(spark, sf):
    """The chosen features fitted on everything: weights by the feature's name, null where it was left out."""
    rows, specs = candidate_rows(spark, sf), {"significant": arx.Chosen(CANDIDATES)}
    sums = backtest.with_probe(reg.cross_products(rows, [], CANDIDATES.names), rows, specs, 730)
    weight = F.map_from_arrays("terms", "coef")
    cells = [F.try_element_at(weight, F.lit(f)) for f in CANDIDATES.features]
    return arx.fit(sums, specs).select(*[F.round(c, d).alias(f"b{i}") for i, (c, d) in enumerate(zip(cells, (7, 3, 7)))])


# Orders up to (1, 1): the innovations are those of a first regression on one lag.
VIEWS["mo"] = (
    "md",
    "SELECT * FROM (SELECT *, lag(w) OVER t AS w1, lag(w, 2) OVER t AS w2, lag(z) OVER t AS z1 FROM md WINDOW t AS (ORDER BY date)) AS m WHERE pos >= 9",
)
VIEWS["me"] = (
    "mo",
    "SELECT mo.*, w1 - b * z1 - a * w2 AS e FROM mo, (SELECT (szw * svv - svw * szv) / (szz * svv - szv * szv) AS b, (svw * szz - szw * szv) / (szz * svv - szv * szv) AS a FROM"
    " (SELECT sum(z * z) AS szz, sum(z * w1) AS szv, sum(w1 * w1) AS svv, sum(z * w) AS szw, sum(w1 * w) AS svw FROM mo) AS s) AS f",
)


def order_sums(second: str, third: str) -> str:
    """Cross products of (feature, second, third) with the target, under the names of ``solved``."""
    return f"SELECT {SUMS} FROM (SELECT w, z AS z0, {second} AS z1, {third} AS z2 FROM me) AS c"


def order_row(model: str, k: int, sums: str, keep: str = "1") -> str:
    aic = f"round(n * (ln(2 * pi()) + ln(rss / n) + 1) + 2 * {k + 1}, 4)"
    masked = f"SELECT s00, s01, s02 * {keep} AS s02, s11, s12 * {keep} AS s12, s22 * {keep} + 1 - {keep} AS s22, r0, r1, r2 * {keep} AS r2, ww, n FROM ({sums}) AS u"
    return (
        f"SELECT '{model}x(0, 1, 0, 7)' AS model, n, {k}::INTEGER AS k, {aic} AS aic FROM"
        f" (SELECT *, ww - b0 * r0 - b1 * r1 - b2 * r2 AS rss FROM ({solved(masked)}) AS b) AS q"
    )


@query(
    "m12_order_search_small",
    order_row("(1, 0, 0)", 2, order_sums("w1", "e"), "0")
    + " UNION ALL " + order_row("(0, 0, 1)", 2, order_sums("e", "w1"), "0")
    + " UNION ALL " + order_row("(1, 0, 1)", 3, order_sums("w1", "e")),
    "me",
)
def m12_small(spark, sf):
    """Every order up to one lag of each kind, from one matrix of sums."""
    wide, models = backtest.order_grid(LINE, 1, 1, 0, 0)
    search = backtest.order_search(training.design_table(line_gold(spark, sf), wide), wide, models)
    return rounded(search.select("model", "n", "k", "aic"), 4, "aic")


BACKFILL_SQL = """
SELECT run_id, count(*) AS n_training_days, round(avg(abs(e)), 2) AS mae, round(sqrt(avg(e * e)), 2) AS rmse, round(avg(abs(e) / y) * 100, 4) AS mape,
  min(date) AS training_start, max(date) AS training_end
FROM (SELECT run_id, date, y, b * z - w AS e FROM mruns JOIN md ON md.date <= checkpoint AND pos >= 7) AS r GROUP BY 1
"""


@query("m11_backfill_line", BACKFILL_SQL, "mruns md")
def m11_line(spark, sf):
    found, _, _ = training.historical_runs(line_gold(spark, sf), LINE, src.FIRST_CHECKPOINT)
    return found.select("run_id", "n_training_days", "mae", "rmse", "mape", "training_start", "training_end")


@query("m11_backfill_registered", BACKFILL_SQL, "mruns md")
def m11_registered(spark, sf):
    """A backfill that stopped after 1998 and is taken up again: the table ends up with every run once."""
    path, table = work_path(spark, "runs"), line_gold(spark, sf)
    training.backfill(model_ready_until(table, "1998-12-31"), LINE, src.FIRST_CHECKPOINT, path)
    runs = training.backfill(table, LINE, src.FIRST_CHECKPOINT, path)
    left = training.backfill(table, LINE, src.FIRST_CHECKPOINT, path, dry_run=True)
    done = runs.join(left, "run_id", "left_anti")
    return done.select("run_id", "n_training_days", "mae", "rmse", "mape", "training_start", "training_end")


@query(
    "m15_batch_scoring_line",
    """
, asked AS (SELECT date, production_mw_lag1 AS x, coalesce(run_id, (SELECT max(run_id) FROM mruns)) AS run_id FROM requests)
SELECT a.date, a.run_id, round(p.y - p.w + b * (a.x - (p.x - p.z)), 4) AS prediction,
  CASE WHEN r.run_id IS NULL THEN 'run not found: ' || a.run_id WHEN a.x IS NULL THEN 'features not supplied: production_mw_lag1' END AS error
FROM asked a LEFT JOIN mruns r ON r.run_id = a.run_id LEFT JOIN md p ON p.date = r.checkpoint + 1
""",
    "requests mruns md",
)
def m15_line(spark, sf):
    table = line_gold(spark, sf)
    _, fits, rows = training.historical_runs(table, LINE, src.FIRST_CHECKPOINT)
    runs = cut(training.with_scaler(training.scoring_state(rows, fits, LINE), table.table, LINE), "scoring-state")
    out = training.score_requests(src.requests(spark, sf), runs, None)
    return rounded(out.select("date", "run_id", "prediction", "error"), 4, "prediction")


@query(
    "m15_late_backfill",
    """
, asked AS (SELECT date, production_mw_lag1 AS x, coalesce(run_id, (SELECT run_id FROM latest_run)) AS run_id FROM requests)
SELECT a.date, a.run_id, round(p.y - p.w + b * (a.x - (p.x - p.z)), 4) AS prediction
FROM asked a LEFT JOIN mruns r ON r.run_id = a.run_id LEFT JOIN md p ON p.date = r.checkpoint + 1
""",
    "requests latest_run mruns md",
)
def m15_late(spark, sf):
    """Scoring by default takes the run appended last, not the one trained last."""
    table = line_gold(spark, sf)
    _, fits, rows = training.historical_runs(table, LINE, src.FIRST_CHECKPOINT)
    runs = training.with_scaler(training.scoring_state(rows, fits, LINE), table.table, LINE)
    out = training.score_requests(src.requests(spark, sf), cut(src.late_backfill(runs), "scoring-state"), None)
    return rounded(out.select("date", "run_id", "prediction"), 4, "prediction")


VIEWS["mruns_lagged"] = (
    "half_years ma",
    "SELECT checkpoint, strftime(checkpoint, '%Y%m%d') || 'T000000Z' AS run_id, (szw * svv - svw * szv) / (szz * svv - szv * szv) AS b,"
    " (svw * szz - szw * szv) / (szz * svv - szv * szv) AS a FROM (SELECT checkpoint, sum(z * z) AS szz, sum(z * v) AS szv, sum(v * v) AS svv,"
    " sum(z * w) AS szw, sum(v * w) AS svw FROM half_years JOIN ma ON ma.date <= checkpoint AND pos >= 8 WHERE checkpoint <= (SELECT max(date) FROM ma) GROUP BY 1) AS s",
)


@query(
    "m11_backfill_lagged",
    """
SELECT run_id, count(*) AS n_training_days, round(avg(abs(e)), 2) AS mae, round(sqrt(avg(e * e)), 2) AS rmse, round(avg(abs(e) / y) * 100, 4) AS mape,
  min(date) AS training_start, max(date) AS training_end
FROM (SELECT run_id, date, y, b * z + a * v - w AS e FROM mruns_lagged JOIN ma ON ma.date <= checkpoint AND pos >= 8) AS r GROUP BY 1
""",
    "mruns_lagged ma",
)
def m11_lagged(spark, sf):
    """Half-year runs of a model with an autoregressive term."""
    found, _, _ = training.historical_runs(line_gold(spark, sf), LAGGED, src.FIRST_CHECKPOINT)
    return found.select("run_id", "n_training_days", "mae", "rmse", "mape", "training_start", "training_end")


@query(
    "m15_batch_scoring_lagged",
    """
, asked AS (SELECT date, production_mw_lag1 AS x, coalesce(run_id, (SELECT max(run_id) FROM mruns_lagged)) AS run_id FROM requests)
SELECT q.date, q.run_id, round(p.y - p.w + b * (q.x - (p.x - p.z)) + a * p.v, 4) AS prediction
FROM asked q LEFT JOIN mruns_lagged r ON r.run_id = q.run_id LEFT JOIN ma p ON p.date = r.checkpoint + 1
""",
    "requests mruns_lagged ma",
)
def m15_lagged(spark, sf):
    """A run's stored level carries its autoregressive part into scoring."""
    table = line_gold(spark, sf)
    _, fits, rows = training.historical_runs(table, LAGGED, src.FIRST_CHECKPOINT)
    runs = training.with_scaler(training.scoring_state(rows, fits, LAGGED), table.table, LAGGED)
    out = training.score_requests(src.requests(spark, sf), cut(runs, "scoring-state"), None)
    return rounded(out.select("date", "run_id", "prediction"), 4, "prediction")


VIEWS["kx"] = (
    "keyed_filled",
    "SELECT series, row_number() OVER (PARTITION BY series ORDER BY date) AS pos, count(*) OVER (PARTITION BY series) AS n,"
    " y - avg(y) OVER (PARTITION BY series) AS v FROM keyed_filled",
)
KPSS_SQL = """
, ac AS (SELECT a.series, k, any_value(a.n) AS n, sum(a.v * b.v) AS s FROM kx a, generate_series(0, 120) AS g(k), kx b
  WHERE b.series = a.series AND b.pos = a.pos + k GROUP BY 1, 2),
raw AS (SELECT series, any_value(n) AS n, sum(CASE WHEN k = 0 THEN s ELSE 2 * s END) AS s0, sum(2 * k * s) AS s1 FROM ac WHERE k <= floor(pow(n, 2 / 9)) GROUP BY 1),
pick AS (SELECT series, CAST(least(floor(1.1447::DOUBLE * pow(pow(s1 / s0, 2), 1 / 3) * pow(n, 1 / 3)), n - 1) AS INTEGER) AS lags FROM raw),
var AS (SELECT ac.series, any_value(lags) AS lags, any_value(n) AS n, sum(CASE WHEN k = 0 THEN s ELSE 2 * s * (1 - k / (lags + 1)) END) / any_value(n) AS v
  FROM ac JOIN pick ON pick.series = ac.series WHERE k <= lags GROUP BY 1),
cum AS (SELECT series, sum(v) OVER (PARTITION BY series ORDER BY pos) AS c FROM kx)
SELECT cum.series, any_value(lags) AS lags, any_value(n) AS n, round(sum(c * c) / any_value(n) / any_value(n) / any_value(v), 6) AS statistic
FROM cum JOIN var ON var.series = cum.series GROUP BY 1
"""


@query("d04_kpss_statistic", KPSS_SQL, "kx")
def d04_statistic(spark, sf):
    out = diagnostics.kpss(cut(keyed_filled(spark, sf), "series"), "y", ["series"])
    return rounded(out.select("series", "lags", "n", "statistic"), 6, "statistic")
