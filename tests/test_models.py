"""Regression, forecasting, reduction and diagnostics against direct NumPy code."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattline.operators import arx, backtest, diagnostics
from wattline.operators import reduction as red
from wattline.operators import regression as reg
from wattline.plans import training
from wattline.plans.gold import TARGET, ModelReady
from wattline.plans.monitoring import monitoring_report
from wattline.session import cut

N = 320
SPEC = arx.Spec(order=(2, 0, 1), seasonal=(1, 1, 0, 7), features=("x",), long_ar=10)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x, e = rng.normal(size=N).cumsum(), rng.normal(size=N)
    y = np.zeros(N)
    for t in range(N):
        y[t] = 50 + 2 * x[t] + 8 * np.sin(2 * np.pi * t / 7) + (0.6 * (y[t - 1] - 50) if t else 0) + e[t] + (0.4 * e[t - 1] if t else 0)
    return pd.DataFrame({"date": pd.date_range("2023-01-01", periods=N).date, "y": y, "x": x})


@pytest.fixture(scope="module")
def rows(spark, data):
    return cut(arx.design(spark.createDataFrame(data), "y", SPEC), "design")


@pytest.fixture(scope="module")
def fits(spark, rows):
    return cut(arx.fit(reg.cross_products(rows, [], SPEC.names), {"final": SPEC}), "fit")


def direct(data, upto=None):
    """The two-stage estimate computed row by row; returns (coef, one-step fits by position)."""
    y, x = data.y.to_numpy(), data.x.to_numpy()
    w, z = np.full(N, np.nan), np.full(N, np.nan)
    w[7:], z[7:] = y[7:] - y[:-7], x[7:] - x[:-7]
    lag = lambda v, k: np.concatenate([np.full(k, np.nan), v[: N - k]])
    depth = SPEC.depth
    ok = np.arange(N) >= 7 + depth
    train = ok & (np.arange(N) < (upto or N))
    long = np.column_stack([z, *[lag(w, k) for k in range(1, 11)]])
    b = np.linalg.lstsq(long[train], w[train], rcond=None)[0]
    e = w - long @ b
    final = np.column_stack([z, *[lag(w, k) for k in SPEC.ar], lag(e, 1)])
    c = np.linalg.lstsq(final[train], w[train], rcond=None)[0]
    return c, y - w + final @ c, e, b


def test_lag_sets():
    assert arx.Spec().ar == [1, 2, 7, 8, 9, 14, 15, 16] and arx.Spec().ma == [1]
    assert arx.difference_weights(1, 1, 7).nonzero()[0].tolist() == [0, 1, 7, 8]


def test_fit_equals_direct(data, fits):
    c, _, _, _ = direct(data)
    np.testing.assert_allclose(fits.first().coef, c, rtol=1e-6)


def test_fitted_equals_direct(data, rows, fits):
    _, want, _, _ = direct(data)
    got = arx.fitted(rows, fits, SPEC).orderBy("date").toPandas()
    np.testing.assert_allclose(got.fitted, want[7 + SPEC.depth :], rtol=1e-8)


def test_recursion(data, rows, fits):
    """Horizon 1 equals the one-step fit; later steps equal a plain loop."""
    c, one, e, _ = direct(data)
    log, failed = backtest.recursive_evaluation(rows, fits, SPEC, horizon=9, step=5, window=60)
    got = log.toPandas().sort_values(["start_date", "horizon"])
    assert failed.count() == 0 and len(got) % 9 == 0
    y, x = data.y.to_numpy(), data.x.to_numpy()
    at = {d: i for i, d in enumerate(data.date)}
    for start, part in got.groupby("start_date"):
        t0, level, w = at[start], list(y[: at[start] + 1]), {}
        w = {t: y[t] - y[t - 7] for t in range(7, t0 + 1)}
        err = {t: e[t] for t in range(t0 + 1)}
        for h in range(1, 10):
            t = t0 + h
            step = c[0] * (x[t] - x[t - 7]) + sum(b * w[t - k] for b, k in zip(c[1:-1], SPEC.ar))
            step += c[-1] * err.get(t - 1, 0.0)
            w[t] = step
            level.append(step + level[t - 7])
        np.testing.assert_allclose(part.predicted, level[t0 + 1 :], rtol=1e-7)
        assert abs(part.predicted.iloc[0] - one[t0 + 1]) < 1e-6


def test_walk_forward_equals_refits(data, rows):
    log = backtest.walk_forward(rows, SPEC, {"m": SPEC}, horizons=(1,), initial=200, every=30, last=70).toPandas()
    assert len(log) == 70
    at = {d: i for i, d in enumerate(data.date)}
    first = N - 70
    for start, predicted in zip(log.start_date, log.predicted):
        i = at[start] + 1
        _, one, _, _ = direct(data, first + (i - first) // 30 * 30)
        assert abs(predicted - one[i]) < 1e-6


def test_order_search_prefers_structure(rows, data, spark):
    small = arx.Spec(order=(1, 0, 0), seasonal=(0, 1, 0, 7), features=("x",), long_ar=10)
    wide, models = backtest.order_grid(small, 1, 1, 1, 0)
    table = cut(arx.design(spark.createDataFrame(data), "y", wide), "grid")
    search = backtest.order_search(table, wide, models)
    assert search.count() == 7
    best = backtest.best_order(search).first()
    assert best.model.startswith("(1")


def test_beats_naive(data, rows, fits):
    got = arx.fitted(rows, fits, SPEC).agg(F.avg("abs_error")).first()[0]
    y = data.y.to_numpy()
    assert got < 0.8 * np.abs(y[7:] - y[:-7]).mean()


def test_least_squares_by_group_with_a_hot_group(spark):
    rng = np.random.default_rng(0)
    g = np.where(rng.random(3000) < 0.9, "hot", "cold")
    a, b = rng.normal(size=3000), rng.normal(size=3000)
    y = 3 + 2 * a - b + rng.normal(size=3000)
    pdf = pd.DataFrame({"g": g, "a": a, "b": b, "c": a + b, "y": y})
    df = spark.createDataFrame(pdf).repartition(8)
    out = reg.least_squares(df, ["g"], ["a", "b"], "y").toPandas()
    for name in ("hot", "cold"):
        k = g == name
        want = np.linalg.lstsq(np.column_stack([np.ones(k.sum()), a[k], b[k]]), y[k], rcond=None)[0]
        got = out[out.g == name].set_index("term").coef
        np.testing.assert_allclose([got["intercept"], got["a"], got["b"]], want, rtol=1e-9)
    collinear = reg.least_squares(df, [], ["a", "b", "c"], "y").first()
    assert collinear["rank"] == 3


def test_components_match_svd(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + 10
    days = pd.date_range("2024-01-01", periods=60).date
    rows = [(d, f"TN_{j}", float(x[i, j])) for i, d in enumerate(days) for j in range(5)]
    long = spark.createDataFrame(rows, "date date, column string, value double")
    fit = red.fit_components(long, 3)
    got = red.component_features(red.component_scores(long, fit), 3).orderBy("date").toPandas()
    z = (x - x.mean(0)) / x.std(0)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    vt *= np.sign(vt[np.arange(5), np.abs(vt).argmax(1)])[:, None]
    np.testing.assert_allclose(got.iloc[:, 1:].to_numpy(dtype=float), (z @ vt.T)[:, :3], atol=1e-8)
    ratio = [r.ratio for r in fit.explained.orderBy("component").collect()]
    np.testing.assert_allclose(ratio, (s**2 / (s**2).sum())[:3], rtol=1e-8)
    one = red.project_requests(
        spark.createDataFrame([(4.0, 12.0)], "temp_min_avg double, temp_max_avg double"), red.national_projection(fit)
    ).first()
    np.testing.assert_allclose(one.pca_components, ((4.0 - x.mean(0)) / x.std(0) @ vt.T)[:3], atol=1e-8)


def adf_direct(y):
    n = len(y)
    top = min(n // 2 - 2, int(np.ceil(12 * (n / 100) ** 0.25)))
    dy = np.diff(y)

    def fit(p, start):
        t = np.arange(start, n)
        x = np.column_stack([np.ones(len(t)), y[t - 1], *[dy[t - 1 - k] for k in range(1, p + 1)]])
        v = dy[t - 1]
        b, _, _, _ = np.linalg.lstsq(x, v, rcond=None)
        r = v - x @ b
        return len(t), r @ r, b, np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (r @ r) / (len(t) - x.shape[1]))

    def aic(p):
        m, rss, _, _ = fit(p, top + 1)
        return m * np.log(rss / m) + 2 * (2 + p)

    best = min(range(top + 1), key=aic)
    m, _, b, se = fit(best, best + 1)
    return b[1] / se[1], best, m


def test_adf_and_kpss(spark, data):
    rng = np.random.default_rng(9)
    walk, ar = rng.normal(size=300).cumsum(), np.zeros(300)
    for t in range(1, 300):
        ar[t] = 0.5 * ar[t - 1] + rng.normal()
    days = pd.date_range("2023-01-01", periods=300).date
    pdf = pd.concat([pd.DataFrame({"k": k, "date": days, "y": v}) for k, v in (("walk", walk), ("ar", ar))])
    df = spark.createDataFrame(pdf)
    got = {r.k: r for r in diagnostics.adf(df, "y", ["k"]).collect()}
    for k, v in (("walk", walk), ("ar", ar)):
        stat, lags, n = adf_direct(v)
        assert abs(got[k].statistic - stat) < 1e-7 and (got[k].lags, got[k].n) == (lags, n)
    assert got["ar"].stationary and not got["walk"].stationary
    assert abs(diagnostics.adf_p_value(-2.86) - 0.05) < 2e-3
    level = {r.k: r for r in diagnostics.kpss(df, "y", ["k"]).collect()}
    for k, v in (("walk", walk), ("ar", ar)):
        r = v - v.mean()
        prod = [(r[i:] @ r[: 300 - i]) for i in range(300)]
        s0 = prod[0] / 300 + sum(prod[i] / 150 for i in range(1, int(300 ** (2 / 9)) + 1))
        s1 = sum(i * prod[i] / 150 for i in range(1, int(300 ** (2 / 9)) + 1))
        lags = int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * 300 ** (1 / 3))
        var = (prod[0] + 2 * sum(prod[i] * (1 - i / (lags + 1)) for i in range(1, lags + 1))) / 300
        assert level[k].lags == lags
        assert abs(level[k].statistic - (r.cumsum() ** 2).sum() / 300**2 / var) < 1e-8


def test_pacf_equals_yule_walker(spark, data):
    y = data.y.to_numpy()
    c = y - y.mean()
    acov = np.array([c[k:] @ c[: N - k] for k in range(9)]) / N
    got = diagnostics.pacf(spark.createDataFrame(data), "y", 8).orderBy("lag").toPandas().pacf
    for k in range(1, 9):
        system = np.array([[acov[abs(i - j)] for j in range(k)] for i in range(k)])
        assert abs(got[k] - np.linalg.solve(system, acov[1 : k + 1])[-1]) < 1e-9


@pytest.fixture(scope="module")
def gold(spark, data):
    table = spark.createDataFrame(data).select(
        "date", F.col("y").alias(TARGET), F.col("x").alias("temp_pc_01"), (F.col("x") * 2 + F.rand(1)).alias("production_mw_lag1")
    )
    return ModelReady(cut(table, "gold"), ["temp_pc_01", "production_mw_lag1"], ["temp_pc_01", "production_mw_lag1"])


def test_history_and_scoring(spark, gold):
    """A run's score of the real next-day features equals its one-step prediction."""
    spec = arx.Spec(order=(2, 0, 1), seasonal=(1, 1, 0, 7), features=("temp_pc_01", "production_mw_lag1"), long_ar=10)
    found, fits, rows = training.historical_runs(gold, spec, "2023-06-30")
    assert [r.run_id for r in found.orderBy("run_id").collect()] == ["20230630T000000Z"]
    runs = training.with_scaler(training.scoring_state(rows, fits, spec), gold.table, spec)
    day = gold.table.where("date = date'2023-07-01'").first()
    ask = [(1, None, day.temp_pc_01, day.production_mw_lag1), (2, "nope", 0.0, 0.0)]
    requests = spark.createDataFrame(ask, "id int, run_id string, t double, production_mw_lag1 double")
    projection = spark.createDataFrame([(1, 1.0, 0.0, 0.0)], "component int, per_min double, per_max double, offset double")
    requests = requests.select("id", "run_id", F.col("t").alias("temp_min_avg"), F.lit(0.0).alias("temp_max_avg"), "production_mw_lag1")
    got = {r.id: r for r in training.score_requests(requests, runs, projection).collect()}
    weights = fits.select("run_id", F.lit("final").alias("model"), "predictor")
    one = arx.fitted(rows, weights, spec).where("date = date'2023-07-01'").first()
    assert abs(got[1].prediction - one.fitted) < 1e-6 and got[1].error is None
    assert got[2].prediction is None and got[2].error == "run not found: nope"
    bare = training.score_requests(requests, runs, None).where("id = 1").first()
    assert bare.pca_components == [] and bare.prediction is not None


def test_resume_skips_existing(spark, gold):
    spec = arx.Spec(order=(1, 0, 0), seasonal=(0, 1, 0, 7), features=("temp_pc_01",), long_ar=10)
    done = spark.createDataFrame([("20230630T000000Z",)], "run_id string")
    found, _, _ = training.historical_runs(gold, spec, "2023-06-30", done)
    assert found.count() == 0


def test_monitoring_of_a_constant_error(spark):
    days = pd.date_range("2024-01-01", periods=140).date
    actual = 50000 + 10.0 * np.arange(140)
    pdf = pd.DataFrame({"date": days, "actual": actual, "predicted": actual - 50, "error": -50.0, "abs_error": 50.0, "residual": 50.0})
    log = spark.createDataFrame(pdf)
    run = spark.createDataFrame([("r", 20.0, 25.0, 0.1)], "run_id string, mae double, rmse double, mape double")
    recursive = log.withColumn("horizon", F.lit(1))
    report = {(r.section, r["item"], r.metric): r.value for r in monitoring_report(log, run, recursive).collect()}
    assert report["residuals", "all", "mean"] == 50 and report["residuals", "all", "skewness"] is None
    assert report["drift", "all", "n_days"] == 50 and report["drift", "all", "alert_pct"] == 100
    assert report["thresholds", "mae", "alert"] == 40 and report["horizon", "1", "mae"] == 50


@pytest.mark.parametrize("kind", ["noise", "decay"])
def test_components_by_passes_equal_the_dense_fit(spark, kind):
    """Forty columns without any matrix of their products: a range that passes over the days improve."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 40))
    if kind == "decay":
        x = x @ np.diag(1.0 / np.arange(1, 41)) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    x[:, 7] = 5.0
    days = pd.date_range("2024-01-01", periods=90).date
    rows = [(d, f"TN_{j:03d}", float(x[i, j])) for i, d in enumerate(days) for j in range(40)]
    long = spark.createDataFrame(rows, "date date, column string, value double").repartition(5)
    found = [red.fit_components(long, 3, dense_columns=c) for c in (0, 512)]
    by_pass, dense = (f.loadings.orderBy("component", "column").toPandas() for f in found)
    np.testing.assert_allclose(by_pass.loading, dense.loading, atol=1e-8)
    ratios = [[r.ratio for r in f.explained.orderBy("component").collect()] for f in found]
    np.testing.assert_allclose(*ratios, rtol=1e-9)
    spread = np.where(x.std(0) > 0, x.std(0), 1.0)
    want = np.linalg.svd((x - x.mean(0)) / spread, full_matrices=False)[1] ** 2
    np.testing.assert_allclose(ratios[0], (want / want.sum())[:3], rtol=1e-9)


def test_products_of_days_need_no_pivot(spark):
    """The fit's plan has no pivot and no column per station; the driver gets columns by directions."""
    rng = np.random.default_rng(3)
    at = [[int(j) for j in sorted(rng.choice(600, 500, replace=False))] for _ in range(30)]
    z = [[float(v) for v in rng.normal(size=500)] for _ in range(30)]
    days = spark.createDataFrame(list(zip(at, z)), "at array<int>, z array<double>").repartition(4)
    dense = np.zeros((30, 600))
    for i, (a, v) in enumerate(zip(at, z)):
        dense[i, a] = v
    q = rng.normal(size=(600, 4))
    np.testing.assert_allclose(red.multiply(days, 600, q), dense.T @ (dense @ q), atol=1e-9)
    np.testing.assert_allclose(red.multiply(days, 600), dense.T @ dense, atol=1e-9)
