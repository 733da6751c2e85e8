"""Ordered, gap, quantile and window operators against pandas and NumPy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattline.functions import columns as col
from wattline.functions import grid_rules
from wattline.operators import gaps, metrics, ordered, rolling
from wattline.operators.frames import one_of_each
from wattline.operators.quantiles import exact_quantiles

DAYS = pd.date_range("2024-01-01", periods=40)


def series(spark, values, days=DAYS):
    rows = [(d.date(), None if pd.isna(v) else float(v)) for d, v in zip(days, values)]
    return spark.createDataFrame(rows, "date date, y double")


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


def close(a, b, tol=1e-9):
    a = np.array([np.nan if v is None else v for v in a], dtype=float)
    np.testing.assert_allclose(a, np.asarray(b, dtype=float), rtol=tol, atol=tol)


def test_interpolation_matches_pandas(spark):
    v = np.arange(40.0) ** 1.5
    v[[0, 1, 5, 6, 7, 20, 38, 39]] = np.nan
    s = pd.Series(v, index=DAYS)
    holes = s.drop(DAYS[10:13])
    df = series(spark, holes.to_numpy(), holes.index)
    out = gaps.interpolate_time(gaps.densify(df), ["y"])
    close(column(out, "y"), holes.asfreq("D").interpolate(method="time"))


def test_fill_both_matches_pandas(spark):
    v = [np.nan, 1, np.nan, np.nan, 4, np.nan]
    out = gaps.fill_both(series(spark, v), ["y"])
    close(column(out, "y"), pd.Series(v).ffill().bfill())


@pytest.mark.parametrize("chunk", [1, 3, 1000])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_chunked_fill_with_a_hot_file(spark, chunk, direction):
    rng = np.random.default_rng(3)
    files = rng.choice(["hot", "a", "b"], 300, p=[0.8, 0.1, 0.1])
    v = np.where(rng.random(300) < 0.7, np.nan, rng.normal(size=300))
    pdf = pd.DataFrame({"f": files, "pos": np.arange(300), "v": v})
    rows = [(r.f, int(r.pos), None if pd.isna(r.v) else float(r.v)) for r in pdf.itertuples()]
    df = ordered.with_chunk(spark.createDataFrame(rows, "f string, pos long, v double"), "pos", chunk)
    out = ordered.fill(df, ["f"], "chunk", "pos", ["v"], direction)
    want = pdf.groupby("f")["v"].transform(lambda s: s.bfill() if direction == "backward" else s.ffill())
    close(column(out, "v", "pos"), want)
    at = column(ordered.positions(df, ["f"], "chunk", "pos", "at"), "at", "pos")
    assert at == pdf.groupby("f").cumcount().tolist()


def test_keep_last(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, None), ("k", 2, "b"), ("m", 1, "c")], "k string, o int, v string")
    out = {r.k: (r.o, r.v) for r in ordered.keep_last(df, ["k"], ["o"]).collect()}
    assert out == {"k": (3, None), "m": (1, "c")}


@pytest.mark.parametrize("kind", ["continuous", "ties", "one value", "skewed"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(5)
    n = 60_000
    v = {
        "continuous": rng.normal(size=n),
        "ties": rng.integers(0, 7, n).astype(float),
        "one value": np.full(n, 2.5),
        "skewed": np.exp(rng.normal(size=n) * 6),
    }[kind]
    g = np.where(rng.random(n) < 0.9, "hot", "cold").astype(object)
    g[0], v[0] = "single", 1.0
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v})).repartition(16)
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.q for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for name in ("hot", "cold", "single"):
        np.testing.assert_allclose(got[name], np.quantile(v[g == name], probs), rtol=1e-12)
    whole = exact_quantiles(df, [], "v", probs).first().q
    np.testing.assert_allclose(whole, np.quantile(v, probs), rtol=1e-12)


def test_moving_mean_and_rolling_errors(spark):
    v = np.sin(np.arange(40.0))
    v[[3, 4, 5, 20]] = np.nan
    df = series(spark, v)
    out = df.withColumn("m", rolling.moving_mean(F.col("y"), [], 10, 5))
    close(column(out, "m"), pd.Series(v).rolling(10, min_periods=5).mean())


def test_decomposition(spark):
    rng = np.random.default_rng(1)
    n, x = 40, np.arange(40)
    y = 0.3 * x + np.array([5, 0, -3, 1, 2, -4, -1])[x % 7] + rng.normal(size=n)
    trend = np.convolve(y, np.ones(7) / 7, "valid")
    full = np.full(n, np.nan)
    full[3 : n - 3] = trend
    k, b = np.polyfit(np.arange(3, 10), full[3:10], 1)
    full[:3] = k * np.arange(3) + b
    tail = np.arange(n - 11, n - 4)
    k, b = np.polyfit(tail, full[tail], 1)
    full[n - 3 :] = k * np.arange(n - 3, n) + b
    means = np.array([np.mean((y - full)[p::7]) for p in range(7)])
    seasonal = (means - means.mean())[x % 7]
    out = rolling.decompose(series(spark, y), "y")
    close(column(out, "trend"), full, 1e-8)
    close(column(out, "seasonal"), seasonal, 1e-8)
    close(column(out, "residual"), y - full - seasonal, 1e-8)


def test_residual_statistics_match_pandas(spark):
    r = np.exp(np.random.default_rng(2).normal(size=40))
    got = metrics.residual_statistics(series(spark, r), "y", digits=None).first()
    s = pd.Series(r)
    close(
        [got.mean, got.std, got.skewness, got.kurtosis, got.within_1sigma_pct],
        [s.mean(), s.std(), s.skew(), s.kurtosis(), (s.abs() <= s.std()).mean() * 100],
    )


def test_residual_statistics_of_a_constant_and_of_three_rows(spark):
    flat = metrics.residual_statistics(series(spark, [50.0] * 10), "y").first()
    assert flat.std == 0 and flat.skewness is None and flat.kurtosis is None
    few = metrics.residual_statistics(series(spark, [1.0, 2.0, 4.0]), "y").first()
    assert few.kurtosis is None and few.skewness is not None


def test_insample_metrics_fixture(spark):
    log = spark.createDataFrame([(100.0, 90.0), (200.0, 210.0), (300.0, 330.0), (None, 1.0)], "actual double, predicted double")
    assert tuple(metrics.error_metrics(log).first()) == (16.67, 19.15, 8.3333)
    assert metrics.error_metrics(log.limit(0)).count() == 0


def test_zero_actual_does_not_divide(spark):
    log = spark.createDataFrame([(0.0, 1.0), (10.0, 10.0)], "actual double, predicted double")
    assert metrics.error_metrics(log).first().mape > 1e15


def test_islands_and_longest(spark):
    days = [DAYS[i] for i in (0, 1, 2, 5, 6, 10, 11, 12, 13)]
    got = gaps.islands(series(spark, [1.0] * 9, days)).orderBy("start").collect()
    assert [r.n_days for r in got] == [3, 2, 4]
    best = gaps.longest_island(spark.createDataFrame(got)).first()
    assert best.n_days == 4 and best.window_start == DAYS[0].date() and best.window_end == DAYS[13].date()


def test_one_to_one_guard(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="not unique"):
        one_of_each(df, ["k"], "left").collect()


def test_feature_selection_fixture(spark):
    df = spark.createDataFrame([(1.0, 100.0, 0.0), (2.0, 110.0, 0.5)], "temp_pc_01 double, production_mw_lag1 double, dow_sin double")
    assert col.select_features(df, ["dow_sin", "temp_pc_01"], ()).columns == ["dow_sin", "temp_pc_01"]
    with pytest.raises(ValueError, match="nope"):
        col.select_features(df, ["nope"], ())
    with pytest.raises(ValueError, match="prevision_j_mw"):
        col.guard_leakage(["temp_pc_01", "prevision_j_mw"])


def test_number_parsing(spark):
    cells = ["1,5", " 2 ", "-3e2", "1d", "0x1A", "abc", "", None, "NaN"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = column(df.withColumn("v", grid_rules.parsed(F.col("c"))), "v", "i")
    assert got == [1.5, 2.0, -300.0, None, None, None, None, None, None]


def test_mostly_numeric_threshold(spark):
    rows = [("1", "1") if i < 7 else ("2", "x") if i == 7 else ("y", "x") for i in range(10)]
    out = grid_rules.coerce_mostly_numeric(spark.createDataFrame(rows, "a string, b string"), ["a", "b"])
    assert dict(out.dtypes) == {"a": "double", "b": "string"}
