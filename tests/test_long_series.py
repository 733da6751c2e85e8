"""Operators that work on a series or a group in parts: any number of parts gives the same result."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattline.operators import arx, backtest, diagnostics, distribution, ordered, rolling
from wattline.operators import regression as reg
from wattline.sources import commits, registry
from wattline.operators.joins import resolve_runs
from wattline.session import cut

DAY = dt.date(2020, 1, 1)


def series(spark, values, key="a"):
    """Values by day; the key may be null."""
    return [(key, DAY + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, date date, y double").repartition(5)


@pytest.fixture(scope="module")
def two(spark):
    rng = np.random.default_rng(11)
    walk, ar = rng.normal(size=700).cumsum(), np.zeros(500)
    for t in range(1, 500):
        ar[t] = 0.5 * ar[t - 1] + rng.normal()
    holes = [None if i % 50 == 7 else v for i, v in enumerate(ar)]
    return cut(table(spark, series(spark, walk, "walk") + series(spark, holes, None)), "two")


def results(two):
    """Everything that is summed in blocks, by key."""
    frames = {
        "acf": diagnostics.acf(two, "y", 20, ["k"]),
        "adf": diagnostics.adf(two, "y", ["k"]),
        "adf1": diagnostics.adf(two, "y", ["k"], lags=1),
        "kpss": diagnostics.kpss(two, "y", ["k"]),
        "whole": rolling.decompose(two.where("y IS NOT NULL"), "y", 7, ["k"]),
    }
    out = {n: f.toPandas() for n, f in frames.items()}
    return {n: f.sort_values(list(f.columns[:2]), na_position="first").reset_index(drop=True) for n, f in out.items()}


def test_blocks_change_nothing(spark, two, monkeypatch):
    one = results(two)
    assert set(one["adf"].k) == {"walk", None} and len(one["whole"]) == 700 + 490
    monkeypatch.setattr(ordered, "SERIES_ROWS", 37)
    many = results(two)
    blocks = ordered.series_blocks(two, ["k"], "date", 20)
    assert blocks.select("k", "block").distinct().count() > 20
    for name in one:
        pd.testing.assert_frame_equal(one[name], many[name], rtol=1e-9, check_exact=False)


def test_blocks_hold_what_their_rows_look_at(spark):
    rows = table(spark, series(spark, range(100)))
    got = ordered.series_blocks(rows, ["k"], "date", 5, 3, rows=10).toPandas()
    for block, part in got.groupby("block"):
        want = range(max(0, 10 * block - 5), min(100, 10 * block + 13))
        assert sorted(part.pos) == list(want) and sorted(part.pos[part.own]) == [p for p in want if p // 10 == block]


@pytest.mark.parametrize("test", [diagnostics.adf, diagnostics.kpss])
def test_unit_roots_of_short_series(spark, test):
    rows = [r for n in range(6) for r in series(spark, [1.0, 4.0, 2.0, 7.0, 3.0][:n] or [None], f"{n} values")]
    rows += series(spark, [5.0] * 40, "constant") + series(spark, [1.0, -1.0] * 6, "alternating") + series(spark, [2.0] * 3, None)
    got = {r.k: r for r in test(table(spark, rows), "y", ["k"]).collect()}
    assert len(got) == 9
    for key in ("0 values", "1 values", "constant", None):
        assert got[key].statistic is None and got[key].p is None and got[key].stationary is None
    if test is diagnostics.adf:
        assert all(got[f"{n} values"].statistic is None for n in (2, 3))
        # What the lags explain to the last digit leaves no error to divide by.
        assert got["alternating"].statistic is None
    empty = table(spark, rows).where("false")
    assert test(empty, "y", ["k"]).count() == 0
    assert test(empty, "y").first().statistic is None


def test_stationarity_report_of_a_short_run(spark):
    got = diagnostics.stationarity_report(table(spark, series(spark, [1.0, 2.0, 4.0])), "y").collect()
    assert sorted(r.test for r in got) == ["adf", "kpss"]


def test_ranks_with_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RUN_ROWS", 100)
    rng = np.random.default_rng(5)
    values = np.where(rng.random(6000) < 0.4, 3.5, np.round(rng.normal(size=6000), 3))
    keys = rng.choice(["a", "b", None], 6000, p=[0.7, 0.2, 0.1])
    pdf = pd.DataFrame({"k": keys, "v": values})
    df = spark.createDataFrame(pdf, "k string, v double").repartition(7)
    got = ordered.opened(ordered.ranked_values(df, ["k"], "v")).toPandas()
    for key, part in pdf.groupby("k", dropna=False):
        mine = got[got.k.isna() if pd.isna(key) else got.k == key].sort_values("pos")
        assert list(mine.pos) == list(range(len(part))) and set(mine.total) == {len(part)}
        np.testing.assert_array_equal(mine.v, np.sort(part.v))
    points = distribution.normal_qq(df, "v").toPandas().sort_values("i")
    np.testing.assert_array_equal(points.observed, np.sort(values))
    assert ordered.ranked_values(df.where("false"), [], "v").count() == 0


@pytest.mark.parametrize("error", [1e-2, 1e-4, 1e-6])
def test_density_keeps_its_bound(spark, error):
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.normal(size=900), rng.normal(8, 0.2, 100), [40.0]])
    rows = [("mixed", float(x)) for x in v] + [(None, float(x)) for x in rng.exponential(size=300)]
    rows += [("constant", 2.0)] * 5 + [("one", 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    got, exact = (distribution.kernel_density(df, "v", 60, ["k"], e).toPandas().set_index(["k", "i"]).sort_index() for e in (error, None))
    assert len(got) == len(exact) == 4 * 60
    for key in ("mixed", None):
        x = np.array([b for a, b in rows if a == key])
        h = x.std(ddof=1) * len(x) ** -0.2
        peak = 1 / (h * np.sqrt(2 * np.pi))
        pick = got.index.get_level_values("k").isna() if key is None else got.index.get_level_values("k") == key
        off = np.abs(got.density[pick].to_numpy() - exact.density[pick].to_numpy())
        assert off.max() <= error * peak * 1.0001
        grid = np.linspace(x.min(), x.max(), 60)
        want = np.exp(-(((grid[:, None] - x) / h) ** 2) / 2).sum(1) * peak / len(x)
        np.testing.assert_allclose(exact.density[pick].to_numpy(), want, rtol=1e-9)
    assert got.loc[["constant", "one"]].density.isna().all()


# ---- features chosen by a fit


@pytest.fixture(scope="module")
def chosen_rows(spark):
    """A feature that matters all along, one that starts to matter late, one that never does."""
    rng = np.random.default_rng(12)
    n = 400
    a, b, c = (rng.normal(size=n) for _ in range(3))
    y = 10 + 3 * a + np.where(np.arange(n) < 150, 0, 2.0) * b + rng.normal(size=n)
    pdf = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=n).date, "y": y, "a": a, "b": b, "c": c, "production_mw_lag1": rng.normal(size=n)})
    spec = arx.Spec(order=(1, 0, 1), seasonal=(0, 1, 0, 7), features=("a", "b", "c", "production_mw_lag1"), long_ar=5)
    return spec, cut(arx.design(spark.createDataFrame(pdf), "y", spec), "chosen")


def test_a_probe_picks_once_and_nested_refits_pick_anew(spark, chosen_rows):
    spec, rows = chosen_rows
    rule = {"significant": arx.Chosen(spec, threshold=0.01)}
    probe = backtest.probe_features(rows, rule, 120).first()
    assert probe.features == ["a", "production_mw_lag1"] and probe.method == "p-value"
    logs = {
        nested: backtest.walk_forward(rows, spec, rule, (1, 2), initial=120, every=60, last=280, nested=nested).toPandas()
        for nested in (False, True)
    }
    fixed = {"fixed": spec.of(features=("a", "production_mw_lag1"))}
    plain = backtest.walk_forward(rows, spec, fixed, (1, 2), initial=120, every=60, last=280).toPandas()
    order = ["horizon", "target_date"]
    probed, plain = (f.sort_values(order).predicted.to_numpy() for f in (logs[False], plain))
    np.testing.assert_allclose(probed, plain, rtol=1e-9)
    mae = {nested: log.abs_error[log.target_date > dt.date(2020, 12, 1)].mean() for nested, log in logs.items()}
    assert mae[True] < 0.7 * mae[False]


def test_few_p_values_fall_back_to_coefficients(chosen_rows):
    spec, rows = chosen_rows
    sums = reg.cross_products(rows, [], spec.names)
    fit = arx.fit(sums, {"s": arx.Chosen(spec, fewest=9, top=2)}).first()
    assert fit.features == ["a", "b", "production_mw_lag1"] and fit.method == "coefficient"
    given = sums.withColumn(arx.GIVEN, F.create_map(F.lit("s"), F.array(F.lit("c"))))
    assert arx.fit(given, {"s": arx.Chosen(spec)}).first().terms == ["c", "ar1", "ma1"]


def test_orders_solved_together_equal_each_alone(chosen_rows):
    spec, rows = chosen_rows
    wide, models = backtest.order_grid(spec.of(features=("a",)), 2, 2, 1, 1)
    rows = cut(arx.design(rows.select("date", "y", "a", "b", "c", "production_mw_lag1"), "y", wide), "orders")
    sums = reg.cross_products(rows, [], wide.names).first()
    gram = np.array(sums.products).reshape(len(wide.names), len(wide.names))
    together = arx.estimates(gram, sums.n, wide.names, models)
    assert len(together) == 35
    for name, spec in models.items():
        alone = arx.estimates(gram, sums.n, wide.names, {name: spec})[name]
        np.testing.assert_allclose(together[name]["coef"], alone["coef"], rtol=1e-7, atol=1e-9)
        assert together[name]["rss"] == pytest.approx(alone["rss"], rel=1e-9)


# ---- commits


def test_two_writers_lose_no_run(spark, tmp_path):
    """Both append at once, again and again; every version holds whole appends, each one more than the last."""
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "runs")

    def write(who):
        return [commits.append(spark.createDataFrame([(f"{who}{i}", i), (f"{who}{i}+", i)], "run_id string, n int"), path) for i in range(6)]

    schema = spark.createDataFrame([], "run_id string, n int").schema
    assert commits.read(spark, path, schema).count() == 0
    with ThreadPoolExecutor(2) as pool:
        versions = sorted(v for got in pool.map(write, "ab") for v in got)
    assert versions == list(range(1, 13))
    for version in (1, 5, 12):
        rows = commits.read(spark, path, schema, version).collect()
        assert sorted({r.commit_seq for r in rows}) == list(range(1, version + 1)) and len(rows) == 2 * version
    newest = commits.read(spark, path, schema).collect()
    order = {r.run_id: r.commit_seq for r in newest}
    assert all(order[f"{w}{i}"] == order[f"{w}{i}+"] < order[f"{w}{i + 1}"] for w in "ab" for i in range(5))
    spark.createDataFrame([("lost", 0)], "run_id string, n int").write.parquet(f"{path}/never-claimed")
    assert commits.read(spark, path, schema).count() == 24
    kept = registry.capped(commits.read(spark, path, schema), 4).collect()
    assert {r.latest_run_id for r in kept} == {max(newest, key=lambda r: (r.commit_seq, r.run_id)).run_id} and len(kept) == 4


# ---- the latest run


def test_one_rule_for_the_latest_run(spark):
    stamp = dt.datetime(2024, 6, 1)
    rows = [("new", dt.date(2024, 5, 1), stamp, [1], [0]), ("late", dt.date(2015, 1, 1), stamp + dt.timedelta(1), [2], [0])]
    runs = spark.createDataFrame(rows, "run_id string, trained_at date, appended_at timestamp, `order` array<int>, seasonal_order array<int>")
    asked = spark.createDataFrame([(1, None), (2, "new"), (3, "x")], "id int, run_id string")
    assert registry.run_metadata(runs).first().run_id == "late"
    assert registry.latest_status(runs, runs.select("run_id")).first().latest_run_id == "late"
    got = {r.id: (r.run_id, r.found) for r in resolve_runs(asked, runs).collect()}
    assert got == {1: ("late", True), 2: ("new", True), 3: ("x", False)}
    assert registry.run_metadata(runs.drop("appended_at")).first().run_id == "new"
