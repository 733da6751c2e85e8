"""Damaged inputs, results that no cap may change, and plans that hold at scale."""

import datetime as dt
import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.functions import columns as col
from wattline.operators import distribution, frames, gaps, metrics, regression
from wattline.operators import reduction as red
from wattline.plans import jobs, training
from wattline.plans.adapters import DAILY_MEANS, PRODUCTION
from wattline.plans.silver import daily_grid
from wattline.sources import archives, registry
from wattline.sources.grid_files import read_grid_text
from wattline.sources.lines import read_lines


def test_one_damaged_member_spoils_no_other(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("good.csv", "a" * 2000)
        z.writestr("broken.csv", "".join(chr(97 + i % 26) for i in range(5000)))
        at = z.getinfo("broken.csv").header_offset
    raw = bytearray(buffer.getvalue())
    raw[at + 60 : at + 90] = bytes(30)
    frame = spark.createDataFrame([("x.zip", bytes(raw))], "path string, content binary")
    out = {r.member: r for r in archives.expand_archives(frame).collect()}
    assert bytes(out["good.csv"].content) == b"a" * 2000 and out["good.csv"].error is None
    assert out["broken.csv"].content is None and out["broken.csv"].error


def test_bad_days_drop_out(spark):
    names = ["Nature", *DAILY_MEANS, *PRODUCTION]
    rows = [(d, *[float(i)] * (len(names) - 1)) for i, d in enumerate(["2024-01-01", "02/01/2024", "no day", "", None])]
    schema = "Nature string, " + ", ".join(f"`{n}` double" for n in names[1:])
    out = daily_grid(spark.createDataFrame(rows, schema)).orderBy("date").collect()
    assert [(str(r.date), r.consommation_mw) for r in out] == [("2024-01-01", 0.0), ("2024-01-02", 1.0)]


def test_registry_keeps_what_was_appended_last(spark):
    day = dt.datetime
    rows = [
        ("a", "2024-05-01", day(2024, 5, 1)),
        ("b", "2024-06-01", day(2024, 6, 1)),
        ("old_backfill", "2013-12-31", day(2024, 6, 2)),
        ("tie", "2014-12-31", day(2024, 6, 2)),
    ]
    runs = spark.createDataFrame(rows, "run_id string, trained_at string, appended_at timestamp")
    kept = registry.capped(runs, 2)
    assert {r.run_id for r in kept.collect()} == {"old_backfill", "tie"}
    assert kept.first().latest_run_id == "tie"
    text = registry.registry_document(runs, 3).first().value
    assert text.index('"b"') < text.index('"old_backfill","trained') < text.index('"tie","trained')


def test_metadata_of_one_run_or_the_latest(spark):
    runs = spark.createDataFrame([("a", 1), ("c", 3), ("b", 3)], "run_id string, trained_at int")
    assert [r.run_id for r in registry.run_metadata(runs).collect()] == ["c"]
    assert [r.run_id for r in registry.run_metadata(runs, "a").collect()] == ["a"]
    assert registry.run_metadata(runs, "x").isEmpty()


def test_predictors_far_from_zero(spark):
    rng = np.random.default_rng(3)
    x = 1e6 + rng.normal(size=400)
    frame = spark.createDataFrame([(float(v), 3 + 2 * (float(v) - 1e6)) for v in x], "x double, y double").repartition(4)
    out = {r.term: r for r in regression.least_squares(frame, [], ["x"], "y").collect()}
    assert out["x"].coef == pytest.approx(2.0, rel=1e-7) and out["x"].rank == 2
    assert out["intercept"].coef == pytest.approx(3 - 2e6, rel=1e-6)


def test_no_intercept_and_no_rows(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9)], "x double, y double")
    out = regression.least_squares(frame, [], ["x"], "y", intercept=False).collect()
    assert len(out) == 1 and out[0].coef == pytest.approx((2 + 8.2 + 17.7) / 14)
    assert regression.least_squares(frame.where("false"), [], ["x"], "y").count() == 0


def test_ties_of_one_day(spark):
    at = dt.datetime
    rows = [("late", at(2024, 1, 1, 9), 1.0), ("early", at(2024, 1, 1, 8), 1.0), ("also", at(2024, 1, 1, 8), 1.0)]
    runs = spark.createDataFrame(rows, "run_id string, trained_at timestamp, mae double")
    best = metrics.best_and_worst(runs, ["mae"]).first()
    assert best.best_run == best.worst_run == "also"


def test_all_components_reach_requests(spark):
    rng = np.random.default_rng(5)
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(40)]
    rows = [(d, f"TN_{j:09d}", float(rng.normal())) for d in days for j in range(5)]
    fit = red.fit_components(spark.createDataFrame(rows, "date date, column string, value double"))
    asked = spark.createDataFrame([(4.0, 12.0)], "temp_min_avg double, temp_max_avg double")
    assert len(red.project_requests(asked, red.national_projection(fit)).first().pca_components) == 5


def test_run_ids_stay_text(spark, tmp_path):
    run = spark.createDataFrame([("0012", 1.0)], "run_id string, mae double")
    assert training.register(run, str(tmp_path / "runs")).first().run_id == "0012"


def test_lists_of_names_have_a_bound(spark, monkeypatch):
    monkeypatch.setattr(frames, "MOST_NAMES", 2)
    rows = [(dt.date(2024, 1, 1 + i), f"TN_{s}", float(i * s)) for i in range(4) for s in (1, 2, 3)]
    long = spark.createDataFrame(rows, "date date, column string, value double")
    with pytest.raises(ValueError, match="more than 2 station columns"):
        red.fit_components(long)
    with pytest.raises(Exception, match="more than 2 stations"):
        gaps.on_shared_dates(long, "column", "value").collect()
    assert gaps.on_shared_dates(long.where("column <> 'TN_3'"), "column", "value").count() == 8


def test_no_shared_dates_is_a_named_error(spark):
    empty = spark.createDataFrame([], "date date, column string, value double")
    with pytest.raises(ValueError, match="no station"):
        red.fit_components(empty)


def test_schema_check_lists_in_the_asked_order(spark):
    frame = spark.createDataFrame([(1, "a")], "n int, t string")
    with pytest.raises(ValueError, match="x: z is missing; t is string, not double; b is missing"):
        col.check_schema(frame, {"z": None, "t": "double", "n": "int", "b": None}, "x")


def test_folders_are_read_flat_unless_asked(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n2\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.txt").write_text("3\n")
    assert read_lines(spark, str(tmp_path), "*.txt").count() == 2
    assert read_lines(spark, str(tmp_path), "*.txt", recursive=True).count() == 3


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_text_is_scanned_once_for_any_number_of_layouts(spark, tmp_path):
    for year, head in ((2021, "Date\ta\tb"), (2022, "Date\tb\tc"), (2023, "a\tDate\tc\td")):
        (tmp_path / f"g_{year}.xls").write_text(f"{head}\n" + "\t".join("1234"[: head.count("\t") + 1]) + "\n")
    text = read_grid_text(spark, str(tmp_path), "g_*.xls")
    plan = text.cells._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan
    assert plan.count("grid-lines") <= 2 and "Union" not in plan
    got = {r.source_year: (r.Date, r.a, r.b, r.c, r.d) for r in text.cells.collect()}
    assert got == {2021: ("1", "2", "3", None, None), 2022: ("1", None, "2", "3", None), 2023: ("2", "1", None, "3", "4")}


def test_small_statistics_are_joined_without_moving_rows(spark):
    rows = spark.range(20000).selectExpr("id % 3 AS k", "CAST(id AS DOUBLE) AS v")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        stats = rows.groupBy("k").agg(F.avg("v").alias("m"))
        joined = frames.attach_stats(rows, stats, ["k"])
        assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
        box = distribution.box_statistics(rows, "v", ["k"])
        assert "SortMergeJoin" not in box._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_unseen_days_at_head_inside_and_tail(spark):
    d = lambda k: dt.date(2024, 1, k)
    rows = [("a", d(1)), ("a", d(2)), ("a", d(9)), ("b", d(4)), ("b", d(4)), ("b", d(6))]
    frame = spark.createDataFrame(rows, "station string, date date")
    got = sorted((r.station, r.date.day) for r in gaps.unseen_days(frame, "station").collect())
    assert got == [("a", k) for k in (3, 4, 5, 6, 7, 8)] + [("b", k) for k in (1, 2, 3, 5, 7, 8, 9)]


def test_inverse_normal_matches_the_library(spark):
    from statistics import NormalDist

    p = [1e-300, 1e-20, 1e-9, 0.02, 0.07, 0.0751, 0.3, 0.5, 0.6, 0.925, 0.99, 1 - 1e-12]
    frame = spark.createDataFrame([(v,) for v in p], "p double").select("p", distribution.inverse_normal(F.col("p")).alias("z"))
    for row in frame.collect():
        assert row.z == pytest.approx(NormalDist().inv_cdf(row.p), rel=1e-12, abs=1e-15)


def test_layers_are_written_and_read_back(spark, tmp_path):
    names = ["Nature", *DAILY_MEANS, *PRODUCTION]
    for year in (2023, 2024):
        lines = ["\t".join([f"{year}-01-0{i}", *[str(i * 10 + j) for j in range(len(names) - 1)]]) for i in range(5, 0, -1)]
        (tmp_path / f"eCO2mix_RTE_Annuel-Definitif_{year}.xls").write_text("\n".join(["\t".join(names), *lines]) + "\n")
    (tmp_path / "eCO2mix_RTE_Annuel-Definitif_bad.xls").write_text("x\ty\n1\t2\n")
    for v in "NX":
        (tmp_path / f"T{v}").mkdir()
        for s in (1, 2):
            body = [f"{y}010{i};{i * s + (v == 'X')}" for y in (2023, 2024) for i in range(1, 6)]
            text = "\n".join([f"m{k}" for k in range(9)] + ["AAAAMMJJ;VALEUR"] + body)
            (tmp_path / f"T{v}" / f"SQR_MT{v}_00000000{s}.csv").write_text(text)
    out = lambda n: str(tmp_path / "out" / n)
    grid, rejects = jobs.bronze_grid(spark, str(tmp_path), out("grid"))
    assert grid.count() == 10 and rejects.count() == 1
    assert {r.source_year for r in grid.select("source_year").distinct().collect()} == {2023, 2024}
    stations, _ = jobs.bronze_stations(spark, str(tmp_path / "TN"), str(tmp_path / "TX"), out("stations"))
    assert stations.count() == 40
    silver = jobs.silver(spark, out("grid"), out("stations"), out("silver"), k=2)
    assert silver.count() == 10 and "temp_pc_02" in silver.columns
    gold = jobs.gold(spark, out("silver"), out("gold"), "2023-01-01", "2023-01-05")
    assert gold.table.count() == 4 and gold.features[:2] == ["temp_pc_01", "temp_pc_02"]


def test_a_scope_removes_its_tables(spark):
    from pathlib import Path

    from wattline.session import cut, shared_root, work_scope

    outer = shared_root(spark)
    with work_scope(spark) as folder:
        assert cut(spark.range(5)).count() == 5
        assert any(Path(folder.removeprefix("file:")).iterdir())
    assert shared_root(spark) == outer and not Path(folder.removeprefix("file:")).exists()
