"""Text ingest on fixtures written here, down to silver and gold."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from wattline.plans.bronze import grid_bronze, station_bronze, station_bronze_wide
from wattline.plans.gold import model_ready
from wattline.plans.silver import build_silver
from wattline.sources import archives, registry, tables
from wattline.sources.grid_files import read_grid_text
from wattline.sources.lines import quote_map, read_lines, with_line_number
from wattline.sources.station_files import read_station_files

NAMES = (
    "Nature\tConsommation\tPrévision J-1\tPrévision J\tFioul\tCharbon\tGaz\tNucléaire\tEolien\tSolaire\t"
    "Hydraulique\tPompage\tBioénergies\tEch. physiques"
)


def grid_lines():
    rows = []
    for i in range(5):
        use = 100 + 10 * i
        cells = [f"2024-01-0{i + 1}", use, use - 2, use - 1, 1, 2, 3, 70 + 5 * i, 4, 5, 6, 0, 1, 8]
        rows.append("\t".join(map(str, cells)))
    return "\n".join([NAMES, *rows]) + "\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "eCO2mix_RTE_Annuel-Definitif_2024.xls").write_text(grid_lines(), encoding="utf-8")
    for variable, start in (("N", {"000000001": 1, "000000002": 2}), ("X", {"000000003": 10, "000000004": 11})):
        sub = tmp_path / f"T{variable}"
        sub.mkdir()
        for station, v in start.items():
            head = [f"meta {i}" for i in range(9)] + ["AAAAMMJJ;VALEUR"]
            body = [f"2024010{i + 1};{v + i}" for i in range(5)]
            (sub / f"SQR_MT{variable}_{station}.csv").write_text("\n".join(head + body))
    return tmp_path


def stations(spark, folder):
    low = read_station_files(spark, str(folder / "TN"), "TN", "SQR_MTN*.csv").rows
    high = read_station_files(spark, str(folder / "TX"), "TX", "SQR_MTX*.csv").rows
    return station_bronze(low, high)


def test_raw_to_model_ready(spark, folder):
    bronze = grid_bronze(read_grid_text(spark, str(folder)))
    assert bronze.count() == 5 and "timestamp" not in bronze.columns
    silver, _ = build_silver(bronze, stations(spark, folder))
    assert silver.columns == [
        "date", "consommation_mw", "prevision_j1_mw", "prevision_j_mw", "production_mw",
        "temp_pc_01", "temp_pc_02", "temp_pc_03",
    ]
    assert [r.production_mw for r in silver.orderBy("date").collect()] == [100, 105, 110, 115, 120]
    gold = model_ready(silver)
    assert gold.table.count() == 4
    assert gold.scaled == ["temp_pc_01", "temp_pc_02", "temp_pc_03", "production_mw_lag1"]
    assert [r.production_mw_lag1 for r in gold.table.orderBy("date").collect()] == [100, 105, 110, 115]
    with pytest.raises(ValueError):
        model_ready(silver, "2030-01-01")


def test_wide_station_table(spark, folder):
    wide = station_bronze_wide(stations(spark, folder)).orderBy("date")
    assert wide.columns == ["date", "TN_000000001", "TN_000000002", "TX_000000003", "TX_000000004"]
    assert tuple(wide.first())[1:] == (1.0, 2.0, 10.0, 11.0)


def test_grid_rules(spark, tmp_path):
    head = "Date\tHeures\tpower\ttext\tgap\tempty"
    rows = []
    for i in range(8):
        gap = f"{i},5" if i % 2 else ""
        rows.append(f"0{i + 1}/02/2023\t{i:02d}:30\t{'ND' if i == 3 else f'{i},25'}\té{i}\t{gap}\t")
    rows.insert(4, "\t\tN/A\t\t\t")
    rows += rows[-2:]
    text = "\n".join([head, *rows]) + "\n"
    (tmp_path / "g_2023.xls").write_bytes(text.encode("cp1252"))
    (tmp_path / "g_2022.xls").write_text("Date\tother\n01/03/2022\t5\n", encoding="utf-8-sig")
    (tmp_path / "g_noyear.xls").write_text("Date\tother\n01/03/2022\t5\n")
    (tmp_path / "g_2021.xls").write_text("only one column\nx\n")
    text = read_grid_text(spark, str(tmp_path), "g_*.xls")
    assert {r.source_file: r.reason for r in text.rejects.collect()} == {
        "g_noyear.xls": "no year in file name",
        "g_2021.xls": "fewer than two columns",
    }
    bronze = grid_bronze(text)
    types = dict(bronze.dtypes)
    assert types["power"] == "double" and types["text"] == "string" and "empty" not in types
    assert types["timestamp"] == "timestamp_ntz"
    got = bronze.where("source_year = 2023").orderBy("timestamp").collect()
    assert len(got) == 8
    assert [r.power for r in got] == [0.25, 1.25, 2.25, None, 4.25, 5.25, 6.25, 7.25]
    assert [r.text for r in got][:2] == ["é0", "é1"]
    assert [r.gap for r in got] == [1.5, 1.5, 3.5, 3.5, 5.5, 5.5, 7.5, 7.5]
    assert str(got[0].timestamp) == "2023-02-01 00:30:00"
    assert bronze.where("source_year = 2022").first().other == 5.0


def test_station_rejects(spark, tmp_path):
    head = "\n".join([f"m{i}" for i in range(9)] + ["X;AAAAMMJJ;VALEUR"]) + "\n"
    good = "a;20240101;1\na;20240101;2\na;2024xx01;9\na;20240102;mq\n"
    (tmp_path / "SQR_MTN_000000001.csv").write_text(head + good)
    (tmp_path / "SQR_MTN_000000002.csv").write_text(head + "a;20240101;oops\na;20240102;3\n")
    (tmp_path / "SQR_MTN_7.csv").write_text(head + good)
    out = read_station_files(spark, str(tmp_path), "TN")
    assert sorted(r.reason for r in out.rejects.collect()) == ["no station id in file name", "value is not a number"]
    rows = out.rows.orderBy("date").collect()
    assert [(str(r.date), r.station, r.value) for r in rows] == [
        ("2024-01-01", "000000001", 2.0),
        ("2024-01-02", "000000001", None),
    ]
    with pytest.raises(FileNotFoundError):
        read_station_files(spark, str(tmp_path), "TN", "none*.csv")


def test_line_numbers_over_file_blocks(spark, tmp_path):
    lines = [f"{i:06d}" for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(lines))
    (tmp_path / "small.txt").write_text("000000\n000001")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = with_line_number(read_lines(spark, str(tmp_path)))
        assert out.select("chunk").distinct().count() > 5
        assert out.where(F.col("line").cast("long") != F.col("line_no")).count() == 0
        assert out.count() == 5002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lines_map_quote_states(spark):
    """(line, ends inside if it begins outside, ends inside if it begins inside)."""
    cases = [
        ("plain", False, True), ("", False, True), ('"a"\t"b"', False, False), ('"a', True, False), ('a"', False, False),
        ('a\t"b', True, False), ('""', False, True), ('"""', True, False), ('"a""', True, False), ('"a""b"c"d', False, True), ('x"y"\tz', False, False),
        ('b"\t"c', False, True), ('5" pipe', False, False),
    ]
    df = spark.createDataFrame([(a,) for a, _, _ in cases], "line string")
    got = df.select("line", *[c.alias(n) for c, n in zip(quote_map(F.col("line")), "oi")]).collect()

    def automaton(line, inside):
        i = 0
        start = not inside
        while i < len(line):
            if inside:
                if line[i] == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif line[i] == '"':
                    inside = False
            elif line[i] == '"' and start:
                inside = True
            start = line[i] == "\t" and not inside
            i += 1
        return inside

    assert [(r.line, r.o, r.i) for r in got] == [(a, automaton(a, False), automaton(a, True)) for a, _, _ in cases]


def test_records_over_many_blocks(spark, tmp_path):
    """Quoted line breaks anywhere, blocks of a few lines; every record as Python's reader has it."""
    import csv
    import random

    rng = random.Random(3)
    want = {}
    for year in (2021, 2022, 2023):
        rows = [["Date", "note", 'odd "name"']]
        for i in range(400):
            note = "".join(rng.choice(["a", "b", " ", '"', "\n", "\t", "é"]) for _ in range(rng.choice([0, 3, 30])))
            rows.append([f"{i}", f"x{note}y" if year < 2023 else "plain", "1"])
        with open(tmp_path / f"g_{year}.xls", "w", newline="") as f:
            csv.writer(f, delimiter="\t", lineterminator="\n").writerows(rows)
        want |= {(year, r[0]): r[1] for r in rows[1:]}
    (tmp_path / "g_2024.xls").write_text('Date\tnote\n1\t"never closed\n2\tb\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        assert read_lines(spark, str(tmp_path)).select("path", "chunk").distinct().count() > 40
        text = read_grid_text(spark, str(tmp_path), "g_*.xls")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(r.source_year, r.Date): r.note for r in text.cells.collect()}
    assert got == want and 'odd "name"' in text.columns
    assert [r.reason for r in text.rejects.collect()] == ["a quote is never closed"]


def test_records_longer_than_blocks(spark, tmp_path):
    """Records over many blocks next to short ones: blocks without a beginning, with one, with many."""
    import csv
    import random

    rng = random.Random(5)
    rows = [["Date", "note"]]
    for i in range(120):
        note = "\n".join(rng.choice(["", "a", 'b"c', '"', "d\te" * 9]) for _ in range(rng.choice([1, 2, 3, 200])))
        rows.append([f"{i}", f"x{note}y"])
    with open(tmp_path / "g_2021.xls", "w", newline="") as f:
        csv.writer(f, delimiter="\t", lineterminator="\n").writerows(rows)
    text = read_grid_text(spark, str(tmp_path), "g_*.xls", blocks="256")
    assert sorted((int(r.Date), r.note) for r in text.cells.collect()) == [(int(a), b) for a, b in rows[1:]]
    places = text.cells.orderBy("chunk", "row").select("Date").collect()
    assert [r.Date for r in places] == [a for a, _ in rows[1:]]


def test_many_small_blocks_are_few_tasks(spark, tmp_path):
    """Tables written on the way have as many files as a shuffle has tasks, not as the file has blocks."""
    import os

    from wattline.catalog import QUERIES
    from wattline.session import work_scope

    rows = spark.range(20000).select(F.col("id").alias("event_id"), F.lit("kind").alias("event_type"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    with work_scope(spark) as folder:
        assert QUERIES["s01_multiline_cells"](spark, str(tmp_path)).count() == 20000
        files = {d: sum(n.startswith("part-") for n in names) for d, _, names in os.walk(folder)}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(files.values()) <= tasks + 2, files


@pytest.mark.parametrize("stamped", [False, True])
def test_sink_rows_are_shuffled_once(spark, stamped):
    """Order and de-duplication share a shuffle; equal rows are one, signed zeros, nulls and structs included."""
    from wattline.plans.bronze import distinct_for_sink

    values = [(None if i % 7 == 0 else i % 50, 0.0 if i % 3 else -0.0, None if i % 5 == 0 else f"t{i % 4}") for i in range(3000)]
    rows = spark.createDataFrame(values, "a long, z double, text string").repartition(6).select(
        "a", "z", F.when(F.col("text").isNotNull(), F.struct(F.lit(1.5).alias("number"), "text")).alias("mixed"),
        (2020 + F.col("a") % 3).cast("int").alias("source_year"),
    )
    if stamped:
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("a") % 9).cast("int"))
        rows = rows.withColumn("timestamp", day.cast("timestamp_ntz"))
    once = distinct_for_sink(rows)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan
    assert once.columns == rows.columns and once.count() == rows.distinct().count()
    assert once.exceptAll(rows.distinct()).isEmpty()
    if stamped:
        for part in once.select("source_year", "timestamp").rdd.glom().collect():
            order = [(y is None, y or 0, t is None, t) for y, t in part]
            assert [o[:3] for o in order] == sorted(o[:3] for o in order)
            assert all(a[3] <= b[3] for a, b in zip(order, order[1:]) if a[:3] == b[:3] and a[3] and b[3])


def test_bronze_reads_cells_once_for_its_choices(spark, tmp_path):
    """The gaps that ``column_facts`` sees are those of the typed columns, file by file."""
    from wattline.functions.grid_rules import coerce_per_file, column_facts, half_missing

    cells = [["1", "2,5", "-0", None, "1e3"], ["x", "", None, "y", "z"], ["1", "2,5", "x", None, "inf"]]
    columns = [f"c{k}" for k in range(12)]

    def cell(f, i, k):
        return cells[k % 3][(i * (k + 1) + f * k) % (1 + (k + f) % 5)] if (i + f) % (k + 1) else None

    rows = [(f"f{f}", *[cell(f, i, k) for k in range(12)]) for f in range(6) for i in range(40)]
    df = spark.createDataFrame(rows, "path string, " + ", ".join(f"{c} string" for c in columns))
    facts = column_facts(df, columns, "path")
    typed = coerce_per_file(df, facts, columns, "path")
    left = [c for c in columns if c in typed.columns]
    want = typed.groupBy("path").agg(*[half_missing(c).alias(c) for c in left])
    got = facts.select("path", *[F.col(f"__half_{c}").alias(c) for c in left])
    assert sorted(got.collect()) == sorted(want.collect()) and any(any(r[1:]) for r in want.collect())
    assert {"double", "string"} <= {t for _, t in typed.select(*left).dtypes} and len(left) > 6


def test_archives(spark, tmp_path):
    for name, members in (("full", {"d/a.csv": "1", "d/": "", "b.csv": "2"}), ("empty", {})):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            for member, text in members.items():
                z.writestr(member, text)
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    out = archives.read_archives(spark, str(tmp_path)).collect()
    assert sorted((r.member, bytes(r.content)) for r in out if r.member) == [("a.csv", b"1"), ("b.csv", b"2")]
    assert sorted(r.archive.rsplit("/", 1)[-1] for r in out if r.error) == ["bad.zip", "empty.zip"]


def run_entry(run_id, **more):
    entry = {"model_file": "m", "scaler_file": "s", "insample_metrics": {"insample_MAE_MW": 1.2, "insample_RMSE_MW": 1.5, "insample_MAPE_pct": 0.1}}
    base = {"run_id": run_id, "run_dir": run_id, "trained_at": f"{run_id[9:13]}-01-01T00:00:00+00:00", "n_training_days": 5,
            "features": ["temp_pc_01", "production_mw_lag1"], "order": [1, 0, 0], "seasonal_order": [0, 0, 0, 0]}
    return base | {k: ({"h7": {}, "h1": entry} if v == "legacy" else entry) for k, v in more.items()}


def test_registry_layouts(spark, tmp_path):
    runs = [run_entry("test_run_2022", model=1), run_entry("test_run_2023", models="legacy"), run_entry("test_run_2024")]
    path = tmp_path / "sarima_metadata.json"
    path.write_text(json.dumps({"latest_run_id": "test_run_2024", "n_runs": 3, "runs": runs}, indent=2))
    flat = registry.flatten_runs(registry.read_registry(spark, str(path))).collect()
    assert [(r.run_id, r.mae) for r in flat] == [("test_run_2024", None), ("test_run_2023", 1.2), ("test_run_2022", 1.2)]
    assert flat[0].features == "temp_pc_01, production_mw_lag1" and flat[0].order == "(1, 0, 0)"


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="silver"):
        tables.read_table(spark, str(tmp_path / "none"), "silver")


def test_zip_in_memory_is_portable(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("x/y.csv", "a\nb")
    df = spark.createDataFrame([("p.zip", buffer.getvalue())], "path string, content binary")
    assert archives.expand_archives(df).first().member == "y.csv"
