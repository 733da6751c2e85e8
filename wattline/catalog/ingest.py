"""Source, sink and registry queries (S, T-23 to T-25, X-01, X-02)."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from wattline.catalog.registry import query
from wattline.functions import columns as col
from wattline.operators.frames import attach
from wattline.plans import adapters as src
from wattline.plans import bronze, jobs
from wattline.session import work_path
from wattline.sources import archives, commits, manifest, registry, tables
from wattline.sources.grid_files import read_grid_text
from wattline.sources.lines import list_files, read_lines, split_rejects
from wattline.sources.station_files import read_station_files

YEAR_DIR = r"year=(\d{4})/"
STATION_DIR = r"place=(\d{9})/"


def text_folder(spark, sf, frame, name):
    """Rows written as tab-separated text, one folder per year."""
    path = work_path(spark, name)
    frame.write.partitionBy("year").option("header", True).option("sep", "\t").csv(path)
    return path


def raw_files(spark, sf, *without):
    raw = src.raw_text(spark, sf).withColumn("year", F.lit(2024)).drop("source_file", *without)
    return text_folder(spark, sf, raw, "grid-text")


@query(
    "s01_grid_text",
    'SELECT CAST(row_pos AS VARCHAR) AS row_pos, "Date", trim("Heures") AS "Heures", fuel, nullif(trim(power), \'ND\') AS power, mixed, sparse, 2024 AS source_year FROM raw_text',
    "raw_text",
)
def s01(spark, sf):
    text = read_grid_text(spark, raw_files(spark, sf), "*.csv", YEAR_DIR)
    trimmed = {c: F.trim(c) for c in ("Heures", "power")}
    return text.cells.withColumns(trimmed).select(
        "row_pos", "Date", "Heures", "fuel", "power", "mixed", "sparse", "source_year"
    )


#: Small blocks, so that quoted cells lie across their borders.
BLOCKS = "16k"


@query(
    "s01_multiline_cells",
    """
SELECT CAST(event_id AS VARCHAR) AS row_pos, event_type AS kind, CASE event_id % 5 WHEN 0 THEN 'n' || event_id || chr(10) || '"' || event_type || '"' || chr(10) || chr(10) || 'tail' || chr(9) || 'end'
  WHEN 1 THEN 'say "x"' WHEN 2 THEN '"' ELSE 'plain' END AS note, 2024 AS source_year FROM events
""",
)
def s01_multiline(spark, sf):
    """Cells with line breaks, tabs and quotes, in one large file that is read in many blocks."""
    i = F.col("event_id")
    long = F.concat(F.lit("n"), i, F.lit('\n"'), "event_type", F.lit('"\n\ntail\tend'))
    note = F.when(i % 5 == 0, long).when(i % 5 == 1, 'say "x"').when(i % 5 == 2, '"').otherwise("plain")
    rows = src.table(spark, sf, "events").select(i.alias("row_pos"), F.col("event_type").alias("kind"), note.alias("note"))
    path = work_path(spark, "quoted")
    out = rows.withColumn("year", F.lit(2024)).repartition("year").write.partitionBy("year").option("header", True)
    out.option("sep", "\t").option("escape", '"').csv(path)
    text = read_grid_text(spark, path, "*.csv", YEAR_DIR, BLOCKS)
    return text.cells.select("row_pos", "kind", "note", "source_year")


@query(
    "t05_mixed_column",
    """
SELECT i, CASE WHEN i % 2 = 0 AND i % 50 <> 0 THEN CAST(replace(amount, ',', '.') AS DOUBLE) END AS number,
  CASE WHEN i % 2 = 1 THEN CASE WHEN i % 3 = 0 THEN amount ELSE 'n.c.' END END AS text FROM raw_amount
""",
    "raw_amount",
)
def t05_mixed(spark, sf):
    """A column that holds numbers in the files of one year and text in those of another, through the bronze table."""
    i = F.col("event_id")
    amount = F.regexp_replace(F.col("value").cast("decimal(18,2)").cast("string"), "\\.", ",")
    cell = F.when(i % 50 == 0, "bad").when((i % 2 == 0) | (i % 3 == 0), amount).otherwise("n.c.")
    rows = src.table(spark, sf, "events").select(i.alias("i"), cell.alias("cell"), (2023 + i % 2).alias("year"))
    path, text = work_path(spark, "bronze"), read_grid_text(spark, text_folder(spark, sf, rows, "grid-mixed"), "*.csv", YEAR_DIR)
    tables.write_table(bronze.grid_bronze(text), path, ["source_year"])
    stored = spark.read.parquet(path)
    number = F.schema_of_variant("cell") == "DOUBLE"
    return stored.select(
        F.col("i").cast("long").alias("i"),
        F.when(number, F.try_variant_get("cell", "$", "double")).alias("number"),
        F.when(~number, F.try_variant_get("cell", "$", "string")).alias("text"),
    )


def station_folder(spark, sf):
    """One text file per station and variable: nine metadata lines, a header, then days."""
    rows = src.stations(spark, sf).withColumn("place", F.col("station"))
    day = F.date_format("date", "yyyyMMdd")
    value = F.when(F.dayofmonth("date") == 13, "mq").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    data = rows.select("variable", "place", F.datediff("date", F.lit("1970-01-01").cast("date")).alias("at"), F.concat_ws(";", day, value).alias("value"))
    top = F.explode(F.array(*[F.struct(F.lit(i - 100).alias("at"), F.lit(t).alias("value")) for i, t in enumerate([f"# {n}" for n in range(9)] + ["AAAAMMJJ;VALEUR"])]))
    heads = rows.select("variable", "place").distinct().select("variable", "place", top.alias("t")).select("variable", "place", "t.*")
    path = work_path(spark, "stations")
    (
        data.unionByName(heads)
        .repartition("variable", "place")
        .sortWithinPartitions("variable", "place", "at")
        .select("variable", "place", "value")
        .write.partitionBy("variable", "place")
        .text(path)
    )
    return path


STATION_SQL = """
SELECT date, station, variable, CASE WHEN day(date) <> 13 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) END AS value FROM stations
"""


def both_variables(spark, sf):
    path = station_folder(spark, sf)
    low, high = (
        read_station_files(spark, f"{path}/variable={v}", v, station_pattern=STATION_DIR).rows for v in ("TN", "TX")
    )
    return bronze.station_bronze(low, high)


@query("s02_station_files", STATION_SQL, "stations")
def s02(spark, sf):
    return both_variables(spark, sf).withColumn("value", F.col("value").cast("double"))


@query(
    "s03_input_files",
    """
SELECT CAST(row_number() OVER (ORDER BY source_file) - 1 AS INTEGER) AS seq, source_file, n_lines FROM
  (SELECT 'place=' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS source_file, count(*) AS n_lines FROM customer GROUP BY 1) AS f
""",
)
def s03(spark, sf):
    """The sorted listing of a folder, and the lines of each file in it."""
    path = work_path(spark, "names")
    rows = src.table(spark, sf, "customer")
    place = F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("place")
    rows.select("c_name", place).repartition("place").write.partitionBy("place").text(path)
    name = F.regexp_extract("path", "(place=[0-9]+)/", 1).alias("source_file")
    files = list_files(spark, path, "*.txt").select("seq", name)
    counts = read_lines(spark, path, "*.txt").groupBy(name).agg(F.count(F.lit(1)).alias("n_lines"))
    return files.join(counts, "source_file").select("seq", "source_file", "n_lines")


@query(
    "s04_quarantine",
    "SELECT event_type, count(*) AS n_rows, count(*) FILTER (event_id % 97 = 0) AS n_bad, count(*) FILTER (event_id % 97 = 0 AND event_type < 'p') > 0 AS rejected FROM events GROUP BY 1",
)
def s04(spark, sf):
    """One file per event type; those with an unparsable cell are set aside whole."""
    i = F.col("event_id")
    rows = src.table(spark, sf, "events").select(
        F.col("event_type").alias("path"),
        (i % 97 == 0).alias("odd"),
        F.when((i % 97 == 0) & (F.col("event_type") < "p"), "x,y").otherwise(F.col("value").cast("string")).alias("cell"),
    )
    bad = F.bool_or(F.col("cell").try_cast("double").isNull())
    verdict = rows.groupBy("path").agg(F.when(bad, "value is not a number").alias("reason"))
    good, rejects = split_rejects(rows, verdict)
    kept = good.withColumn("rejected", F.lit(False))
    gone = rows.join(rejects.select("path"), "path", "left_semi").withColumn("rejected", F.lit(True))
    return kept.unionByName(gone).groupBy(F.col("path").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("odd").alias("n_bad"), F.first("rejected").alias("rejected")
    )


@query(
    "s04_rejected_files",
    """
SELECT station, n_rows, CASE WHEN CAST(station AS INTEGER) % 5 = 0 THEN 'value is not a number' END AS reason FROM
  (SELECT station, CASE WHEN CAST(station AS INTEGER) % 5 <> 0 THEN count(*) END AS n_rows FROM station_days GROUP BY 1) AS s
""",
    "station_days",
)
def s04_files(spark, sf):
    """Station files through their reader: one bad value sets a whole file aside, with its reason."""
    folder = f"{station_folder(spark, sf)}/variable=TN"
    path = work_path(spark, "damaged")
    lines = read_lines(spark, folder, recursive=True)
    place = F.regexp_extract("path", "place=([0-9]+)", 1)
    damaged = (place.cast("int") % 5 == 0) & F.col("line").rlike("^[0-9]{6}13;")
    text = F.when(damaged, "19960313;oops").otherwise(F.col("line"))
    spread = lines.select(place.alias("place"), "chunk", "row", text.alias("value")).repartition("place")
    spread.sortWithinPartitions("place", "chunk", "row").select("place", "value").write.partitionBy("place").text(path)
    found = read_station_files(spark, path, "TN", station_pattern=STATION_DIR)
    kept = found.rows.groupBy("station").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("string").alias("reason"))
    gone = found.rejects.select(F.regexp_extract("path", STATION_DIR, 1).alias("station"), F.lit(None).cast("long").alias("n_rows"), "reason")
    return kept.unionByName(gone)


@query("s05_archives", "SELECT event_type || '.csv' AS member, count(*) AS n_lines, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def s05(spark, sf):
    """Batches of readings packed into archives by the tasks, then expanded again."""

    def pack(batches):
        for n, batch in enumerate(batches):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w") as z:
                z.writestr("folder/", "")
                for kind, part in batch.groupby("event_type"):
                    z.writestr(f"folder/{kind}.csv", "\n".join(part["event_id"].astype(str)))
            yield pd.DataFrame({"path": [f"{n}.zip"], "content": [buffer.getvalue()]})

    packed = src.table(spark, sf, "events").select("event_id", "event_type").mapInPandas(pack, "path string, content binary")
    members = archives.expand_archives(packed)
    lines = members.select("member", F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line"))
    return lines.groupBy("member").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("line").cast("long")).alias("ids"))


@query(
    "s06_ingest_gate",
    "SELECT station, count(*) AS n_files, CASE WHEN count(*) >= 1300 THEN 'complete' ELSE 'redo' END AS status FROM station_days GROUP BY 1",
    "station_days",
)
def s06(spark, sf):
    files = src.stations(spark, sf).where(F.col("variable") == "TN")
    return manifest.completeness(files, "station", "date", 1300)


@query(
    "s06_new_files",
    "SELECT DISTINCT date FROM readings WHERE date > DATE '2024-01-10'",
    "readings",
)
def s06_new(spark, sf):
    files = src.readings(spark, sf).select("date").distinct()
    known = files.where(F.col("date") <= F.lit("2024-01-10").cast("date"))
    return manifest.new_files(files, known, "date")


@query("s07_pruned_read", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def s07(spark, sf):
    return tables.read_table(spark, f"{sf}/lineitem.parquet", "lineitem", ["l_orderkey", "l_extendedprice"])


@query("s08_parquet_write", "SELECT date, production FROM prod", "prod")
def s08(spark, sf):
    path = work_path(spark, "prod")
    tables.write_table(src.prod(spark, sf).withColumn("source_year", F.year("date")), path, ["source_year"])
    return tables.read_table(spark, path, "prod", ["date", "production"])


def run_structs(spark, sf):
    """Runs in the registry's nested form; some in the legacy layout, some bare."""
    i = F.month("trained_at") + F.year("trained_at")
    metrics = F.struct(
        F.col("mae").alias("insample_MAE_MW"),
        F.col("rmse").alias("insample_RMSE_MW"),
        F.col("mape").alias("insample_MAPE_pct"),
    )
    entry = F.struct(
        F.concat(F.lit("sarima_"), "run_id").alias("model_file"),
        F.concat(F.lit("scaler_"), "run_id").alias("scaler_file"),
        F.lit(None).cast("string").alias("metadata_file"),
        F.lit(None).cast("string").alias("report_file"),
        metrics.alias("insample_metrics"),
        F.struct("aic", "bic", F.col("llf").alias("log_likelihood")).alias("goodness_of_fit"),
    )
    legacy = (
        F.when(i % 4 == 1, F.create_map(F.lit("h7"), entry, F.lit("h1"), entry))
        .when(i % 4 == 2, F.create_map(F.lit("h7"), entry))
    )
    return src.runs(spark, sf).select(
        "run_id",
        F.col("run_id").alias("run_dir"),
        F.date_format("trained_at", "yyyy-MM-dd'T00:00:00+00:00'").alias("trained_at"),
        F.col("training_start").cast("string").alias("training_start"),
        F.col("training_end").cast("string").alias("training_end"),
        F.col("n_training_days").cast("int").alias("n_training_days"),
        F.array(F.lit("temp_pc_01"), F.lit("production_mw_lag1")).alias("features"),
        F.array(*[F.lit(v) for v in (2, 0, 1)]).alias("order"),
        F.array(*[F.lit(v) for v in (2, 1, 0, 7)]).alias("seasonal_order"),
        F.when(i % 4 == 0, entry).alias("model"),
        legacy.alias("models"),
    )


def registry_rows(spark, sf, cap=8):
    path = work_path(spark, "registry")
    registry.registry_document(run_structs(spark, sf).withColumn(registry.APPENDED, F.col("trained_at")), cap).write.text(path)
    return registry.read_registry(spark, path)


@query(
    "s09_registry_read",
    "SELECT CAST(row_number() OVER (ORDER BY trained_at) - 1 AS INTEGER) AS seq, run_id, n_training_days::INTEGER AS n_training_days,"
    " (SELECT max(run_id) FROM runs) AS latest_run_id FROM (SELECT * FROM runs ORDER BY trained_at DESC LIMIT 8) AS last_runs",
    "runs",
)
def s09(spark, sf):
    return registry_rows(spark, sf).select("seq", "run_id", "n_training_days", "latest_run_id")


@query(
    "s10_committed_appends",
    """
SELECT run_id, n_training_days, mae, 1 + (year(trained_at) >= 1998)::BIGINT + (year(trained_at) >= 2000)::BIGINT AS commit_seq,
  (SELECT max(run_id) FROM runs) AS latest_run_id FROM runs
""",
    "runs",
)
def s10_commits(spark, sf):
    """Three appends as three versions; rows know their commit, and the latest run is of the last one."""
    path, runs = work_path(spark, "commits"), src.runs(spark, sf).select("run_id", "trained_at", "n_training_days", "mae")
    year = F.year("trained_at")
    for part in (year < 1998, (year >= 1998) & (year < 2000), year >= 2000):
        version = commits.append(runs.where(part), path)
    table = commits.read(spark, path, runs.schema, version)
    latest = registry.run_metadata(table).select(F.col("run_id").alias("latest_run_id"))
    return attach(table.select("run_id", "n_training_days", "mae", "commit_seq"), latest)


@query("s10_registry_write", "SELECT run_id, n_training_days, mae FROM runs", "runs")
def s10(spark, sf):
    """Two appends to the runs table; a second writer loses nothing."""
    path = work_path(spark, "runs")
    all_runs = src.runs(spark, sf)
    old = F.col("trained_at") < F.lit("1999-01-01").cast("date")
    for part in (all_runs.where(old), all_runs.where(~old)):
        tables.write_table(part, path, ["run_id"], mode="append")
    return spark.read.parquet(path).select(F.col("run_id").cast("string").alias("run_id"), "n_training_days", "mae")


@query("s11_csv_export", "SELECT run_id, mae, rmse, mape FROM runs", "runs")
def s11(spark, sf):
    path = work_path(spark, "csv")
    tables.write_csv(src.runs(spark, sf).select("run_id", "mae", "rmse", "mape"), path)
    return spark.read.option("header", True).schema("run_id string, mae double, rmse double, mape double").csv(path)


@query(
    "s12_year_from_name",
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS source_year, count(*) AS n FROM lineitem GROUP BY 1",
)
def s12(spark, sf):
    name = F.concat(F.lit("grid_"), F.year("l_shipdate").cast("string"), F.lit(".xls"))
    rows = src.table(spark, sf, "lineitem").select(col.year_from_name(name).alias("source_year"))
    return rows.groupBy("source_year").agg(F.count(F.lit(1)).alias("n"))


RUN_INDEX = "(month(trained_at) + year(trained_at)) % 4"


@query(
    "t23_model_entry",
    f"SELECT run_id, CASE WHEN {RUN_INDEX} <> 3 THEN mae END AS mae, CASE WHEN {RUN_INDEX} <> 3 THEN 'sarima_' || run_id END AS model_file FROM runs",
    "runs",
)
def t23(spark, sf):
    entry = registry.resolved_model(F.col("model"), F.col("models"))
    return run_structs(spark, sf).select(
        "run_id", entry["insample_metrics"]["insample_MAE_MW"].alias("mae"), entry["model_file"].alias("model_file")
    )


@query(
    "t24_flatten_registry",
    f"""
SELECT run_id, strftime(trained_at, '%Y-%m-%d') AS day, CASE WHEN {RUN_INDEX} <> 3 THEN rmse END AS rmse, CASE WHEN {RUN_INDEX} <> 3 THEN aic END AS aic,
  'temp_pc_01, production_mw_lag1' AS features, '(2, 0, 1)' AS "order", '(2, 1, 0, 7)' AS seasonal_order
FROM (SELECT * FROM runs ORDER BY trained_at DESC LIMIT 8) AS kept
""",
    "runs",
)
def t24(spark, sf):
    flat = registry.flatten_runs(registry_rows(spark, sf))
    day = F.date_format(F.to_utc_timestamp("trained_at", F.current_timezone()), "yyyy-MM-dd")
    return flat.select("run_id", day.alias("day"), "rmse", "aic", "features", "order", "seasonal_order")


@query(
    "t25_metadata_defaults",
    """
SELECT run_id, CASE WHEN year(trained_at) % 2 = 0 THEN 'temp_pc_02' ELSE 'temp_pc_01|production_mw_lag1' END AS features,
  CASE WHEN year(trained_at) % 2 = 0 THEN 'temp_pc_02' ELSE 'temp_pc_01|production_mw_lag1' END AS scale_columns, '2|0|1' AS "order" FROM runs
""",
    "runs",
)
def t25(spark, sf):
    entries = run_structs(spark, sf)
    even = F.substring("run_id", 1, 4).cast("int") % 2 == 0
    none = F.array().cast("array<string>")
    meta = entries.select(
        "run_id",
        F.when(even, F.array(F.lit("temp_pc_02"))).otherwise(none).alias("features"),
        F.array().cast("array<int>").alias("order"),
        F.array().cast("array<int>").alias("seasonal_order"),
    )
    out = registry.with_defaults(meta, entries.select("run_id", "features", "order", "seasonal_order"))
    return out.select("run_id", *[F.concat_ws("|", c).alias(c) for c in ("features", "scale_columns", "order")])


@query(
    "m16_run_metadata",
    """
SELECT run_id, 'SARIMAX(2, 0, 1)x(2, 1, 0, 7)' AS model_name, training_start::VARCHAR AS training_start, training_end::VARCHAR AS training_end,
  n_training_days::INTEGER AS n_training_days, year(trained_at) >= 1999 AS available FROM runs
""",
    "runs",
)
def m16(spark, sf):
    runs = run_structs(spark, sf)
    stored = runs.where(F.substring("run_id", 1, 4) >= "1999").select("run_id").withColumn("available", F.lit(True))
    asked = runs.select("run_id")
    found = asked.join(runs, "run_id").join(stored, "run_id", "left")
    return found.select(
        "run_id",
        col.model_name(F.col("order"), F.col("seasonal_order")).alias("model_name"),
        "training_start",
        "training_end",
        "n_training_days",
        F.coalesce("available", F.lit(False)).alias("available"),
    )


@query(
    "m17_latest_status",
    "SELECT 'ok' AS status, true AS model_loaded, max(run_id) AS latest_run_id, 'SARIMAX(2, 0, 1)x(2, 1, 0, 7)' AS model_name FROM runs",
    "runs",
)
def m17(spark, sf):
    runs = run_structs(spark, sf)
    return registry.latest_status(runs, runs.select("run_id"))


@query(
    "m17_degraded_status",
    "SELECT 'degraded' AS status, false AS model_loaded, max(run_id) AS latest_run_id, CAST(NULL AS VARCHAR) AS model_name FROM runs",
    "runs",
)
def m17_degraded(spark, sf):
    """The latest run's artefacts are gone; those of the runs before it don't help."""
    runs = run_structs(spark, sf)
    stored = runs.orderBy(F.desc("run_id")).offset(1)
    return registry.latest_status(runs, stored.select("run_id"))


@query(
    "m16_default_run",
    """
SELECT 'default' AS asked, run_id, n_training_days::INTEGER AS n_training_days FROM runs WHERE run_id = (SELECT max(run_id) FROM runs)
UNION ALL SELECT 'named', run_id, n_training_days::INTEGER FROM runs WHERE run_id = '19991231T000000Z'
""",
    "runs",
)
def m16_default(spark, sf):
    """Metadata of the latest run where none is named, of one run by its id, and none for an unknown id."""
    runs = run_structs(spark, sf)
    asked = {"default": None, "named": "19991231T000000Z", "unknown": "no_such_run"}
    parts = [registry.run_metadata(runs, i).withColumn("asked", F.lit(a)) for a, i in asked.items()]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.select("asked", "run_id", "n_training_days")


@query(
    "m16_late_backfill",
    """
SELECT run_id, n_training_days::INTEGER AS n_training_days, (SELECT run_id FROM latest_run) AS latest_run_id
FROM runs WHERE run_id = (SELECT run_id FROM latest_run)
""",
    "latest_run",
)
def m16_late(spark, sf):
    """The default run is the one that the registry document names."""
    runs = src.late_backfill(run_structs(spark, sf))
    path = work_path(spark, "registry")
    registry.registry_document(runs, 8).write.text(path)
    named = registry.read_registry(spark, path).select("run_id", "latest_run_id")
    return registry.run_metadata(runs).join(named, "run_id").select("run_id", "n_training_days", "latest_run_id")


@query(
    "m17_late_backfill",
    "SELECT 'ok' AS status, true AS model_loaded, run_id AS latest_run_id, 'SARIMAX(2, 0, 1)x(2, 1, 0, 7)' AS model_name FROM latest_run",
    "latest_run",
)
def m17_late(spark, sf):
    runs = src.late_backfill(run_structs(spark, sf))
    return registry.latest_status(runs, runs.select("run_id"))


GRID_COLUMNS = ["Consommation", "Prévision J-1", "Prévision J", *src.PRODUCTION]


@query(
    "x01_grid_bronze",
    "SELECT DISTINCT strftime(\"Nature\", '%Y-%m-%d') AS \"Nature\", "
    + ", ".join(f'"{c}"' for c in GRID_COLUMNS)
    + ', CAST(year("Nature") AS INTEGER) AS source_year FROM grid',
    "grid",
)
def x01(spark, sf):
    """All columns of the grid files, from their folder to the written table."""
    g = src.grid(spark, sf).withColumn("year", F.year("Nature"))
    written, _ = jobs.bronze_grid(
        spark, text_folder(spark, sf, g, "grid-years"), work_path(spark, "bronze"), "*.csv", YEAR_DIR
    )
    return written.select("Nature", *[F.col(f"`{c}`") for c in GRID_COLUMNS], "source_year")


STAMPED = """
SELECT DISTINCT "Date", trim("Heures") AS "Heures", fuel, strftime(try_strptime("Date" || ' ' || trim("Heures"), '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M') AS stamp,
  CASE WHEN i % 17 <> 0 THEN CAST(replace(amount, ',', '.') AS DOUBLE) END AS power, 2024::INTEGER AS source_year
FROM (SELECT * FROM raw_text JOIN raw_amount ON row_pos = i) AS r WHERE row_pos % 13 <> 0
"""


@query("x01_stamped_bronze", STAMPED, "raw_text")
def x01_stamped(spark, sf):
    """Files with a date and an hour column, null tokens and empty lines, through the job."""
    written, _ = jobs.bronze_grid(spark, raw_files(spark, sf, "row_pos"), work_path(spark, "bronze"), "*.csv", YEAR_DIR)
    return written.select(
        "Date",
        F.trim("Heures").alias("Heures"),
        "fuel",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("stamp"),
        "power",
        "source_year",
    ).distinct()


@query(
    "x02_station_bronze",
    "SELECT date, "
    + ", ".join(
        f"CAST(CAST(max({v}) FILTER (station = '{s:09d}' AND day(date) <> 13) AS FLOAT) AS DOUBLE) AS {v}_{s:09d}"
        for v in ("TN", "TX")
        for s in range(25)
    )
    + " FROM station_days GROUP BY 1",
    "station_days",
)
def x02(spark, sf):
    wide = bronze.station_bronze_wide(both_variables(spark, sf))
    return wide.select("date", *[F.col(c).cast("double").alias(c) for c in wide.columns if c != "date"])
