"""Projection, cleaning, typing and scalar-function queries (T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.catalog.registry import FUELS, query
from wattline.functions import columns as col
from wattline.functions import grid_rules as rules
from wattline.operators.gaps import complete_days
from wattline.operators.metrics import residual_statistics
from wattline.plans import adapters as src


@query("t01_clean_names", 'SELECT c_custkey AS "customer key", c_name AS name FROM customer')
def t01(spark, sf):
    raw = src.table(spark, sf, "customer").select("c_custkey", "c_name").toDF(" customer\nkey ", "name\n")
    return col.clean_names(raw)


TEXT = ["Date", "Heures", "fuel", "power", "mixed", "sparse", "empty"]


@query(
    "t02_drop_empty_rows",
    'SELECT source_file, row_pos, fuel, power FROM raw_text WHERE coalesce("Date", "Heures", fuel, power, mixed, sparse, empty) IS NOT NULL',
    "raw_text",
)
def t02(spark, sf):
    return rules.drop_empty_rows(src.raw_text(spark, sf), TEXT).select("source_file", "row_pos", "fuel", "power")


@query("t03_drop_empty_columns", "SELECT * EXCLUDE (empty) FROM raw_text", "raw_text")
def t03(spark, sf):
    return rules.drop_empty_columns(src.raw_text(spark, sf), keep=["source_file", "row_pos"])


@query(
    "t04_drop_null_rows",
    'SELECT row_pos, "Date", power, sparse FROM raw_text WHERE "Date" IS NOT NULL AND power IS NOT NULL AND sparse IS NOT NULL',
    "raw_text",
)
def t04(spark, sf):
    rows = src.raw_text(spark, sf).select("row_pos", "Date", "power", "sparse")
    return rows.dropna(subset=["Date"]).dropna()


def tokens_off(spark, sf):
    raw = src.raw_text(spark, sf)
    return raw.withColumns({c: col.null_tokens(F.col(c), col.GRID_NULLS) for c in TEXT})


NUM = "TRY_CAST(trim(replace({c}, ',', '.')) AS DOUBLE)"


@query(
    "t05_mostly_numeric",
    f"SELECT row_pos, fuel, {NUM.format(c='power')} AS power, mixed, {NUM.format(c='sparse')} AS sparse FROM raw_text",
    "raw_text",
)
def t05(spark, sf):
    typed = rules.coerce_mostly_numeric(tokens_off(spark, sf), ["fuel", "power", "mixed", "sparse", "empty"])
    return typed.select("row_pos", "fuel", "power", "mixed", "sparse")


@query(
    "t06_numeric_or_null",
    f"SELECT row_pos, {NUM.format(c='mixed')} AS mixed, {NUM.format(c='power')} AS power FROM raw_text",
    "raw_text",
)
def t06(spark, sf):
    raw = src.raw_text(spark, sf)
    return raw.select(
        "row_pos",
        rules.parsed(F.col("mixed")).alias("mixed"),
        rules.parsed(F.col("power")).alias("power"),
    )


@query(
    "t07_parse_dates",
    """
SELECT row_pos, CAST(try_strptime(d, '%d/%m/%Y') AS DATE) AS day_first, CAST(try_strptime(compact, '%Y%m%d') AS DATE) AS compact
FROM (SELECT row_pos, CASE WHEN row_pos % 7 = 0 THEN 'bad' ELSE "Date" END AS d,
        CASE WHEN row_pos % 11 = 0 THEN '20241399' ELSE substr(source_file, 6, 8) END AS compact FROM raw_text) AS t
""",
    "raw_text",
)
def t07(spark, sf):
    raw = src.raw_text(spark, sf)
    pos = F.col("row_pos")
    day = F.when(pos % 7 == 0, "bad").otherwise(F.col("Date"))
    compact = F.when(pos % 11 == 0, "20241399").otherwise(F.substring("source_file", 6, 8))
    return raw.select(
        "row_pos",
        col.parse_date(day).alias("day_first"),
        col.parse_date(compact, ["yyyyMMdd"]).alias("compact"),
    )


@query(
    "t08_timestamp",
    """
SELECT row_pos, strftime(try_strptime("Date" || ' ' || trim("Heures"), '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M') AS stamp FROM raw_text
""",
    "raw_text",
)
def t08(spark, sf):
    out = col.build_stamp(src.raw_text(spark, sf), "Date", "Heures")
    return out.select("row_pos", F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("stamp"))


@query(
    "t09_require_columns",
    """SELECT "Nature", "Consommation", 'grid bronze: Nature is date, not string; Absent is missing' AS complaint FROM grid""",
    "grid",
)
def t09(spark, sf):
    g = src.grid(spark, sf)
    col.check_schema(g, {"Nature": "date"} | dict.fromkeys([*src.DAILY_MEANS, *src.PRODUCTION], "double"), "grid bronze")
    try:
        col.check_schema(g, {"Nature": "string", "Absent": None}, "grid bronze")
    except ValueError as error:
        text = str(error)
    return g.select("Nature", "Consommation", F.lit(text).alias("complaint"))


CALENDAR_SQL = """
SELECT date, round(sin(2 * pi() * (isodow(date) - 1) / 7), 6) + 0.0 AS dow_sin,
  round(cos(2 * pi() * (isodow(date) - 1) / 7), 6) + 0.0 AS dow_cos,
  round(sin(2 * pi() * dayofyear(date) / 365.25::DOUBLE), 6) + 0.0 AS doy_sin,
  round(cos(2 * pi() * dayofyear(date) / 365.25::DOUBLE), 6) + 0.0 AS doy_cos,
  CASE WHEN isodow(date) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend
FROM daily
"""


@query("t10_select_features", "SELECT date, dow_sin, is_weekend FROM (" + CALENDAR_SQL + ") AS c", "daily")
def t10(spark, sf):
    return col.select_features(t17(spark, sf), ["dow_sin", "is_weekend"])


@query(
    "t11_parse_list",
    """
SELECT c_custkey, array_to_string(list_filter(list_transform(string_split(' temp, ,' || c_mktsegment || ', lag ', ','),
  lambda x: trim(x)), lambda x: x <> ''), '|') AS parts FROM customer
""",
)
def t11(spark, sf):
    raw = F.concat(F.lit(" temp, ,"), F.col("c_mktsegment"), F.lit(", lag "))
    return src.table(spark, sf, "customer").select(
        "c_custkey", F.concat_ws("|", col.parse_list_column(raw)).alias("parts")
    )


@query(
    "t12_leakage_guard",
    'SELECT "Nature" AS date, "Consommation" AS consommation_mw FROM grid',
    "grid",
)
def t12(spark, sf):
    g = src.grid(spark, sf).select(
        F.col("Nature").alias("date"),
        F.col("Consommation").alias("consommation_mw"),
        F.col("Prévision J-1").alias("prevision_j1_mw"),
        F.col("Prévision J").alias("prevision_j_mw"),
    )
    out = col.without_forbidden(g)
    col.guard_leakage(out.columns)
    return out


SUM_FUELS = " + ".join(f'coalesce("{c}", 0)' for c in FUELS)
ANY_FUEL = ", ".join(f'"{c}"' for c in FUELS)


@query(
    "t13_row_total",
    f'SELECT "Nature" AS date, count(*) AS n_rows, count(t) AS n_totals, sum(t) AS total FROM (SELECT "Nature", CASE WHEN coalesce({ANY_FUEL}) IS NOT NULL THEN {SUM_FUELS} END AS t FROM grid) AS x GROUP BY 1',
    "grid",
)
def t13(spark, sf):
    total = col.total_or_null(src.PRODUCTION)
    return (
        src.grid(spark, sf)
        .groupBy(F.col("Nature").alias("date"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count(total).alias("n_totals"), F.sum(total).alias("total"))
    )


@query(
    "t14_station_mean",
    "SELECT date, variable, round(avg(value), 6) AS mean FROM stations GROUP BY 1, 2",
    "stations",
)
def t14(spark, sf):
    return src.stations(spark, sf).groupBy("date", "variable").agg(F.round(F.avg("value"), 6).alias("mean"))


@query(
    "t15_complete_days",
    "SELECT date FROM region_days GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT station) FROM region_days)",
    "region_days",
)
def t15(spark, sf):
    return complete_days(src.stations(spark, sf, "region"), "station")


@query(
    "t16_float32",
    "SELECT date, station, variable, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM stations",
    "stations",
)
def t16(spark, sf):
    return src.stations(spark, sf).withColumn("value", F.col("value").cast("float").cast("double"))


@query("t17_cyclicals", CALENDAR_SQL, "daily")
def t17(spark, sf):
    parts = col.cyclicals(F.col("date"))
    return src.daily(spark, sf).select("date", *[F.round(c, 6).alias(n) for n, c in parts.items()])


@query(
    "t18_calendar_parts",
    """
SELECT date, CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) - 1 AS INTEGER) AS dow, dayname(date) AS day_name,
  CAST(date_trunc('month', date) AS DATE) AS month_start FROM daily
""",
    "daily",
)
def t18(spark, sf):
    return src.daily(spark, sf).select(
        "date",
        F.month("date").alias("month"),
        F.weekday("date").alias("dow"),
        F.date_format("date", "EEEE").alias("day_name"),
        F.trunc("date", "month").alias("month_start"),
    )


@query(
    "t19_date_formats",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute, strftime(ts, '%Y-%m') AS month,
  strftime(ts, '%Y%m%d') || 'T000000Z' AS run_id, strftime(ts, '%Y-%m-%d') || 'T00:00:00+00:00' AS stamp FROM events
""",
)
def t19(spark, sf):
    return src.table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"),
        F.date_format("ts", "yyyy-MM").alias("month"),
        F.date_format("ts", "yyyyMMdd'T000000Z'").alias("run_id"),
        F.date_format("ts", "yyyy-MM-dd'T00:00:00+00:00'").alias("stamp"),
    )


@query(
    "t20_error_columns",
    "SELECT horizon, date, error, abs_error, sq_error, error / actual * 100 AS signed_pct_error FROM fc",
    "fc",
)
def t20(spark, sf):
    log = src.fc(spark, sf).select("horizon", "date", "actual", "predicted")
    return log.select("horizon", "date", *[c.alias(n) for n, c in col.errors(F.col("actual"), F.col("predicted")).items()])


@query("t21_residual", "SELECT date, actual - predicted AS residual FROM fc1", "fc1")
def t21(spark, sf):
    return src.fc1(spark, sf).select("date", (F.col("actual") - F.col("predicted")).alias("residual"))


@query("t22_prefix_columns", "SELECT date, station, TN, TX FROM station_days", "station_days")
def t22(spark, sf):
    wide = src.stations(spark, sf).groupBy("date", "station").pivot("variable", ["TN", "TX"]).agg(F.first("value"))
    return wide.select("date", "station", *col.with_prefix(wide, "TN", "TX"))


@query(
    "t26_rounding",
    """
SELECT horizon, round(avg(abs_error), 0) AS r0, round(avg(abs_error), 1) AS r1, round(avg(abs_error), 2) AS r2,
  round(avg(abs_error), 3) AS r3, round(avg(abs_error), 4) AS r4, round(avg(abs_error), 6) AS r6 FROM fc GROUP BY 1
""",
    "fc",
)
def t26(spark, sf):
    mae = F.avg("abs_error")
    return src.fc(spark, sf).groupBy("horizon").agg(*[F.round(mae, n).alias(f"r{n}") for n in (0, 1, 2, 3, 4, 6)])


@query(
    "t27_model_name",
    "SELECT run_id, 'SARIMAX(2, 0, 1)x(2, 1, 0, 7)' AS model_name, '(' || CAST(year(trained_at) AS VARCHAR) || ',)' AS one FROM runs",
    "runs",
)
def t27(spark, sf):
    order = F.array(*[F.lit(v) for v in (2, 0, 1)])
    seasonal = F.array(*[F.lit(v) for v in (2, 1, 0, 7)])
    return src.runs(spark, sf).select(
        "run_id",
        col.model_name(order, seasonal).alias("model_name"),
        col.order_text(F.array(F.year("trained_at"))).alias("one"),
    )


@query(
    "t28_health_flags",
    """
SELECT p_type, CASE WHEN txt = '' THEN 'OK' ELSE txt END AS health FROM (
  SELECT p_type, concat_ws(', ', CASE WHEN abs(sk) > 1 THEN 'skewness=' || printf('%.2f', sk) END,
    CASE WHEN ku > 3 THEN 'kurtosis=' || printf('%.2f', ku) END,
    CASE WHEN out > 10 THEN printf('%.1f', out) || '% outside 2 sigma' END) AS txt
  FROM (SELECT p_type, skewness(r) AS sk, kurtosis(r) AS ku, 100 * avg(CASE WHEN abs(r) > 2 * sd THEN 1.0 ELSE 0.0 END) AS out
    FROM (SELECT p_type, p_retailprice * p_size AS r, stddev_samp(p_retailprice * p_size) OVER (PARTITION BY p_type) AS sd FROM part) AS a GROUP BY 1) AS b) AS c
""",
)
def t28(spark, sf):
    r = src.table(spark, sf, "part").select("p_type", (F.col("p_retailprice") * F.col("p_size")).alias("residual"))
    stats = residual_statistics(r, "residual", ["p_type"], digits=None)
    outside = F.lit(100.0) - F.col("within_2sigma_pct")
    return stats.select("p_type", col.health_text(F.col("skewness"), F.col("kurtosis"), outside).alias("health"))


@query(
    "t29_display_columns",
    "SELECT run_id, strftime(trained_at, '%Y-%m-%d %H:%M') AS trained_at, mae, rmse, mape, aic, n_training_days FROM runs",
    "runs",
)
def t29(spark, sf):
    r = src.runs(spark, sf).withColumn("trained_at", F.date_format("trained_at", "yyyy-MM-dd HH:mm"))
    names = ["run_id", "trained_at", "mae", "rmse", "mape", "not_there", "aic", "n_training_days"]
    return col.wanted(r, names)
