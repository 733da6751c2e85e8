"""Filter, join and set-operation queries (F, J, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.catalog.aggregates import rounded
from wattline.catalog.registry import query
from wattline.operators import gaps, joins, ordered, peaks, rolling
from wattline.operators.checkpoints import expanding
from wattline.plans import adapters as src
from wattline.plans.silver import join_one_to_one


@query(
    "f01_date_range",
    "SELECT date, production FROM prod WHERE date BETWEEN (SELECT min(date) FROM daily) AND (SELECT max(date) FROM daily)",
    "prod daily",
)
def f01(spark, sf):
    orders = src.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    rows = joins.within_days(src.table(spark, sf, "lineitem"), "l_shipdate", orders)
    return src.production_per_day(rows)


@query(
    "f02_training_window",
    """SELECT * FROM (SELECT date, y, lag(y) OVER (ORDER BY date) AS y_lag1 FROM filled) AS x
WHERE date BETWEEN DATE '1996-03-01' AND DATE '1999-02-28'""",
    "filled",
)
def f02(spark, sf):
    lagged = src.filled(spark, sf).withColumn("y_lag1", gaps.lagged("y", 1))
    return joins.training_window(lagged, "1996-03-01", "1999-02-28")


@query(
    "f03_warmup",
    "SELECT horizon, date, error FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY date) AS n FROM fc) AS x WHERE n > 60",
    "fc",
)
def f03(spark, sf):
    return rolling.after_warmup(src.fc(spark, sf).select("horizon", "date", "error"), 60, ["horizon"])


@query("f04_peaks_only", "SELECT horizon, date, actual, round(peak_threshold, 5) AS peak_threshold FROM fc_peaks WHERE is_peak", "fc_peaks")
def f04(spark, sf):
    rows = peaks.with_peaks(src.fc(spark, sf), ["horizon"], 28).where("is_peak")
    return rounded(rows.select("horizon", "date", "actual", "peak_threshold"), 5, "peak_threshold")


@query(
    "f05_run_lookup",
    """
SELECT r.date, coalesce(r.run_id, (SELECT max(run_id) FROM runs)) AS run_id, runs.mae, runs.run_id IS NOT NULL AS found
FROM requests r LEFT JOIN runs ON runs.run_id = coalesce(r.run_id, (SELECT max(run_id) FROM runs))
""",
    "requests runs",
)
def f05(spark, sf):
    out = joins.resolve_runs(src.requests(spark, sf), src.runs(spark, sf))
    return out.select("date", "run_id", "mae", "found")


@query(
    "f05_late_backfill",
    """
SELECT r.date, coalesce(r.run_id, (SELECT run_id FROM latest_run)) AS run_id, runs.mae, runs.run_id IS NOT NULL AS found
FROM requests r LEFT JOIN runs ON runs.run_id = coalesce(r.run_id, (SELECT run_id FROM latest_run))
""",
    "requests latest_run",
)
def f05_late(spark, sf):
    """Requests that name no run get the one appended last, though others were trained on later days."""
    out = joins.resolve_runs(src.requests(spark, sf), src.late_backfill(src.runs(spark, sf)))
    return out.select("date", "run_id", "mae", "found")


@query(
    "f06_last_rows",
    "SELECT horizon, date, error FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY date DESC) AS n FROM fc) AS x WHERE n <= 180",
    "fc",
)
def f06(spark, sf):
    return rolling.last_rows(src.fc(spark, sf).select("horizon", "date", "error"), 180, ["horizon"])


@query("j01_one_to_one", "SELECT date, y, production FROM daily JOIN prod USING (date)", "daily prod")
def j01(spark, sf):
    return join_one_to_one(src.daily(spark, sf), src.prod(spark, sf), ["date"])


@query(
    "j02_left_calendar",
    "SELECT prod.date, daily.y FROM prod LEFT JOIN daily ON daily.date = prod.date",
    "prod daily",
)
def j02(spark, sf):
    return src.prod(spark, sf).select("date").join(src.daily(spark, sf), "date", "left")


WIDE = [f"{v}_{s:09d}" for v in ("TN", "TX") for s in range(5)]


@query(
    "j03_outer_alignment",
    "SELECT date, "
    + ", ".join(f"max({w[:2]}) FILTER (station = '{w[3:]}') AS {w}" for w in WIDE)
    + " FROM region_days GROUP BY 1",
    "region_days",
)
def j03(spark, sf):
    rows = src.stations(spark, sf, "region")
    return joins.wide_by_station(rows, WIDE, F.concat_ws("_", "variable", "station"))


@query(
    "j04_intersection",
    """SELECT date, y, production_lag1 FROM daily JOIN (SELECT date, lag(production) OVER (ORDER BY date) AS production_lag1 FROM prod) AS p USING (date)
WHERE production_lag1 IS NOT NULL""",
    "daily prod",
)
def j04(spark, sf):
    lagged = src.prod(spark, sf).select("date", gaps.lagged("production", 1).alias("production_lag1")).dropna()
    return joins.intersect_series(src.daily(spark, sf), lagged)


@query("j05_calendar_difference", "SELECT date FROM cal WHERE date NOT IN (SELECT date FROM daily)", "cal daily")
def j05(spark, sf):
    series = src.daily(spark, sf)
    return gaps.calendar(series).join(series.select("date"), "date", "left_anti")


@query(
    "j06_expanding_sets",
    """
SELECT checkpoint, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(c) AS BIGINT) AS cents, min(date) AS first_date, max(date) AS last_date
FROM (SELECT checkpoint FROM half_years WHERE checkpoint <= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)) AS k
JOIN (SELECT CAST(l_shipdate AS DATE) AS date, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem) AS l ON l.date <= k.checkpoint GROUP BY 1
""",
    "half_years",
)
def j06(spark, sf):
    rows = src.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), src.cents("l_extendedprice").alias("c")
    )
    return expanding(rows, "date", src.FIRST_CHECKPOINT, {"cents": F.col("c")})


ORIGINS = """
, placed AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n FROM filled),
starts AS (SELECT date AS start_date FROM placed WHERE pos >= greatest(0, n - 365 - 14) AND pos < n - 14 AND (pos - greatest(0, n - 365 - 14)) % 14 = 0)
"""


@query(
    "j07_origins_horizons",
    ORIGINS + "SELECT start_date, CAST(h AS INTEGER) AS horizon, f.date AS target_date, f.y AS actual"
    " FROM starts, generate_series(1, 14) AS g(h) JOIN filled f ON f.date = start_date + CAST(h AS INTEGER)",
    "filled",
)
def j07(spark, sf):
    series = src.filled(spark, sf)
    return joins.with_targets(joins.origins(series, 14, 14, 365), series, "y", 14)


@query(
    "j08_broadcast_average",
    """
SELECT r.date, c."column", CASE WHEN c."column" LIKE 'TN%' THEN temp_min_avg ELSE temp_max_avg END AS value
FROM requests r, (SELECT DISTINCT variable || '_' || station AS "column" FROM stations) AS c
""",
    "requests stations",
)
def j08(spark, sf):
    names = src.stations(spark, sf).select(F.concat_ws("_", "variable", "station").alias("column"))
    return joins.spread_national(src.requests(spark, sf), names).select("date", "column", "value")


@query(
    "u01_union_columns",
    'SELECT "Nature" AS date, "Fioul" AS fioul, CASE WHEN year("Nature") >= 1998 THEN "Solaire" END AS solaire,'
    ' CASE WHEN year("Nature") < 1998 THEN "Gaz" END AS gaz FROM grid',
    "grid",
)
def u01(spark, sf):
    g = src.grid(spark, sf)
    old = g.where(F.year("Nature") < 1998).select(
        F.col("Nature").alias("date"), F.col("Fioul").alias("fioul"), F.col("Gaz").alias("gaz")
    )
    new = g.where(F.year("Nature") >= 1998).select(
        F.col("Nature").alias("date"), F.col("Solaire").alias("solaire"), F.col("Fioul").alias("fioul")
    )
    return joins.union_all_columns([old, new])


@query(
    "u02_tagged_union",
    "SELECT 'all' AS experiment, date, value FROM stations UNION ALL SELECT lower(variable), date, value FROM stations",
    "stations",
)
def u02(spark, sf):
    rows = src.stations(spark, sf)
    parts = {
        "all": rows,
        "tn": rows.where(F.col("variable") == "TN"),
        "tx": rows.where(F.col("variable") == "TX"),
    }
    return joins.tagged_union({k: f.select("date", "value") for k, f in parts.items()}, "experiment")


@query(
    "u03_distinct_rows",
    "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS day FROM lineitem",
)
def u03(spark, sf):
    return (
        src.table(spark, sf, "lineitem")
        .select("l_suppkey", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("day"))
        .dropDuplicates()
    )


@query(
    "u04_keep_last",
    """SELECT user_id, date, event_id, value FROM (SELECT *, CAST(ts AS DATE) AS date, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS n FROM events) AS x WHERE n = 1""",
)
def u04(spark, sf):
    rows = src.table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("date"), "event_id", "value")
    return ordered.keep_last(rows, ["user_id", "date"], ["event_id"])


@query(
    "u05_distinct_dates",
    "SELECT variable, count(DISTINCT date) AS n_date, count(DISTINCT station) AS n_station FROM stations GROUP BY 1",
    "stations",
)
def u05(spark, sf):
    return joins.distinct_counts(src.stations(spark, sf), ["date", "station"], ["variable"])
