"""Gap handling and resampling queries (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.catalog.registry import query
from wattline.functions.grid_rules import alternating_columns
from wattline.operators import gaps
from wattline.operators.ordered import fill, positions, with_chunk
from wattline.operators.topk import top_rows
from wattline.plans import adapters as src


@query("g01_densify", "SELECT date, y FROM dense", "dense")
def g01(spark, sf):
    return gaps.densify(src.daily(spark, sf))


@query("g02_interpolate_time", "SELECT date, y FROM filled", "filled")
def g02(spark, sf):
    return gaps.interpolate_time(gaps.densify(src.daily(spark, sf)), ["y"])


@query("g02_interpolate_time_keyed", "SELECT series, date, y FROM keyed_filled", "keyed_filled")
def g02_keyed(spark, sf):
    dense = gaps.densify(src.keyed_daily(spark, sf), ["series"])
    return gaps.interpolate_time(dense, ["y"], ["series"])


@query(
    "g03_fill_both",
    """
SELECT date, station, coalesce(
  last_value(TN IGNORE NULLS) OVER (PARTITION BY station ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(TN IGNORE NULLS) OVER (PARTITION BY station ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
FROM (SELECT d.date, s.station, t.TN FROM (SELECT DISTINCT date FROM station_days) d
      CROSS JOIN (SELECT DISTINCT station FROM station_days) s
      LEFT JOIN station_days t ON t.date = d.date AND t.station = s.station) AS holes
""",
    "station_days",
)
def g03(spark, sf):
    low = src.stations(spark, sf).where(F.col("variable") == "TN")
    return gaps.fill_both(gaps.on_shared_dates(low, "station", "value"), ["value"], ["station"])


@query(
    "g04_alternating_gaps",
    """
SELECT source_file,
  n >= 4 AND p BETWEEN 0.35 AND 0.65 AND ((pe >= 0.9 AND po <= 0.1) OR (po >= 0.9 AND pe <= 0.1)) AS power,
  n >= 4 AND s BETWEEN 0.35 AND 0.65 AND ((se >= 0.9 AND so <= 0.1) OR (so >= 0.9 AND se <= 0.1)) AS sparse
FROM (
  SELECT source_file, count(*) AS n,
    avg(CASE WHEN power IS NULL THEN 1.0 ELSE 0.0 END) AS p,
    avg(CASE WHEN pos % 2 = 0 THEN CASE WHEN power IS NULL THEN 1.0 ELSE 0.0 END END) AS pe,
    avg(CASE WHEN pos % 2 = 1 THEN CASE WHEN power IS NULL THEN 1.0 ELSE 0.0 END END) AS po,
    avg(CASE WHEN sparse IS NULL THEN 1.0 ELSE 0.0 END) AS s,
    avg(CASE WHEN pos % 2 = 0 THEN CASE WHEN sparse IS NULL THEN 1.0 ELSE 0.0 END END) AS se,
    avg(CASE WHEN pos % 2 = 1 THEN CASE WHEN sparse IS NULL THEN 1.0 ELSE 0.0 END END) AS so
  FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY row_pos) - 1 AS pos FROM raw_text) AS placed
  GROUP BY 1) AS rates
""",
    "raw_text",
)
def g04(spark, sf):
    placed = positions(with_chunk(src.raw_text(spark, sf), "row_pos"), ["source_file"], "chunk", "row_pos")
    return alternating_columns(placed, ["power", "sparse"], ["source_file"])


@query(
    "g05_backfill",
    """
SELECT source_file, row_pos, first_value(sparse IGNORE NULLS) OVER (
  PARTITION BY source_file ORDER BY row_pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sparse
FROM raw_text
""",
    "raw_text",
)
def g05(spark, sf):
    rows = with_chunk(src.raw_text(spark, sf), "row_pos", 4096)
    out = fill(rows, ["source_file"], "chunk", "row_pos", ["sparse"], "backward")
    return out.select("source_file", "row_pos", "sparse")


@query(
    "g06_lag1",
    "SELECT date, production, lag(production) OVER (ORDER BY date) AS production_lag1 FROM prod",
    "prod",
)
def g06(spark, sf):
    series = gaps.interpolate_time(gaps.densify(src.prod(spark, sf)), ["production"])
    return series.withColumn("production_lag1", gaps.lagged("production", 1))


@query(
    "g07_differences",
    """
SELECT date, y - lag(y, 1) OVER w AS d1, y - lag(y, 7) OVER w AS d7,
  (y - lag(y, 7) OVER w) - lag(d, 1) OVER w AS d7_d1
FROM (SELECT *, y - lag(y, 7) OVER (ORDER BY date) AS d FROM filled) AS seasonal
WINDOW w AS (ORDER BY date)
""",
    "filled",
)
def g07(spark, sf):
    s = src.filled(spark, sf)
    s = gaps.differenced(s, "y", [1], "d1")
    s = gaps.differenced(s, "y", [7], "d7")
    return gaps.differenced(s, "y", [7, 1], "d7_d1").drop("y")


@query(
    "g08_daily_sum",
    """
SELECT days.date, coalesce(round(total, 4), 0) AS total FROM
  (SELECT CAST(unnest(generate_series((SELECT min(date) FROM readings), (SELECT max(date) FROM readings), INTERVAL 1 DAY)) AS DATE) AS date) AS days
LEFT JOIN (SELECT date, sum(value) AS total FROM readings GROUP BY 1) AS t ON t.date = days.date
""",
    "readings",
)
def g08(spark, sf):
    out = gaps.daily_sum(src.readings(spark, sf), F.col("date"), F.col("value"), "total")
    return out.withColumn("total", F.round("total", 4))


@query(
    "g09_monthly_mean",
    """
SELECT CAST(date_trunc('month', f.date) AS DATE) AS month, round(avg(y), 4) AS y, round(avg(production), 4) AS production
FROM filled f JOIN prod p ON p.date = f.date GROUP BY 1
""",
    "filled prod",
)
def g09(spark, sf):
    both = src.filled(spark, sf).join(src.prod(spark, sf), "date")
    out = gaps.monthly_mean(both, ["y", "production"])
    return out.select("month", F.round("y", 4).alias("y"), F.round("production", 4).alias("production"))


@query(
    "g10_missing_dates",
    "SELECT series, date FROM keyed_dense WHERE y IS NULL",
    "keyed_dense",
)
def g10(spark, sf):
    return gaps.missing_dates(src.keyed_daily(spark, sf), ["series"])


ISLANDS = """
SELECT {k} min(date) AS start, max(date) AS "end", count(*) AS n_days FROM
  (SELECT *, date - CAST(row_number() OVER ({p} ORDER BY date) AS INTEGER) AS run FROM (SELECT DISTINCT {k} date FROM {t} {w}) AS d) AS marked
GROUP BY {k} run
"""


@query("g11_islands", ISLANDS.format(k="", p="", t="daily", w=""), "daily")
def g11(spark, sf):
    return gaps.islands(src.daily(spark, sf))


@query(
    "g11_islands_keyed",
    ISLANDS.format(k="station,", p="PARTITION BY station", t="station_days", w=""),
    "station_days",
)
def g11_keyed(spark, sf):
    return gaps.islands(src.stations(spark, sf), ["station"])


@query(
    "g12_longest_coverage",
    f"""
, full_days AS (SELECT date FROM region_days GROUP BY 1
                HAVING count(*) = (SELECT count(DISTINCT station) FROM region_days)),
  r AS ({ISLANDS.format(k="", p="", t="full_days", w="")})
SELECT *, (SELECT min(start) FROM r) AS window_start, (SELECT max("end") FROM r) AS window_end
FROM r ORDER BY n_days DESC, start LIMIT 1
""",
    "region_days",
)
def g12(spark, sf):
    rows = src.stations(spark, sf, area="region")
    return gaps.longest_island(gaps.islands(gaps.complete_days(rows, "station")))


@query(
    "g13_station_gaps",
    f"""
, holes AS (SELECT s.station, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM
    (SELECT DISTINCT station FROM station_days) s, (SELECT min(date) AS lo, max(date) AS hi FROM station_days) b),
  gone AS (SELECT h.station, h.date FROM holes h ANTI JOIN station_days t ON t.station = h.station AND t.date = h.date),
  r AS ({ISLANDS.format(k="station,", p="PARTITION BY station", t="gone", w="")})
SELECT * FROM r ORDER BY n_days DESC, station, start LIMIT 30
""",
    "station_days",
)
def g13(spark, sf):
    gone = gaps.unseen_days(src.stations(spark, sf), "station")
    return top_rows(gaps.islands(gone, ["station"]), [F.desc("n_days"), F.asc("station"), F.asc("start")], 30)
