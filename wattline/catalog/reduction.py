"""Feature reduction queries (P) and the silver and gold compositions (X-03, X-04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattline.catalog.aggregates import DAILY_GRID, rounded
from wattline.catalog.registry import VIEWS, query, time_fill
from wattline.operators import reduction as red
from wattline.plans import adapters as src
from wattline.plans.gold import model_ready
from wattline.plans.silver import build_silver, daily_grid, join_one_to_one, temperature_features
from wattline.session import cut, work_path

VIEWS["region_columns"] = (
    "region_days",
    "SELECT date, 'TN_' || station AS col, TN AS value FROM region_days"
    " UNION ALL SELECT date, 'TX_' || station, TX FROM region_days",
)
VIEWS["region_filled"] = (
    "region_columns",
    """
SELECT date, col, coalesce(
  last_value(value IGNORE NULLS) OVER (PARTITION BY col ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY col ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
FROM (SELECT d.date, c.col, r.value FROM (SELECT DISTINCT date FROM region_columns) d CROSS JOIN (SELECT DISTINCT col FROM region_columns) c
      LEFT JOIN region_columns r ON r.date = d.date AND r.col = c.col) AS holes
""",
)
VIEWS["region_z"] = (
    "region_filled",
    "SELECT date, col, (value - avg(value) OVER (PARTITION BY col)) / stddev_pop(value) OVER (PARTITION BY col) AS z FROM region_filled",
)


def region_columns(spark, sf):
    return red.impute_columns(cut(red.station_columns(src.stations(spark, sf, "region")), "region"))


@query("p01_standardise", 'SELECT date, col AS "column", round(z, 6) + 0.0 AS value FROM region_z', "region_z")
def p01(spark, sf):
    filled = region_columns(spark, sf)
    z = red.standardise(filled, red.column_stats(filled, ["column"]), ["column"])
    return rounded(z, 6, "value")


@query(
    "p02_stored_scaler",
    """
, s AS (SELECT col, avg(value) AS m, stddev_pop(value) AS sd FROM region_filled WHERE date < DATE '1999-01-01' GROUP BY 1)
SELECT f.date, f.col AS "column", round((value - m) / sd, 6) + 0.0 AS value FROM region_filled f JOIN s ON s.col = f.col WHERE f.date >= DATE '1999-01-01'
""",
    "region_filled",
)
def p02(spark, sf):
    filled = region_columns(spark, sf)
    cutoff = F.col("date") < F.lit("1999-01-01").cast("date")
    path = work_path(spark, "scaler")
    red.column_stats(filled.where(cutoff), ["column"]).write.parquet(path)
    return rounded(red.standardise(filled.where(~cutoff), spark.read.parquet(path), ["column"]), 6, "value")


@query("p03_components")
def p03(spark, sf):
    features, _ = temperature_features(cut(src.stations(spark, sf), "stations"), src.daily(spark, sf))
    return features


@query(
    "p03_component_norms",
    "SELECT date, round(sum(z * z), 5) AS norm FROM region_z GROUP BY 1",
    "region_z",
)
def p03_norms(spark, sf):
    """All components keep the length of each standardised day."""
    filled = cut(region_columns(spark, sf), "region-columns")
    scores = red.component_scores(filled, red.fit_components(filled))
    return scores.groupBy("date").agg(F.round(F.sum(F.col("score") * F.col("score")), 5).alias("norm"))


def experiments(spark, sf):
    found = {}
    stations = cut(src.stations(spark, sf), "stations")
    for label, variables in (("all", ("TN", "TX")), ("tn", ("TN",)), ("tx", ("TX",))):
        filled = red.impute_columns(red.station_columns(stations, variables))
        found[label] = red.fit_components(filled)
    return found


@query("p04_experiments")
def p04(spark, sf):
    tables = [
        fit.explained.withColumn("experiment", F.lit(label)) for label, fit in experiments(spark, sf).items()
    ]
    explained = tables[0].unionByName(tables[1]).unionByName(tables[2])
    needed = red.components_needed(explained, [0.8, 0.9, 0.95], ["experiment"])
    return needed.orderBy("experiment", "threshold")


# Two columns have a closed form: the components are their sum and their difference.
VIEWS["pair_z"] = (
    "station_days",
    "SELECT date, (lo - avg(lo) OVER ()) / stddev_pop(lo) OVER () AS z1, (hi - avg(hi) OVER ()) / stddev_pop(hi) OVER () AS z2, lo, hi FROM"
    " (SELECT date, min(TN) AS lo, max(TX) AS hi FROM station_days GROUP BY 1) AS d",
)
VIEWS["pair_r"] = (
    "pair_z",
    "SELECT corr(z1, z2) AS r, sign(corr(z1, z2)) AS s, avg(lo) AS m1, stddev_pop(lo) AS s1, avg(hi) AS m2, stddev_pop(hi) AS s2 FROM pair_z",
)


def pair_columns(spark, sf):
    value = F.when(F.col("variable") == "TN", F.min("value")).otherwise(F.max("value"))
    per_day = src.stations(spark, sf).groupBy("date", "variable").agg(value.alias("value"))
    return cut(per_day.select("date", F.concat("variable", F.lit("_000000000")).alias("column"), "value"), "pair")


@query(
    "p03_two_columns",
    "SELECT date, round(abs(z1 + s * z2) / sqrt(2), 6) AS first, round(abs(z1 - s * z2) / sqrt(2), 6) AS second FROM pair_z, pair_r",
    "pair_z pair_r",
)
def p03_pair(spark, sf):
    """Scores up to sign: both loadings of a component are equally large."""
    filled = pair_columns(spark, sf)
    scores = red.component_features(red.component_scores(filled, red.fit_components(filled)), 2, "c")
    return scores.select("date", F.round(F.abs("c01"), 6).alias("first"), F.round(F.abs("c02"), 6).alias("second"))


# Three columns: the eigenvalues of a correlation matrix of three have a closed form
# (Smith, 1961), and a vector is the cross product of two rows of what its value leaves.
VIEWS["triple_z"] = (
    "station_days",
    "SELECT date, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z{i}" for i, c in enumerate(("lo", "up", "hi"), 1))
    + " FROM (SELECT date, min(TN) AS lo, max(TX) AS hi, min(TX) AS up FROM station_days GROUP BY 1) AS d",
)
VIEWS["triple_values"] = (
    "triple_z",
    """
SELECT *, 3 - l1 - l3 AS l2 FROM (SELECT *, 1 + 2 * p * cos(phi) AS l1, 1 + 2 * p * cos(phi + 2 * pi() / 3) AS l3 FROM
  (SELECT *, acos(greatest(-1, least(1, r12 * r13 * r23 / pow(p, 3)))) / 3 AS phi FROM
    (SELECT *, sqrt((r12 * r12 + r13 * r13 + r23 * r23) / 3) AS p FROM
      (SELECT corr(z1, z2) AS r12, corr(z1, z3) AS r13, corr(z2, z3) AS r23 FROM triple_z) AS a) AS b) AS c) AS d
""",
)
VIEWS["triple_loadings"] = (
    "triple_values",
    """
SELECT component, l / 3 AS ratio, x * s / size AS x, y * s / size AS y, z * s / size AS z FROM
  (SELECT *, sqrt(x * x + y * y + z * z) AS size, sign(CASE WHEN abs(x) >= greatest(abs(y), abs(z)) THEN x WHEN abs(y) >= abs(z) THEN y ELSE z END) AS s FROM
    (SELECT component, l, r12 * r23 - r13 * (1 - l) AS x, r13 * r12 - (1 - l) * r23 AS y, (1 - l) * (1 - l) - r12 * r12 AS z FROM
      (SELECT *, 1 AS component, l1 AS l FROM triple_values UNION ALL SELECT *, 2, l2 FROM triple_values UNION ALL SELECT *, 3, l3 FROM triple_values) AS a) AS b) AS c
""",
)
VIEWS["triple_scores"] = (
    "triple_z triple_loadings",
    "SELECT date, "
    + ", ".join(f"round(sum(z1 * x + z2 * y + z3 * z) FILTER (component = {j}), 6) + 0.0 AS temp_pc_0{j}" for j in (1, 2, 3))
    + " FROM triple_z, triple_loadings GROUP BY 1",
)


def triple_stations(spark, sf):
    """Two stations with three columns: the lowest and highest value of a day, and the lowest of its highest."""
    days = src.stations(spark, sf).groupBy("date").pivot("variable", ["TN", "TX"]).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    cells = [("000000000", "TN", "TN_lo"), ("000000000", "TX", "TX_lo"), ("000000001", "TX", "TX_hi")]
    listed = [F.struct(F.lit(s).alias("station"), F.lit(v).alias("variable"), F.col(c).alias("value")) for s, v, c in cells]
    return cut(days.select("date", F.inline(F.array(*listed))), "triple")


@query("p03_three_columns", "SELECT * FROM triple_scores", "triple_scores")
def p03_triple(spark, sf):
    features, _ = temperature_features(triple_stations(spark, sf), src.prod(spark, sf))
    return rounded(features, 6, *[f"temp_pc_0{j}" for j in (1, 2, 3)])


@query(
    "p04_three_columns",
    "SELECT CAST(component AS INTEGER) AS component, round(ratio, 9) AS ratio, round(sum(ratio) OVER (ORDER BY component), 9) AS cumulative FROM triple_loadings",
    "triple_loadings",
)
def p04_triple(spark, sf):
    filled = red.impute_columns(red.station_columns(triple_stations(spark, sf)))
    return rounded(red.fit_components(filled).explained, 9, "ratio", "cumulative")


@query(
    "p04_components_needed",
    "SELECT CAST(t AS DOUBLE) AS threshold, CASE WHEN (1 + abs(r)) / 2 >= t THEN 1 ELSE 2 END AS components_needed"
    " FROM pair_r, (SELECT unnest([0.5, 0.55, 0.8, 0.999]) AS t) AS x",
    "pair_r",
)
def p04_needed(spark, sf):
    explained = red.fit_components(pair_columns(spark, sf)).explained
    return red.components_needed(explained, [0.5, 0.55, 0.8, 0.999])


@query(
    "p05_chosen_pair",
    "SELECT CASE WHEN (1 + abs(r)) / 2 >= 0.9 THEN 1 ELSE 2 END AS k, round((1 + abs(r)) / 2, 9) AS ratio FROM pair_r",
    "pair_r",
)
def p05_pair(spark, sf):
    explained = red.fit_components(pair_columns(spark, sf)).explained
    k = red.choose_components(explained, 0.9)
    return explained.where("component = 1").select(F.lit(k).alias("k"), F.round("ratio", 9).alias("ratio"))


@query(
    "p06_stored_pair",
    """
SELECT c AS component, n || '_000000000' AS "column", round(1 / sqrt(2::DOUBLE), 9) AS loading, round(CASE WHEN n = 'TN' THEN m1 ELSE m2 END, 4) AS mean,
  round((1 + (3 - 2 * c) * abs(r)) / 2, 9) AS ratio FROM pair_r, (SELECT unnest([1, 2]) AS c) AS x, (SELECT unnest(['TN', 'TX']) AS n) AS y
""",
    "pair_r",
)
def p06_pair(spark, sf):
    path = work_path(spark, "components")
    red.save_components(red.fit_components(pair_columns(spark, sf)), path)
    fit = red.load_components(spark, path)
    stored = fit.loadings.join(fit.scaler, "column").join(fit.explained, "component")
    return stored.select(
        "component",
        "column",
        F.round(F.abs("loading"), 9).alias("loading"),
        F.round("mean", 4).alias("mean"),
        F.round("ratio", 9).alias("ratio"),
    )


@query(
    "p07_projected_pair",
    """
SELECT date, round(abs((temp_min_avg - m1) / s1 + s * (temp_max_avg - m2) / s2) / sqrt(2), 6) AS first,
  round(abs((temp_min_avg - m1) / s1 - s * (temp_max_avg - m2) / s2) / sqrt(2), 6) AS second FROM requests, pair_r
""",
    "requests pair_r",
)
def p07_pair(spark, sf):
    """Every component of the fit is projected, here two."""
    fit = red.fit_components(pair_columns(spark, sf))
    asked = red.project_requests(src.requests(spark, sf), red.national_projection(fit))
    c = F.transform("pca_components", lambda v: F.round(F.abs(v), 6))
    return asked.select("date", c[0].alias("first"), c[1].alias("second"))


@query(
    "p04_total_variance",
    """SELECT 'region' AS experiment, CAST(count(DISTINCT col) AS INTEGER) AS n_components,
  round(sum(z * z) / (count(DISTINCT date) * count(DISTINCT col)), 9) AS total FROM region_z""",
    "region_z",
)
def p04_total(spark, sf):
    explained = red.fit_components(region_columns(spark, sf)).explained
    return explained.agg(
        F.lit("region").alias("experiment"),
        F.max("component").alias("n_components"),
        F.round(F.max("cumulative"), 9).alias("total"),
    )


@query("p05_chosen_components")
def p05(spark, sf):
    filled = cut(region_columns(spark, sf), "region-columns")
    fit = red.fit_components(filled)
    k = red.choose_components(fit.explained, 0.9)
    return red.component_features(red.component_scores(filled, fit.first(k)), k)


@query("p06_stored_fit")
def p06(spark, sf):
    path = work_path(spark, "components")
    red.save_components(red.fit_components(region_columns(spark, sf), 3), path)
    fit = red.load_components(spark, path)
    return fit.loadings.join(fit.scaler, "column").join(fit.explained, "component")


@query("p07_national_projection")
def p07(spark, sf):
    fit = red.fit_components(region_columns(spark, sf), 3)
    return red.project_requests(src.requests(spark, sf), red.national_projection(fit))


@query(
    "x03_silver_join",
    f"""
, daily_grid AS ({DAILY_GRID}), mean_z AS (SELECT date, avg(z) AS temp_pc_01 FROM region_z GROUP BY 1)
SELECT date, consommation_mw, prevision_j1_mw, prevision_j_mw, production_mw, round(temp_pc_01, 6) + 0.0 AS temp_pc_01 FROM daily_grid JOIN mean_z USING (date)
""",
    "grid region_z",
)
def x03_join(spark, sf):
    """Silver with the mean standardised temperature in place of a component."""
    filled = region_columns(spark, sf)
    z = red.standardise(filled, red.column_stats(filled, ["column"]), ["column"])
    temperature = z.groupBy("date").agg(F.round(F.avg("value"), 6).alias("temp_pc_01"))
    return join_one_to_one(daily_grid(src.grid(spark, sf)), temperature, ["date"])


@query(
    "x03_silver_components",
    f"""
, daily_grid AS ({DAILY_GRID})
SELECT date, consommation_mw, prevision_j1_mw, prevision_j_mw, production_mw, temp_pc_01, temp_pc_02, temp_pc_03 FROM daily_grid JOIN triple_scores USING (date)
""",
    "grid triple_scores",
)
def x03_components(spark, sf):
    """The whole silver build with its three components, over stations that have three columns."""
    silver, _ = build_silver(src.grid(spark, sf), triple_stations(spark, sf))
    return rounded(silver, 6, *[f"temp_pc_0{j}" for j in (1, 2, 3)])


@query("x03_silver")
def x03(spark, sf):
    silver, _ = build_silver(src.grid(spark, sf), cut(src.stations(spark, sf), "stations"))
    return silver


GOLD = """
, daily_grid AS ({daily}),
silver AS (SELECT g.date, consommation_mw, production_mw, lo AS temp_pc_01 FROM daily_grid g
  JOIN (SELECT date, min(TN) AS lo FROM region_days GROUP BY 1) t ON t.date = g.date WHERE day(g.date) <> 17),
silver_dense AS (SELECT c.date, consommation_mw, production_mw, temp_pc_01 FROM
  (SELECT CAST(unnest(generate_series((SELECT min(date) FROM silver), (SELECT max(date) FROM silver), INTERVAL 1 DAY)) AS DATE) AS date) c
  LEFT JOIN silver s ON s.date = c.date),
silver_full AS ({fill})
SELECT * FROM (SELECT date, round(consommation_mw, 6) AS consommation_mw, round(temp_pc_01, 6) AS temp_pc_01,
  round(sin(2 * pi() * (isodow(date) - 1) / 7), 6) + 0.0 AS dow_sin, CASE WHEN isodow(date) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
  round(lag(production_mw) OVER (ORDER BY date), 6) AS production_mw_lag1 FROM silver_full) AS x
WHERE production_mw_lag1 IS NOT NULL AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
"""


@query(
    "x04_model_ready",
    GOLD.format(daily=DAILY_GRID, fill=time_fill("silver_dense", ["consommation_mw", "production_mw", "temp_pc_01"])),
    "grid region_days",
)
def x04(spark, sf):
    """Gold over a silver with every 17th of the month missing and one temperature column."""
    low = src.stations(spark, sf, "region").where(F.col("variable") == "TN")
    temperature = low.groupBy("date").agg(F.min("value").alias("temp_pc_01"))
    silver = daily_grid(src.grid(spark, sf)).join(temperature, "date").where(F.dayofmonth("date") != 17)
    gold = model_ready(cut(silver, "silver"), "1996-01-01", "2000-12-31")
    names = ["consommation_mw", "temp_pc_01", "dow_sin", "production_mw_lag1"]
    return rounded(gold.table, 6, *names).select("date", *names, "is_weekend")
