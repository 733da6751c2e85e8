"""Registration of queries with their oracle SQL, and the shared SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query; ``views`` names the CTEs its oracle SQL builds on."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(views.split(), sql)
        return fn

    return register


def with_views(names: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first.

    A body that opens with a comma goes on to list CTEs of its own.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = VIEWS[name]
        for need in needs.split():
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in ordered)
    glue = "" if body.strip().startswith(",") else "\n"
    return f"WITH {ctes}{glue}{body.strip()}"


def time_fill(source: str, columns: list[str], keys: str = "", rest: str = "") -> str:
    """SQL for time-linear interpolation of ``columns`` over a dense calendar."""
    part = f"PARTITION BY {keys} " if keys else ""
    lead = f"{keys}, " if keys else ""
    marks, out = [], []
    for c in columns:
        back = f"OVER ({part}ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        fwd = f"OVER ({part}ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        day = f"CASE WHEN {c} IS NOT NULL THEN date END"
        marks += [
            f"last_value({c} IGNORE NULLS) {back} AS pv_{c}",
            f"last_value({day} IGNORE NULLS) {back} AS pd_{c}",
            f"first_value({c} IGNORE NULLS) {fwd} AS nv_{c}",
            f"first_value({day} IGNORE NULLS) {fwd} AS nd_{c}",
        ]
        out.append(
            f"coalesce({c}, CASE WHEN pd_{c} < nd_{c} THEN pv_{c} + (nv_{c} - pv_{c}) * "
            f"((date - pd_{c}) / (nd_{c} - pd_{c})) END, pv_{c}) AS {c}"
        )
    return (
        f"SELECT {lead}date, {', '.join(out)}{rest} FROM "
        f"(SELECT *, {', '.join(marks)} FROM {source}) AS marked"
    )


def cents(c: str) -> str:
    return f"sum(CAST(round({c} * 100) AS BIGINT))"


FUELS = [
    "Fioul", "Charbon", "Gaz", "Nucléaire", "Eolien", "Solaire",
    "Hydraulique", "Pompage", "Bioénergies", "Ech. physiques",
]
SILENT = "(l_returnflag = 'R' AND l_linestatus = 'O')"

# Contexts below 28 rows fall back to the threshold of the whole key.
PEAKS = """
SELECT *, actual >= peak_threshold AS is_peak FROM (
  SELECT *, CASE WHEN context_count >= 28 THEN threshold_context ELSE threshold_global END AS peak_threshold FROM (
    SELECT *, CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) - 1 AS INTEGER) AS dow,
      count(actual) OVER (PARTITION BY {k}, month(date), isodow(date)) AS context_count,
      quantile_cont(actual, 0.9) OVER (PARTITION BY {k}, month(date), isodow(date)) AS threshold_context,
      quantile_cont(actual, 0.9) OVER (PARTITION BY {k}) AS threshold_global
    FROM {t}) AS a) AS b
"""

# name -> (views it needs, body)
VIEWS: dict[str, tuple[str, str]] = {
    "daily": (
        "",
        f"SELECT CAST(o_orderdate AS DATE) AS date, CAST({cents('o_totalprice')} AS DOUBLE) / 100.0"
        " / count(o_totalprice) AS y FROM orders GROUP BY 1",
    ),
    "prod": (
        "",
        f"SELECT CAST(l_shipdate AS DATE) AS date, CAST({cents('l_extendedprice')} AS DOUBLE) / 100.0"
        " AS production FROM lineitem GROUP BY 1",
    ),
    "station_days": (
        "",
        "SELECT CAST(l_shipdate AS DATE) AS date, lpad(CAST(s_nationkey AS VARCHAR), 9, '0') AS station,"
        " min(l_extendedprice) AS TN, max(l_extendedprice) AS TX"
        " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2",
    ),
    "stations": (
        "station_days",
        "SELECT date, station, 'TN' AS variable, TN AS value FROM station_days"
        " UNION ALL SELECT date, station, 'TX', TX FROM station_days",
    ),
    "region_days": (
        "",
        "SELECT CAST(l_shipdate AS DATE) AS date, lpad(CAST(n_regionkey AS VARCHAR), 9, '0') AS station,"
        " min(l_extendedprice) AS TN, max(l_extendedprice) AS TX"
        " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
        " JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2",
    ),
    "grid": (
        "",
        'SELECT CAST(l_shipdate AS DATE) AS "Nature", round(l_extendedprice * 100) AS "Consommation",'
        ' floor(round(l_extendedprice * 100) * (100 - round(l_discount * 100)) / 100) AS "Prévision J-1",'
        ' floor(round(l_extendedprice * 100) * (100 + round(l_tax * 100)) / 100) AS "Prévision J", '
        + ", ".join(
            f'CASE WHEN NOT {SILENT} AND l_suppkey % 10 <> {i} THEN l_quantity * {i + 1}.0::DOUBLE END AS "{c}"'
            for i, c in enumerate(FUELS)
        )
        + " FROM lineitem",
    ),
    "readings": (
        "",
        "SELECT event_id, ts, CAST(ts AS DATE) AS date, event_type AS fuel, value FROM events",
    ),
    "raw_amount": (
        "",
        "SELECT event_id AS i, ts, event_type,"
        " replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS amount FROM events",
    ),
    "raw_text": (
        "raw_amount",
        "SELECT 'grid_' || strftime(ts, '%Y%m%d') || '_2024.xls' AS source_file, i AS row_pos,"
        " CASE WHEN i % 13 <> 0 THEN strftime(ts, '%d/%m/%Y') END AS \"Date\","
        " CASE WHEN i % 13 <> 0 THEN ' ' || strftime(ts, '%H:%M') END AS \"Heures\","
        " CASE WHEN i % 13 <> 0 THEN event_type END AS fuel,"
        " CASE WHEN i % 13 = 0 THEN NULL WHEN i % 17 = 0 THEN 'ND' ELSE ' ' || amount END AS power,"
        " CASE WHEN i % 13 = 0 THEN NULL WHEN i % 4 = 0 THEN 'n.c.' ELSE amount END AS mixed,"
        " CASE WHEN i % 2 = 1 AND i % 13 <> 0 THEN amount END AS sparse,"
        " CAST(NULL AS VARCHAR) AS empty FROM raw_amount",
    ),
    "keyed_daily": (
        "",
        f"SELECT c_nationkey AS series, CAST(o_orderdate AS DATE) AS date,"
        f" CAST({cents('o_totalprice')} AS DOUBLE) / 100.0 / count(o_totalprice) AS y"
        " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
    ),
    "cal": (
        "daily",
        "SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily",
    ),
    "dense": ("daily cal", "SELECT cal.date, y FROM cal LEFT JOIN daily ON cal.date = daily.date"),
    "filled": ("dense", time_fill("dense", ["y"])),
    "keyed_bounds": (
        "keyed_daily",
        "SELECT series, min(date) AS lo, max(date) AS hi FROM keyed_daily GROUP BY 1",
    ),
    "keyed_days": (
        "keyed_bounds",
        "SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM keyed_bounds",
    ),
    "keyed_dense": (
        "keyed_days keyed_daily",
        "SELECT d.series, d.date, y FROM keyed_days d LEFT JOIN keyed_daily k"
        " ON k.series = d.series AND k.date = d.date",
    ),
    "keyed_filled": ("keyed_dense", time_fill("keyed_dense", ["y"], "series")),
    "flags": (
        "filled",
        "SELECT date, y AS actual, "
        + ", ".join(f"lag(y, {k}) OVER (ORDER BY date) AS y{k}" for k in (1, 7, 8, 14, 21, 28, 35))
        + " FROM filled",
    ),
    "flong": (
        "flags",
        " UNION ALL ".join(
            f"SELECT '{m}' AS model, {h} AS horizon, date, actual, {p} AS predicted FROM flags"
            for m, h, p in (
                ("weekly", 1, "y7"),
                ("weekly", 7, "y14"),
                ("mean4", 1, "(y7 + y14 + y21 + y28) / 4"),
                ("mean4", 7, "(y14 + y21 + y28 + y35) / 4"),
                ("level", 1, "y1"),
                ("level", 7, "y8"),
            )
        ),
    ),
    "flog": (
        "flong",
        "SELECT *, predicted - actual AS error, abs(predicted - actual) AS abs_error,"
        " (predicted - actual) * (predicted - actual) AS sq_error FROM flong WHERE predicted IS NOT NULL",
    ),
    "fc": ("flog", "SELECT * EXCLUDE (model) FROM flog WHERE model = 'weekly'"),
    "fc1": ("fc", "SELECT * EXCLUDE (horizon) FROM fc WHERE horizon = 1"),
    "half_years": (
        "",
        "SELECT CAST(last_day(CAST(x AS DATE)) AS DATE) AS checkpoint FROM (SELECT unnest(generate_series("
        "DATE '1996-12-01', DATE '2030-12-01', INTERVAL 6 MONTH)) AS x) AS months",
    ),
    "cps": (
        "half_years fc1",
        "SELECT checkpoint FROM half_years WHERE checkpoint <= (SELECT max(date) FROM fc1)",
    ),
    "run_sums": (
        "cps fc1",
        "SELECT checkpoint, count(*) AS n, min(date) AS lo, max(date) AS hi, sum(abs_error) AS ae,"
        " sum(sq_error) AS se, sum(abs_error / greatest(abs(actual), 2.220446049250313e-16)) AS pe"
        " FROM cps JOIN fc1 ON fc1.date <= cps.checkpoint GROUP BY 1",
    ),
    "run_llf": (
        "run_sums",
        "SELECT *, -n / 2 * (ln(6.283185307179586) + ln(se / n) + 1) AS ll FROM run_sums",
    ),
    "runs": (
        "run_llf",
        "SELECT strftime(checkpoint, '%Y%m%d') || 'T000000Z' AS run_id, checkpoint AS trained_at,"
        " lo AS training_start, hi AS training_end, n AS n_training_days, round(ae / n, 2) AS mae,"
        " round(sqrt(se / n), 2) AS rmse, round(pe / n * 100, 4) AS mape, round(ll, 2) AS llf,"
        " round(-2 * ll + 4, 2) AS aic, round(-2 * ll + 2 * ln(n), 2) AS bic FROM run_llf",
    ),
    # Old June windows were backfilled behind all other runs, so the registry points at one of them.
    "late_runs": (
        "runs",
        "SELECT *, month(trained_at) = 6 AND year(trained_at) < 2000 AS late FROM runs",
    ),
    "latest_run": (
        "late_runs",
        "SELECT run_id FROM late_runs ORDER BY late DESC, run_id DESC LIMIT 1",
    ),
    "fc_peaks": (
        "fc",
        PEAKS.format(k="horizon", t="fc"),
    ),
    "model_peaks": (
        "flog",
        PEAKS.format(k="model, horizon", t="flog"),
    ),
    "fc_rolled": (
        "fc",
        "SELECT horizon, date, CASE WHEN c >= 15 THEN ae END AS rolling_mae, CASE WHEN c >= 15 THEN sqrt(se) END AS rolling_rmse"
        " FROM (SELECT horizon, date, count(abs_error) OVER w AS c, avg(abs_error) OVER w AS ae, avg(sq_error) OVER w AS se,"
        " row_number() OVER (PARTITION BY horizon ORDER BY date) AS rn FROM fc"
        " WINDOW w AS (PARTITION BY horizon ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) AS r WHERE rn > 30",
    ),
    "requests": (
        "region_days prod",
        "SELECT date, temp_min_avg, temp_max_avg, production_mw_lag1, CASE WHEN day(date) % 3 = 0 THEN NULL"
        " WHEN day(date) % 7 = 0 THEN 'no_such_run'"
        " ELSE strftime(last_day(make_date(year(date), CASE WHEN month(date) <= 6 THEN 6 ELSE 12 END, 1)), '%Y%m%d') || 'T000000Z' END AS run_id"
        " FROM (SELECT date, min(TN) AS temp_min_avg, min(TX) AS temp_max_avg FROM region_days GROUP BY 1) AS t"
        " JOIN (SELECT date, lag(production) OVER (ORDER BY date) AS production_mw_lag1 FROM prod) AS p USING (date)",
    ),
}
