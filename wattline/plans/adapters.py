"""Energy-shaped views over the warehouse tables.

Money is summed in integer cents: the sum is then independent of the order in
which partitions arrive, so every run gives the same doubles bit for bit. Fact
tables are aggregated before they are joined, so a customer or supplier holding
a third of the rows is already collapsed when the join shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.checkpoints import expanding, half_year_end
from wattline.operators.gaps import densify, interpolate_time, lagged
from wattline.sources.registry import APPENDED

FIRST_CHECKPOINT = "1996-12-31"
EPSILON = 2.220446049250313e-16
TWO_PI = 6.283185307179586

# The ten production columns of a grid file, in file order.
PRODUCTION = [
    "Fioul", "Charbon", "Gaz", "Nucléaire", "Eolien", "Solaire",
    "Hydraulique", "Pompage", "Bioénergies", "Ech. physiques",
]
DAILY_MEANS = ["Consommation", "Prévision J-1", "Prévision J"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.rint(F.col(c) * 100).cast("long")


def whole(c: Column) -> Column:
    return F.floor(c).cast("double")


def mean_of_cents(total: str, count: str) -> Column:
    return F.col(total).cast("double") / F.lit(100.0) / F.col(count)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order value per day: the target series."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.sum(cents("o_totalprice")).alias("s"), F.count("o_totalprice").alias("n"))
        .select("date", mean_of_cents("s", "n").alias("y"))
    )


def production_per_day(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        (F.sum(cents("l_extendedprice")).cast("double") / 100.0).alias("production")
    )


def prod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped value per day: the production series."""
    return production_per_day(table(spark, sf_dir, "lineitem"))


def stations(spark: SparkSession, sf_dir: str, area: str = "nation") -> DataFrame:
    """Daily low (TN) and high (TX) per station in long form, with natural gaps."""
    per_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))
    )
    places = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("place"))
    if area == "region":
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        places = places.join(nation, F.col("place") == F.col("n_nationkey")).select(
            "s_suppkey", F.col("n_regionkey").alias("place")
        )
    return (
        per_supplier.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("date", F.lpad(F.col("place").cast("string"), 9, "0").alias("station"))
        .agg(F.min("lo").alias("TN"), F.max("hi").alias("TX"))
        .unpivot(["date", "station"], ["TN", "TX"], "variable", "value")
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-daily grid readings: one lineitem is one interval.

    Power is a whole number of units, so daily sums are exact in any order.
    """
    power, qty = F.rint(F.col("l_extendedprice") * 100), F.col("l_quantity")
    silent = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    fuels = [
        F.when(~silent & (F.col("l_suppkey") % 10 != i), qty * F.lit(i + 1.0)).alias(c)
        for i, c in enumerate(PRODUCTION)
    ]
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("Nature"),
        power.alias("Consommation"),
        whole(power * (100 - F.rint(F.col("l_discount") * 100)) / 100).alias("Prévision J-1"),
        whole(power * (100 + F.rint(F.col("l_tax") * 100)) / 100).alias("Prévision J"),
        *fuels,
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("fuel"),
        "value",
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as an untyped text table: one file per day, rows in file order."""
    i = F.col("event_id")
    amount = F.regexp_replace(F.col("value").cast("decimal(18,2)").cast("string"), "\\.", ",")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("grid_"), F.date_format("ts", "yyyyMMdd"), F.lit("_2024.xls")).alias("source_file"),
        i.alias("row_pos"),
        F.when(i % 13 != 0, F.date_format("ts", "dd/MM/yyyy")).alias("Date"),
        F.when(i % 13 != 0, F.concat(F.lit(" "), F.date_format("ts", "HH:mm"))).alias("Heures"),
        F.when(i % 13 != 0, F.col("event_type")).alias("fuel"),
        F.when(i % 13 == 0, F.lit(None))
        .when(i % 17 == 0, F.lit("ND"))
        .otherwise(F.concat(F.lit(" "), amount))
        .alias("power"),
        F.when(i % 13 == 0, F.lit(None)).when(i % 4 == 0, F.lit("n.c.")).otherwise(amount).alias("mixed"),
        F.when((i % 2 == 1) & (i % 13 != 0), amount).alias("sparse"),
        F.lit(None).cast("string").alias("empty"),
    )


def keyed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily series per customer nation."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.sum(cents("o_totalprice")).alias("s"), F.count("o_totalprice").alias("n"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("series"), "date")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        .select("series", "date", mean_of_cents("s", "n").alias("y"))
    )


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target series on a full calendar."""
    return interpolate_time(densify(daily(spark, sf_dir)), ["y"])


def forecast_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of three simple rules at horizons 1 and 7, with their errors."""
    y = {k: lagged("y", k) for k in (1, 7, 8, 14, 21, 28, 35)}
    wide = filled(spark, sf_dir).select("date", F.col("y").alias("actual"), *[y[k].alias(f"y{k}") for k in y])
    rules = {
        ("weekly", 1): F.col("y7"),
        ("weekly", 7): F.col("y14"),
        ("mean4", 1): (F.col("y7") + F.col("y14") + F.col("y21") + F.col("y28")) / 4,
        ("mean4", 7): (F.col("y14") + F.col("y21") + F.col("y28") + F.col("y35")) / 4,
        ("level", 1): F.col("y1"),
        ("level", 7): F.col("y8"),
    }
    cases = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.lit(h).alias("horizon"), p.alias("predicted"))
            for (m, h), p in rules.items()
        ]
    )
    long = wide.select("date", "actual", F.inline(cases)).where(F.col("predicted").isNotNull())
    error = F.col("predicted") - F.col("actual")
    return long.select(
        "model",
        "horizon",
        "date",
        "actual",
        "predicted",
        error.alias("error"),
        F.abs(error).alias("abs_error"),
        (error * error).alias("sq_error"),
    )


def fc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast log of the weekly rule: one row per (horizon, date)."""
    return forecast_log(spark, sf_dir).where(F.col("model") == "weekly").drop("model")


def fc1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-step log: one row per date."""
    return fc(spark, sf_dir).where(F.col("horizon") == 1).drop("horizon")


def runs(spark: SparkSession, sf_dir: str, first: str = FIRST_CHECKPOINT) -> DataFrame:
    """One run per half-year checkpoint with the metrics of its expanding window."""
    ape = F.col("abs_error") / F.greatest(F.abs("actual"), F.lit(EPSILON))
    sums = {"ae": F.col("abs_error"), "se": F.col("sq_error"), "pe": ape}
    grown = expanding(fc1(spark, sf_dir), "date", first, sums)
    n = F.col("n_rows")
    llf = -n / 2 * (F.log(F.lit(TWO_PI)) + F.log(F.col("se") / n) + 1)
    return grown.select(
        F.concat(F.date_format("checkpoint", "yyyyMMdd"), F.lit("T000000Z")).alias("run_id"),
        F.col("checkpoint").alias("trained_at"),
        F.col("first_date").alias("training_start"),
        F.col("last_date").alias("training_end"),
        n.alias("n_training_days"),
        F.round(F.col("ae") / n, 2).alias("mae"),
        F.round(F.sqrt(F.col("se") / n), 2).alias("rmse"),
        F.round(F.col("pe") / n * 100, 4).alias("mape"),
        F.round(llf, 2).alias("llf"),
        F.round(-2 * llf + 2 * 2, 2).alias("aic"),
        F.round(-2 * llf + 2 * F.log(n), 2).alias("bic"),
    )


def late_backfill(runs: DataFrame) -> DataFrame:
    """Runs as a registry holds them after old June windows were backfilled behind all others."""
    ended = F.to_date(F.substring("run_id", 1, 8), "yyyyMMdd")
    late = (F.month(ended) == 6) & (F.year(ended) < 2000)
    return runs.withColumn(APPENDED, F.when(late, "2030-01-02").otherwise("2030-01-01").cast("timestamp"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: one per day, naming a run, no run, or one that does not exist."""
    day = F.dayofmonth("date")
    asked = F.concat(F.date_format(half_year_end(F.col("date")), "yyyyMMdd"), F.lit("T000000Z"))
    pairs = stations(spark, sf_dir, "region").groupBy("date").pivot("variable", ["TN", "TX"]).agg(F.min("value"))
    before = prod(spark, sf_dir).withColumn("production_mw_lag1", lagged("production", 1)).drop("production")
    return pairs.join(before, "date").select(
        "date",
        F.col("TN").alias("temp_min_avg"),
        F.col("TX").alias("temp_max_avg"),
        "production_mw_lag1",
        F.when(day % 3 == 0, F.lit(None)).when(day % 7 == 0, "no_such_run").otherwise(asked).alias("run_id"),
    )
