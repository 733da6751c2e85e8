"""Gold to trained runs, and batch scoring with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.functions.columns import DEFAULT_FEATURES, EPSILON, check_schema, cyclicals, model_name
from wattline.operators import arx
from wattline.operators.backtest import backfill_runs, run_metrics
from wattline.operators.checkpoints import half_year_ends
from wattline.operators.frames import attach, by_date
from wattline.operators.joins import resolve_runs
from wattline.operators.metrics import residual_statistics
from wattline.operators.reduction import project_requests
from wattline.operators.regression import cross_products, fit_quality
from wattline.operators.rolling import after_warmup
from wattline.plans.gold import TARGET, ModelReady
from wattline.session import cut
from wattline.sources import commits
from wattline.sources.registry import APPENDED

#: Columns of a backfilled run.
BACKFILLED = (
    "run_id string, checkpoint date, training_start date, training_end date, n_training_days long, mae double, "
    f"rmse double, mape double, llf double, aic double, bic double, {APPENDED} timestamp"
)


@dataclass
class Trained:
    """A fitted run: parameters, the in-sample frame, and its run row."""

    fits: DataFrame
    rows: DataFrame
    insample: DataFrame
    run: DataFrame


def default_spec(features: list[str] | None = None) -> arx.Spec:
    return arx.Spec(features=tuple(features or DEFAULT_FEATURES))


def design_table(gold: ModelReady, spec: arx.Spec, keys: tuple[str, ...] = ()) -> DataFrame:
    """The lag design cut to a table: fits, fitted values and forecasts all read it."""
    check_schema(gold.table, dict.fromkeys(spec.wide_features, "double"), "model-ready table")
    return cut(arx.design(gold.table, TARGET, spec, keys), "design")


def train(gold: ModelReady, spec: arx.Spec, run_id: str) -> Trained:
    """Fit one run, score it in-sample and describe it as a registry row."""
    rows = design_table(gold, spec)
    fits = cut(fit_quality(arx.fit(cross_products(rows, [], spec.names), {"final": spec})), "fit")
    insample = arx.fitted(rows, fits, spec)
    return Trained(fits, rows, insample, run_row(insample, fits, spec, run_id))


def run_row(insample: DataFrame, fits: DataFrame, spec: arx.Spec, run_id: str) -> DataFrame:
    """One registry row: id, stamp, orders, features, window, metrics and fit quality."""
    e, a = F.col("error"), F.col("actual")
    metrics = insample.agg(
        F.min("date").alias("training_start"),
        F.max("date").alias("training_end"),
        F.count(F.lit(1)).alias("n_training_days"),
        F.round(F.avg(F.abs(e)), 2).alias("mae"),
        F.round(F.sqrt(F.avg(e * e)), 2).alias("rmse"),
        F.round(F.avg(F.abs(e) / F.greatest(F.abs(a), F.lit(EPSILON))) * 100, 4).alias("mape"),
    )
    quality = fits.select("llf", "aic", "bic", "terms", "coef")
    order = F.array(*[F.lit(v) for v in spec.order])
    seasonal = F.array(*[F.lit(v) for v in spec.seasonal])
    return attach(metrics, quality).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_id).alias("run_dir"),
        F.try_to_timestamp(F.lit(run_id), F.lit("yyyyMMdd'T'HHmmss'Z'")).alias("trained_at"),
        order.alias("order"),
        seasonal.alias("seasonal_order"),
        model_name(order, seasonal).alias("model_name"),
        F.array(*[F.lit(f) for f in spec.features]).alias("features"),
        "training_start",
        "training_end",
        "n_training_days",
        "mae",
        "rmse",
        "mape",
        "llf",
        "aic",
        "bic",
        "terms",
        "coef",
    )


def register(run: DataFrame, path: str) -> DataFrame:
    """Append a run as one commit and read the version that has it; concurrent appends keep every run."""
    stamped = run.withColumn(APPENDED, F.current_timestamp())
    version = commits.append(stamped, path)
    return commits.read(run.sparkSession, path, stamped.schema, version)


def residual_report(insample: DataFrame, warmup: int = 60) -> DataFrame:
    return residual_statistics(after_warmup(insample, warmup), "residual")


def historical_runs(
    gold: ModelReady, spec: arx.Spec, first: str, existing: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every half-year run with its metrics, its parameters and the design table behind it."""
    rows = design_table(with_next_day(gold, spec), spec)
    fits = cut(backfill_runs(rows, spec, first, existing=existing), "runs")
    found = run_metrics(rows, fits, spec).join(
        fits.select("run_id", "checkpoint", "llf", "aic", "bic", "k", "rank"), "run_id"
    )
    return found, fits, rows


def backfill(gold: ModelReady, spec: arx.Spec, first: str, path: str, dry_run: bool = False) -> DataFrame:
    """Train every half-year run that the runs table lacks and append it; returns the table.

    Runs that are there are not trained again, so a broken backfill resumes where it
    stopped. ``dry_run`` only returns the plan: run_id and checkpoint of what is missing.
    """
    spark = gold.table.sparkSession
    schema = StructType.fromDDL(BACKFILLED)
    existing = commits.read(spark, path, schema)
    last = gold.table.agg(F.max("date").alias("last"))
    run_id = F.concat(F.date_format("checkpoint", "yyyyMMdd"), F.lit("T000000Z")).alias("run_id")
    plan = half_year_ends(last, "last", first).select(run_id, "checkpoint")
    plan = plan.join(existing.select("run_id"), "run_id", "left_anti")
    if dry_run:
        return plan
    if not plan.isEmpty():
        found, _, _ = historical_runs(gold, spec, first, cut(existing.select("run_id"), "existing"))
        stamped = found.withColumn(APPENDED, F.current_timestamp())
        wanted = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
        commits.append(stamped.select(*wanted), path)
    return commits.read(spark, path, schema)


def with_next_day(gold: ModelReady, spec: arx.Spec) -> ModelReady:
    """The table with one more day, unknown target and zero features: the day a run forecasts."""
    table = gold.table
    zero = {f: F.lit(0.0) for f in gold.features}
    after = table.agg(F.date_add(F.max("date"), 1).alias("date")).where(F.col("date").isNotNull())
    after = after.withColumns(zero).withColumn(TARGET, F.lit(None).cast("double"))
    return ModelReady(table.unionByName(after), gold.features, gold.scaled)


def scoring_state(rows: DataFrame, fits: DataFrame, spec: arx.Spec) -> DataFrame:
    """What each run carries into scoring: its level for the day after training, and one weight per feature.

    The prediction is linear in that day's features, so the level is the prediction
    with the features' own part taken out; history never has to be read again.
    """
    n = len(spec.features)
    day = fits.select("run_id", F.date_add("checkpoint", 1).alias("date"), "coef", "predictor", "checkpoint")
    level = F.lit(0.0)
    for i, weight in enumerate(spec.weights):
        if i and weight:
            level = level - F.lag("y", i).over(by_date()) * F.lit(float(weight))
    base = rows.withColumn("__level", level).join(day, "date")
    own = F.aggregate(
        F.zip_with(F.array(*[F.col(f) for f in spec.features]), F.slice("coef", 1, n), lambda x, b: x * b),
        F.lit(0.0),
        lambda a, t: a + t,
    )
    state = F.col("__level") + arx.dot(spec.names, "predictor") - own
    return base.select(
        "run_id",
        F.col("checkpoint").alias("trained_at"),
        state.alias("state"),
        F.slice("coef", 1, n).alias("weights"),
        F.array(*[F.lit(f) for f in spec.features]).alias("features"),
    )


def with_scaler(state: DataFrame, table: DataFrame, spec: arx.Spec) -> DataFrame:
    """Put a run's feature weights on the standardised scale, with the scaler it was trained with.

    Each day is summed in the stretch between two runs' ends, and a run's window is the
    running total of the stretches; no day is copied per run. Sums are taken about the
    table's means, so they lose no digits. A feature without spread gets divisor 1.
    """
    names = list(spec.features)
    level = cut(table.agg(*[F.avg(f).alias(f) for f in names]), "levels")
    ends = state.select(F.col("trained_at").alias("__end")).distinct()
    stops = ends.agg(F.sort_array(F.collect_list("__end")).alias("__stops"))
    centred = attach(table.select("date", *names), level.select(*[F.col(f).alias(f"__m_{f}") for f in names]))
    stretch = F.get(F.filter("__stops", lambda e: e >= F.col("date")), 0)
    moved = attach(centred, stops).where(F.col("date") <= F.array_max("__stops")).select(
        stretch.alias("__end"), *[(F.col(f) - F.col(f"__m_{f}")).alias(f) for f in names]
    )
    sums = {f"__s{i}": F.col(f) for i, f in enumerate(names)} | {f"__q{i}": F.col(f) * F.col(f) for i, f in enumerate(names)}
    parts = moved.groupBy("__end").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(n) for n, c in sums.items()])
    so_far = by_date((), "__end").rowsBetween(Window.unboundedPreceding, 0)
    grown = ends.join(parts, "__end", "left").select("__end", *[F.sum(c).over(so_far).alias(c) for c in ("__n", *sums)])
    mean = [F.col(f"__s{i}") / F.col("__n") for i in range(len(names))]
    spread = [F.sqrt(F.greatest(F.col(f"__q{i}") / F.col("__n") - m * m, F.lit(0.0))) for i, m in enumerate(mean)]
    scaler = attach(grown, level).select(
        F.col("__end").alias("trained_at"),
        F.array(*[m + F.col(f) for m, f in zip(mean, names)]).alias("means"),
        F.array(*[F.when(s > 0, s).otherwise(1.0) for s in spread]).alias("stds"),
    )
    shift = F.aggregate(F.zip_with("weights", "means", lambda w, m: w * m), F.lit(0.0), lambda a, t: a + t)
    scaled = F.zip_with("weights", "stds", lambda w, s: w * s)
    return state.join(scaler, "trained_at").withColumns({"state": F.col("state") + shift, "weights": scaled})


def score_requests(requests: DataFrame, runs: DataFrame, projection: DataFrame | None) -> DataFrame:
    """Batch scoring: resolve the run, project temperatures, scale, and add up.

    Components are matched to features by their number, as many as the projection has;
    without a projection they count as 0. An unknown run, or a
    feature nobody supplied, gives a row with an ``error`` and no prediction. Like
    the stored state, the forecast is for the day after the run's training window.
    """
    asked = project_requests(resolve_runs(requests, runs), projection)
    none = F.size("pca_components") == 0
    pairs: list[Column] = [
        F.struct(F.lit("production_mw_lag1").alias("key"), F.col("production_mw_lag1").alias("value"))
    ]
    if "date" in requests.columns:
        pairs += [F.struct(F.lit(n).alias("key"), c.alias("value")) for n, c in cyclicals(F.col("date")).items()]
    components = F.transform(
        "pca_components",
        lambda v, i: F.struct(F.format_string("temp_pc_%02d", i + 1).alias("key"), v.alias("value")),
    )
    supplied = asked.withColumn("__have", F.map_from_entries(F.concat(F.array(*pairs), components)))
    x = F.transform(
        "features",
        lambda f: F.when(none & f.rlike("^temp_pc_[0-9]+$"), 0.0).otherwise(F.try_element_at(F.col("__have"), f)),
    )
    rows = supplied.withColumn("__x", x)
    z = F.zip_with(F.zip_with("__x", "means", lambda v, m: v - m), "stds", lambda v, s: v / s)
    total = F.aggregate(F.zip_with(z, "weights", lambda v, w: v * w), F.col("state"), lambda a, t: a + t)
    missing = F.filter(F.zip_with("features", "__x", lambda f, v: F.when(v.isNull(), f)), lambda f: f.isNotNull())
    error = F.when(~F.col("found"), F.concat(F.lit("run not found: "), F.col("run_id"))).when(
        F.size(missing) > 0, F.concat(F.lit("features not supplied: "), F.concat_ws(", ", missing))
    )
    return rows.select(
        *[c for c in requests.columns if c != "run_id"],
        "run_id",
        F.when(error.isNull(), total).alias("prediction"),
        F.transform("pca_components", lambda v: F.round(v, 6)).alias("pca_components"),
        error.alias("error"),
    )
