"""The run registry: a parquet table of runs, nested JSON documents in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.functions.columns import model_name, order_text
from wattline.sources.commits import SEQUENCE

#: A run's place in the registry: when it was appended, then its id.
APPENDED = "appended_at"


def append_order(runs: DataFrame) -> Column:
    """Sort value that puts the run the registry points at last: the one appended last.

    Everything that speaks of the latest run goes by this, whatever window a run was
    trained on: by the number of its commit, else by its stamp. A table without either
    goes by training date.
    """
    known = [c for c in (SEQUENCE, APPENDED, "trained_at") if c in runs.columns]
    return F.struct(known[0], "run_id")


def capped(runs: DataFrame, cap: int) -> DataFrame:
    """The ``cap`` runs appended last, with the latest id and the count kept.

    A backfilled run of an old window counts as new, whatever its training date.
    Each task keeps ``cap`` rows at most before they meet, so the window that
    follows sees no more than the cap.
    """
    kept = runs.orderBy(append_order(runs).desc()).limit(cap)
    everything = Window.partitionBy()
    return kept.withColumns(
        {
            "latest_run_id": F.max_by("run_id", append_order(runs)).over(everything),
            "n_runs": F.count(F.lit(1)).over(everything),
        }
    )


# The registry document and the per-run document, as the writers lay them out.
MODEL = (
    "struct<model_file: string, scaler_file: string, metadata_file: string, report_file: string, "
    "insample_metrics: struct<insample_MAE_MW: double, insample_RMSE_MW: double, insample_MAPE_pct: double>, "
    "goodness_of_fit: struct<aic: double, bic: double, log_likelihood: double>>"
)
RUN = (
    "struct<run_id: string, run_dir: string, trained_at: string, training_start: string, training_end: string, "
    "n_training_days: int, features: array<string>, order: array<int>, seasonal_order: array<int>, "
    f"model: {MODEL}, models: map<string, {MODEL}>>"
)
REGISTRY = f"latest_run_id string, n_runs int, runs array<{RUN}>"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per run of a registry document, with its place in the list."""
    doc = spark.read.schema(REGISTRY).option("multiLine", True).json(path)
    return doc.select("latest_run_id", F.posexplode("runs").alias("seq", "run")).select(
        "latest_run_id", "seq", "run.*"
    )


def registry_document(runs: DataFrame, cap: int) -> DataFrame:
    """The registry as one JSON document, runs in append order; the cap bounds its size."""
    kept = capped(runs, cap).drop("latest_run_id", "n_runs")
    run = F.struct(*[c for c in kept.columns if c not in (APPENDED, SEQUENCE)])
    listed = kept.agg(
        F.max_by("run_id", append_order(kept)).alias("latest_run_id"),
        F.count(F.lit(1)).cast("int").alias("n_runs"),
        # Place and id are unique, so sorting the pairs never compares the runs.
        F.sort_array(F.collect_list(append_order(kept))).alias("__order"),
        F.map_from_entries(F.collect_list(F.struct(F.col("run_id").alias("k"), run.alias("v")))).alias("__runs"),
    )
    runs_in_order = F.transform("__order", lambda o: F.try_element_at(F.col("__runs"), o["run_id"]))
    return listed.select(
        F.to_json(F.struct("latest_run_id", "n_runs", runs_in_order.alias("runs"))).alias("value")
    )


def resolved_model(model: Column, models: Column) -> Column:
    """Model entry of either layout: ``model``, else ``models.h1``, else the first one."""
    return F.coalesce(
        model, F.try_element_at(models, F.lit("h1")), F.try_element_at(F.map_values(models), F.lit(1))
    )


def flatten_runs(runs: DataFrame) -> DataFrame:
    """One flat row per run, newest first."""
    entry = resolved_model(F.col("model"), F.col("models"))
    m, g = entry["insample_metrics"], entry["goodness_of_fit"]
    trained = F.coalesce(
        F.try_to_timestamp("trained_at", F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp("trained_at", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
    )
    return runs.select(
        "run_id",
        trained.alias("trained_at"),
        m["insample_MAE_MW"].alias("mae"),
        m["insample_RMSE_MW"].alias("rmse"),
        m["insample_MAPE_pct"].alias("mape"),
        g["aic"].alias("aic"),
        g["bic"].alias("bic"),
        "n_training_days",
        "training_start",
        "training_end",
        F.concat_ws(", ", "features").alias("features"),
        order_text(F.col("order")).alias("order"),
        order_text(F.col("seasonal_order")).alias("seasonal_order"),
    ).orderBy(F.desc("trained_at"))


def with_defaults(meta: DataFrame, registry: DataFrame) -> DataFrame:
    """Per-run metadata whose empty lists fall back to the registry's entry."""
    both = meta.alias("m").join(registry.alias("r"), "run_id", "right")

    def pick(c: str) -> Column:
        return F.when(F.size(F.coalesce(F.col(f"m.{c}"), F.array())) > 0, F.col(f"m.{c}")).otherwise(
            F.col(f"r.{c}")
        )

    filled = both.select("run_id", *[pick(c).alias(c) for c in ("features", "order", "seasonal_order")])
    scaled = F.filter("features", lambda f: f.startswith("temp_pc_") | (f == "production_mw_lag1"))
    return filled.withColumn("scale_columns", scaled)


def run_metadata(runs: DataFrame, run_id: str | None = None) -> DataFrame:
    """The row of one run, the latest one where no id is given; an unknown id gives no row."""
    if run_id is not None:
        return runs.where(F.col("run_id") == run_id)
    return runs.orderBy(append_order(runs).desc()).limit(1)


def latest_status(runs: DataFrame, artefacts: DataFrame) -> DataFrame:
    """Health of the latest run: ok when its artefacts exist, else degraded."""
    latest = runs.agg(
        F.max_by(F.struct("run_id", "order", "seasonal_order"), append_order(runs)).alias("l")
    ).select("l.*")
    loaded = artefacts.select("run_id").distinct().withColumn("model_loaded", F.lit(True))
    joined = latest.join(loaded, "run_id", "left")
    ok = F.coalesce("model_loaded", F.lit(False))
    return joined.select(
        F.when(ok, "ok").otherwise("degraded").alias("status"),
        ok.alias("model_loaded"),
        F.col("run_id").alias("latest_run_id"),
        F.when(ok, model_name(F.col("order"), F.col("seasonal_order"))).alias("model_name"),
    )
