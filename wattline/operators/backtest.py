"""Expanding-window refits, walk-forward backtests, order search, run backfill."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators import arx
from wattline.operators.checkpoints import half_year_end, half_year_ends
from wattline.operators.frames import attach, grouped, meet
from wattline.operators.metrics import error_metrics
from wattline.operators.regression import cross_products, fit_quality, key_schema
from wattline.session import cut


def running_sums(parts: DataFrame, keys: Sequence[str], step: str, size: int) -> DataFrame:
    """Cross-product sums of every window that grows by one ``step`` at a time.

    The input holds one small matrix per key and step, already summed over rows;
    the number of steps is bounded by the evaluation plan, not by the data. A step
    without rows repeats the window before it.
    """
    keys = list(keys)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(step)
        n, g, out = 0, np.zeros(size * size), []
        for row_n, row_g in zip(pdf["n"], pdf["products"]):
            if row_g is not None:
                n, g = n + int(row_n), g + np.asarray(row_g)
            out.append((n, g.copy()))
        pdf["n"], pdf["products"] = [o[0] for o in out], [o[1] for o in out]
        return pdf[pdf["n"] > 0][[*keys, step, "n", "products"]]

    schema = key_schema(parts, [*keys, step]) + "n long, products array<double>"
    rows = parts.select(*keys, step, "n", "products")
    return rows.groupBy(*keys).applyInPandas(grow, schema)


def walk_forward(
    rows: DataFrame,
    spec: arx.Spec,
    specs: dict[str, arx.Spec | arx.Chosen],
    horizons: Sequence[int] = (1, 7),
    initial: int = 730,
    every: int = 30,
    last: int = 1000,
    keys: Sequence[str] = (),
    nested: bool = False,
) -> DataFrame:
    """Rolling-origin backtest: train on all days before an origin, refit every 30.

    A day is summed once, in the cell of refit steps (one for each lead) it first belongs
    to; a lead's refits are running sums of its steps, and an origin uses the latest refit
    at or before it. So the history is read once, however many refits, leads and models
    there are, and each lead forecasts no further than it needs.
    ``rows`` is a design table that every lead reads: pass it materialised.
    A model that chooses its features does so once per key, from the first ``initial``
    days; ``nested`` lets it choose anew at every refit, from that refit's own window.
    """
    keys = list(keys)
    size = grouped(rows, keys, (F.max("pos") + 1).alias("n_days"))
    first = {h: F.greatest(F.lit(initial), F.col("n_days") - h + 1 - last) for h in horizons}
    step = {
        h: F.when(F.col("pos") < f, 0).otherwise(F.floor((F.col("pos") - f) / every) + 1) for h, f in first.items()
    }
    cells = {f"__step{h}": s for h, s in step.items()}
    placed = attach(rows, size, keys).withColumns(cells)
    parts = cross_products(placed, [*keys, *cells], spec.names)
    leads = F.array(*[F.struct(F.lit(h).alias("lead"), F.col(f"__step{h}").alias("step")) for h in horizons])
    by_lead = (
        parts.select(*keys, F.inline(leads), "n", "products")
        .groupBy(*keys, "lead", "step")
        .agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products"))
    )
    sums = running_sums(by_lead, [*keys, "lead"], "step", len(spec.names))
    if not nested:
        sums = with_probe(sums, rows, specs, initial, keys)
    fits = cut(arx.fit(sums, specs, [*keys, "lead", "step"]), "refits")

    logs = []
    for h, f in first.items():
        starts = attach(arx.origin_rows(rows, spec, h, keys), size, keys)
        use = (F.col("pos") + 1 >= f) & (F.col("pos") + h < F.col("n_days"))
        starts = starts.where(use).withColumn("step", F.floor((F.col("pos") + 1 - f) / every))
        mine = fits.where(F.col("lead") == h).select(*keys, "step", "model", "coef", "innovation", "features")
        log = arx.forecast(meet(starts, mine, [*keys, "step"]), spec, h, specs, keys)
        logs.append(log.where(F.col("horizon") == h))
    return reduce(DataFrame.unionByName, logs)


def probe_features(
    rows: DataFrame, specs: dict[str, arx.Spec | arx.Chosen], initial: int = 730, keys: Sequence[str] = ()
) -> DataFrame:
    """What each choosing model picks from a fit of the first ``initial`` days: model, n, features, method."""
    rules = {m: s for m, s in specs.items() if isinstance(s, arx.Chosen)}
    names = next(iter(rules.values())).names
    sums = cross_products(rows.where(F.col("pos") < initial), keys, names)
    return arx.fit(sums, rules, keys).select(*keys, "model", "n", "features", "method")


def with_probe(
    sums: DataFrame, rows: DataFrame, specs: dict[str, arx.Spec | arx.Chosen], initial: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Sums with the features that the probe gives to each choosing model, where there is one."""
    if not any(isinstance(s, arx.Chosen) for s in specs.values()):
        return sums
    probe = probe_features(rows, specs, initial, keys)
    listed = F.map_from_entries(F.collect_list(F.struct("model", "features"))).alias(arx.GIVEN)
    return attach(sums, cut(grouped(probe, keys, listed), "probe"), keys)


def order_grid(spec: arx.Spec, p: int = 3, q: int = 3, sp: int = 2, sq: int = 2) -> tuple[arx.Spec, dict[str, arx.Spec]]:
    """The design that holds every order of the grid, and the models inside it."""
    d, (_, sd, _, m) = spec.order[1], spec.seasonal
    wide = arx.replace(spec, order=(p, d, q), seasonal=(sp, sd, sq, m))
    models = {}
    for a, b, c, e in product(range(p + 1), range(q + 1), range(sp + 1), range(sq + 1)):
        if a or b or c or e:
            models[f"({a}, {d}, {b})x({c}, {sd}, {e}, {m})"] = wide.of(order=(a, d, b), seasonal=(c, sd, e, m))
    return wide, models


def order_search(rows: DataFrame, wide: arx.Spec, models: dict[str, arx.Spec], keys: Sequence[str] = ()) -> DataFrame:
    """AIC of every order of the grid on one shared sample; one pass over the data."""
    sums = cross_products(rows, keys, wide.names)
    return fit_quality(arx.fit(sums, models, keys)).select(*keys, "model", "n", "k", "rss", "llf", "aic", "bic")


def best_order(search: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    best = F.min_by(F.struct("model", "aic", "n"), F.struct("aic", "model")).alias("b")
    return grouped(search, keys, best).select(*keys, "b.*")


def backfill_runs(
    rows: DataFrame,
    spec: arx.Spec,
    first: str = "2013-12-31",
    keys: Sequence[str] = (),
    existing: DataFrame | None = None,
) -> DataFrame:
    """One fitted run per half-year checkpoint, skipping the runs that exist.

    Checkpoints without rows of their own reuse the sums before them. ``rows`` is
    a design table, ideally materialised.
    """
    keys = list(keys)
    closes = F.greatest(half_year_end(F.col("date")), F.lit(first).cast("date"))
    known = rows.where(F.col("w0").isNotNull())
    parts = cross_products(known.withColumn("checkpoint", closes), [*keys, "checkpoint"], spec.names)
    plan = half_year_ends(grouped(known, keys, F.max("date").alias("last")), "last", first, keys)
    full = meet(plan, parts, [*keys, "checkpoint"], "left")
    fits = arx.fit(running_sums(full, keys, "checkpoint", len(spec.names)), {"final": spec}, [*keys, "checkpoint"])
    named = fits.withColumn("run_id", F.concat(F.date_format("checkpoint", "yyyyMMdd"), F.lit("T000000Z")))
    if existing is not None:
        named = meet(named, existing.select(*keys, "run_id"), [*keys, "run_id"], "left_anti")
    return fit_quality(named)


def run_metrics(rows: DataFrame, runs: DataFrame, spec: arx.Spec, keys: Sequence[str] = ()) -> DataFrame:
    """In-sample metrics of every run over its own window.

    Runs are half-years, so a key's list is bounded by the calendar. Each day computes
    the predictions of all runs that were trained on it in its own row; only (run,
    prediction) pairs leave the row, without the design, and errors are summed before
    they are shuffled.
    """
    keys = list(keys)
    listed = grouped(runs, keys, F.collect_list(F.struct("run_id", "checkpoint", "predictor")).alias("__runs"))
    days = rows.select(
        *keys,
        "date",
        F.col("y").alias("actual"),
        (F.col("y") - F.col("w0")).alias("__base"),
        F.array(*[F.col(c) for c in spec.names]).alias("__design"),
    )
    own = F.filter("__runs", lambda r: r["checkpoint"] >= F.col("date"))
    fits = F.transform(
        own,
        lambda r: F.struct(
            r["run_id"].alias("run_id"),
            (F.col("__base") + arx.weighted(F.col("__design"), r["predictor"])).alias("predicted"),
        ),
    )
    used = attach(days, listed, keys).select(*keys, "date", "actual", F.inline(fits))
    found = error_metrics(used, [*keys, "run_id"], count="n_training_days")
    spans = used.where(F.col("predicted").isNotNull()).groupBy(*keys, "run_id")
    ends = spans.agg(F.min("date").alias("training_start"), F.max("date").alias("training_end"))
    return meet(found, ends, [*keys, "run_id"])


def recursive_evaluation(
    rows: DataFrame,
    fits: DataFrame,
    spec: arx.Spec,
    horizon: int = 14,
    step: int = 14,
    window: int = 365,
    keys: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Forecast log of every ``step``-th origin of the last ``window`` days, and the failed origins."""
    keys = list(keys)
    n = grouped(rows, keys, (F.max("pos") + 1).alias("n_days"))
    starts = attach(arx.origin_rows(rows, spec, horizon, keys), n, keys)
    first = F.greatest(F.lit(0), F.col("n_days") - window - horizon)
    chosen = (F.col("pos") >= first) & (F.col("pos") < F.col("n_days") - horizon)
    starts = starts.where(chosen & (F.pmod(F.col("pos") - first, F.lit(step)) == 0))
    models = fits.select(*keys, "model", "coef", "innovation", "features")
    if keys:
        joined = meet(starts, models, keys)
    else:
        listed = models.agg(F.collect_list(F.struct("model", "coef", "innovation", "features")).alias("__fits"))
        joined = attach(starts, listed).select(*starts.columns, F.inline("__fits"))
    log = arx.forecast(joined, spec, horizon, {"final": spec}, keys)
    return log.where(F.col("predicted").isNotNull()), log.where(F.col("predicted").isNull())
