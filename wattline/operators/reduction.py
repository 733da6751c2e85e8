"""Feature reduction: imputation, standardisation and principal components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.operators.frames import attach, by_date, listed
from wattline.operators.gaps import fill_both, on_shared_dates
from wattline.session import cut

#: Columns up to which the matrix of their products is summed in one pass and kept by the driver.
DENSE_COLUMNS = 512
#: Directions of the search beyond the components wanted.
OVERSAMPLE = 10
#: Residual of a component, as a share of the first eigenvalue, at which it is found; passes at most.
TOLERANCE, PASSES = 1e-11, 500
#: Numbers of a dense slice of days, and columns that travel as one row of a sum.
SLICE, STRIP = 1 << 22, 256


def with_cumulative(explained: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Running total of the explained ratio over components."""
    so_far = by_date(keys, "component").rowsBetween(Window.unboundedPreceding, 0)
    return explained.withColumn("cumulative", F.sum("ratio").over(so_far))


def components_needed(explained: DataFrame, thresholds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Smallest component count reaching each threshold, else all of them."""
    levels = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    rows = explained.select(*keys, "component", "cumulative", levels)
    enough = F.min(F.when(F.col("cumulative") >= F.col("threshold"), F.col("component")))
    return rows.groupBy(*keys, "threshold").agg(
        F.coalesce(enough, F.max("component")).alias("components_needed")
    )


@dataclass
class Components:
    """A fitted reduction as three small tables, one row per station column or component."""

    scaler: DataFrame  # column, mean, std
    loadings: DataFrame  # component, column, loading
    explained: DataFrame  # component, ratio, cumulative

    def first(self, k: int) -> Components:
        """The same fit with its first ``k`` components."""
        kept = F.col("component") <= k
        return Components(self.scaler, self.loadings.where(kept), self.explained.where(kept))


def column_stats(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean and population std per column; a constant column gets divisor 1."""
    std = F.stddev_pop(value)
    return long.groupBy(*keys).agg(F.avg(value).alias("mean"), F.when(std > 0, std).otherwise(1.0).alias("std"))


def standardise(long: DataFrame, scaler: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Apply a stored scaler; the scaler is one row per column, so Spark may broadcast it."""
    z = (F.col(value) - F.col("mean")) / F.col("std")
    return long.join(scaler, list(keys)).withColumn(value, z).drop("mean", "std")


def impute_columns(long: DataFrame) -> DataFrame:
    """Forward then backward fill of every column over the dates any column has.

    A column without a single value cannot be filled and drops out.
    """
    dense = on_shared_dates(long, "column", "value")
    return fill_both(dense, ["value"], ["column"]).where(F.col("value").isNotNull())


def station_columns(stations: DataFrame, variables: Sequence[str] = ("TN", "TX")) -> DataFrame:
    """Long ``date, column, value`` with columns named ``TN_<id>`` and ``TX_<id>``."""
    rows = stations.where(F.col("variable").isin(*variables))
    name = F.concat_ws("_", "variable", "station").alias("column")
    return rows.select("date", name, F.col("value").cast("double").alias("value"))


def multiply(days: DataFrame, n: int, q: np.ndarray | None = None) -> np.ndarray:
    """Z'Z q, or Z'Z itself: tasks sum over their days, the sums merge strip by strip.

    ``days`` has a row per day with the numbers ``at`` of its columns and their values ``z``.
    """
    width = n if q is None else q.shape[1]
    shared = days.sparkSession.sparkContext.broadcast(q)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, directions = np.zeros((n, width)), shared.value
        for batch in batches:
            for start in range(0, len(batch), max(1, SLICE // n)):
                part = batch.slice(start, max(1, SLICE // n))
                at, z = part.column("at"), part.column("z")
                sizes = np.diff(at.offsets.to_numpy())
                dense = np.zeros((len(part), n))
                dense[np.repeat(np.arange(len(part)), sizes), at.flatten().to_numpy()] = z.flatten().to_numpy()
                total += dense.T @ (dense if directions is None else dense @ directions)
        strips = [total[i : i + STRIP].ravel() for i in range(0, n, STRIP)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(strips)), pa.int32()), pa.array(strips, pa.list_(pa.float64()))], names=["strip", "sums"]
        )

    parts = days.mapInArrow(partial, "strip int, sums array<double>").groupBy("strip")
    merged = parts.agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).collect()
    return np.concatenate([np.zeros(0), *[r["sums"] for r in sorted(merged, key=lambda r: r["strip"])]]).reshape(n, width)


def fresh(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``w`` that are not in ``x``, whose columns are orthonormal."""
    for _ in range(2):
        w = w / np.maximum(np.linalg.norm(w, axis=0), 1e-300)
        q, r = np.linalg.qr(w - x @ (x.T @ w))
        turn, size, _ = np.linalg.svd(r)
        w = q @ turn[:, : len(size)][:, size > 1e-10 * max(size.max(initial=0.0), 1e-300)]
    return w[:, : x.shape[0] - x.shape[1]]


def leading(times: Callable[[np.ndarray], np.ndarray], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, and their vectors, of a symmetric matrix known by its products.

    A random range is widened by its residuals and by its last step (block conjugate
    gradients) and cut back to the best directions, until the residuals of the wanted
    ones vanish. With as many directions as columns the first product is the answer.
    """
    width = min(n, k + OVERSAMPLE)
    x = np.linalg.qr(np.random.default_rng(0).standard_normal((n, width)))[0]
    image, step = times(x), np.zeros((n, 0))
    for _ in range(PASSES):
        small = x.T @ image
        value, c = np.linalg.eigh((small + small.T) / 2)
        best = np.argsort(-value)[:width]
        value, c = value[best], c[:, best]
        if x.shape[1] > width:
            step = x[:, width:] @ c[width:]
        x, image = x @ c, image @ c
        rest = image - x * value
        more = fresh(np.hstack([rest, step]), x)
        if np.linalg.norm(rest[:, :k], axis=0).max() <= TOLERANCE * value[0] or not more.shape[1]:
            return value[:k], x[:, :k]
        x, image = np.hstack([x, more]), np.hstack([image, times(more)])
    raise RuntimeError(f"the first {k} components were not found in {PASSES} passes")


def fit_components(filled: DataFrame, k: int | None = None, dense_columns: int = DENSE_COLUMNS) -> Components:
    """Principal components of standardised columns, from long rows.

    Days are written once, one row with all its values each; nothing is pivoted. Up to
    ``dense_columns`` columns one pass sums the matrix of their products; beyond, every step
    of the search is a pass over the days, and what reaches the driver is a matrix of
    columns by ``k`` and ten more. Both give the same components. Without ``k`` it is all of them.
    """
    spark = filled.sparkSession
    scaler = cut(column_stats(filled, ["column"]), "scaler")
    names = sorted(listed(scaler.select("column"), "station columns"))
    if not names:
        raise ValueError("no station has a value on the dates of the grid")
    n = len(names)
    k = n if k is None else min(k, n)
    numbered = spark.createDataFrame(list(enumerate(names)), "at int, column string")
    z = standardise(filled, scaler.join(numbered, "column"), ["column"])
    days = z.groupBy("date").agg(F.collect_list(F.struct("at", F.col("value").alias("z"))).alias("c"))
    days = cut(days.select("c.at", "c.z"), "standardised")
    if n <= dense_columns:
        gram = multiply(days, n)
        value, pc = leading(lambda q: gram @ q, n, k)
        total = float(np.trace(gram))
    else:
        value, pc = leading(lambda q: multiply(days, n, q), n, k)
        squares = F.aggregate("z", F.lit(0.0), lambda acc, v: acc + v * v)
        total = days.agg(F.sum(squares)).first()[0]
    flip = np.where(pc[np.abs(pc).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    rows = [(j + 1, name, float(pc[i, j] * flip[j])) for j in range(k) for i, name in enumerate(names)]
    loadings = spark.createDataFrame(rows, "component int, column string, loading double")
    ratios = [(j + 1, float(max(v, 0.0) / total) if total > 0 else 0.0) for j, v in enumerate(value)]
    explained = spark.createDataFrame(ratios, "component int, ratio double")
    return Components(scaler, loadings, with_cumulative(explained))


def component_scores(filled: DataFrame, fit: Components) -> DataFrame:
    """Scores in long form ``date, component, score``: a weighted sum per day, no pivot.

    Rows carry one loading array, not one row per component.
    """
    weights = fit.loadings.groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("component", "loading"))).alias("w")
    )
    z = standardise(filled, fit.scaler, ["column"]).join(weights, "column")
    terms = z.select("date", F.col("value").alias("z"), F.inline("w"))
    return terms.groupBy("date", "component").agg(F.sum(F.col("z") * F.col("loading")).alias("score"))


def component_features(scores: DataFrame, k: int, prefix: str = "temp_pc_") -> DataFrame:
    """Wide ``temp_pc_01…`` columns per day."""
    wide = scores.groupBy("date").pivot("component", list(range(1, k + 1))).agg(F.first("score"))
    return wide.select("date", *[F.col(str(j)).alias(f"{prefix}{j:02d}") for j in range(1, k + 1)])


def national_projection(fit: Components) -> DataFrame:
    """One row per component: weights of the national minimum and maximum, and an offset.

    Putting one value on all TN columns and one on all TX columns makes the score a
    linear form of two numbers, so a request needs three constants, not a matrix.
    """
    w = F.col("loading") / F.col("std")
    name = F.col("column")
    low, high = name.startswith("TN_"), name.startswith("TX_")
    return (
        fit.loadings.join(fit.scaler, "column")
        .groupBy("component")
        .agg(
            F.sum(F.when(low, w).otherwise(0.0)).alias("per_min"),
            F.sum(F.when(high, w).otherwise(0.0)).alias("per_max"),
            (-F.sum(w * F.col("mean"))).alias("offset"),
        )
    )


def project_requests(requests: DataFrame, projection: DataFrame | None) -> DataFrame:
    """Add ``pca_components``, one per component of the fit; without a stored fit the list is empty."""
    if projection is None:
        return requests.withColumn("pca_components", F.array().cast("array<double>"))
    forms = F.sort_array(F.collect_list(F.struct("component", "per_min", "per_max", "offset")))
    rows = attach(requests, projection.agg(forms.alias("__forms")))
    score = F.transform(
        "__forms",
        lambda c: c["per_min"] * F.col("temp_min_avg") + c["per_max"] * F.col("temp_max_avg") + c["offset"],
    )
    return rows.withColumn("pca_components", score).drop("__forms")


def save_components(fit: Components, path: str) -> None:
    """The fitted tables under one folder; runs refer to it instead of copying it."""
    for name in ("scaler", "loadings", "explained"):
        getattr(fit, name).write.mode("overwrite").parquet(f"{path}/{name}")


def load_components(spark: SparkSession, path: str) -> Components:
    return Components(*[spark.read.parquet(f"{path}/{n}") for n in ("scaler", "loadings", "explained")])


def choose_components(explained: DataFrame, threshold: float) -> int:
    """Smallest k whose cumulative ratio reaches the threshold."""
    return components_needed(explained, [threshold]).first()["components_needed"]
