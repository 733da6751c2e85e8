"""Contextual peaks: thresholds, detection quality, model ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators import metrics as m
from wattline.operators.frames import attach, grouped, meet
from wattline.operators.topk import top_per_group

PEAK_QUANTILE = 0.9
MIN_CONTEXT = 20
CONTEXT = ("month", "dow")


def with_context(log: DataFrame, date: str = "date") -> DataFrame:
    return log.withColumns({"month": F.month(date), "dow": F.weekday(date)})


def context_stats(log: DataFrame, keys: Sequence[str], q: float = PEAK_QUANTILE) -> DataFrame:
    """Count and quantile per context, put back on every row.

    A forecast log holds one row per (keys, date), so a context holds at most a
    seventh of one month of every year: the exact percentile stays small. It is an
    aggregate joined back, so rows are shuffled as 84 contexts per key, not as
    whole window partitions.
    """
    rows = with_context(log)
    by = [*keys, *CONTEXT]
    stats = rows.groupBy(*by).agg(
        F.count("actual").alias("context_count"),
        F.percentile("actual", F.lit(q)).alias("threshold_context"),
    )
    return meet(rows, stats, by)


def with_peaks(
    log: DataFrame, keys: Sequence[str], min_context: int = MIN_CONTEXT, q: float = PEAK_QUANTILE
) -> DataFrame:
    """Peak threshold per row: the context's quantile, or the key's when the context is thin."""
    overall = grouped(log, keys, F.percentile("actual", F.lit(q)).alias("threshold_global"))
    rows = attach(context_stats(log, keys, q), overall, keys)
    threshold = F.when(F.col("context_count") >= min_context, F.col("threshold_context")).otherwise(
        F.col("threshold_global")
    )
    rows = rows.withColumn("peak_threshold", threshold)
    return rows.withColumn("is_peak", F.col("actual") >= F.col("peak_threshold"))


def threshold_summary(peaks: DataFrame, keys: Sequence[str]) -> DataFrame:
    flag = F.col("is_peak").cast("long")
    return grouped(
        peaks,
        keys,
        F.median("peak_threshold").alias("threshold_median"),
        F.min("peak_threshold").alias("threshold_min"),
        F.max("peak_threshold").alias("threshold_max"),
        F.sum(flag).alias("n_peaks"),
        F.count("is_peak").alias("n_points"),
        (F.try_divide(F.sum(flag), F.count("is_peak")) * 100).alias("peak_share_pct"),
    )


def detection_quality(peaks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Confusion counts of predicted peaks, precision, recall and F1."""
    truth = F.col("is_peak")
    called = F.col("predicted") >= F.col("peak_threshold")
    counts = grouped(
        peaks,
        keys,
        F.count_if(truth & called).alias("tp"),
        F.count_if(~truth & called).alias("fp"),
        F.count_if(truth & ~called).alias("fn"),
        F.count_if(~truth & ~called).alias("tn"),
    )
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    out = counts.withColumns({"precision": precision, "recall": recall})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.try_divide(2 * p * r, p + r))


def backtest_summary(peaks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Error metrics overall and on peaks, one row per (model, horizon)."""
    peak_error = F.when(F.col("is_peak"), F.col("error"))
    under = F.when(F.col("is_peak"), (F.col("predicted") < F.col("actual")).cast("double"))
    return grouped(
        peaks,
        keys,
        F.count(F.lit(1)).alias("n_points"),
        m.mae().alias("mae"),
        m.rmse().alias("rmse"),
        m.mape().alias("mape"),
        F.first("threshold_global").alias("threshold_global"),
        F.median("peak_threshold").alias("threshold_median"),
        F.count(peak_error).alias("n_peaks"),
        F.avg(F.abs(peak_error)).alias("peak_mae"),
        F.sqrt(F.avg(peak_error * peak_error)).alias("peak_rmse"),
        F.avg(under).alias("under_rate_peak"),
    )


RANKED = ("mape", "mae", "rmse", "peak_mae", "peak_rmse")


def with_ranks(summary: DataFrame, group: str = "horizon") -> DataFrame:
    """Rank of each metric within the group (ties share the lowest), null for a null metric."""

    def rank(c: str) -> Column:
        place = F.rank().over(Window.partitionBy(group).orderBy(F.asc_nulls_last(c)))
        return F.when(F.col(c).isNotNull(), place)

    return summary.withColumns({f"rank_{c}": rank(c) for c in RANKED})


def with_priority(ranked: DataFrame) -> DataFrame:
    """Weighted rank that favours peaks."""
    score = 0.45 * F.col("rank_peak_rmse") + 0.35 * F.col("rank_peak_mae") + 0.20 * F.col("rank_rmse")
    return ranked.withColumn("rank_peak_priority", score)


def best_models(scored: DataFrame, group: str = "horizon") -> DataFrame:
    """Best model per horizon for five criteria, the first name on ties."""
    criteria = ("peak_rmse", "peak_mae", "rmse", "mape", "rank_peak_priority")
    picks = [
        F.min_by("model", F.when(F.col(c).isNotNull(), F.struct(c, "model"))).alias(
            "best_" + c.removeprefix("rank_")
        )
        for c in criteria
    ]
    return scored.groupBy(group).agg(*picks)


def worst_peaks(peaks: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """Largest absolute errors on peaks, ``n`` per key, with the signed % error."""
    rows = peaks.where("is_peak").withColumn("signed_pct_error", F.try_divide("error", "actual") * 100)
    return top_per_group(rows, keys, [F.desc("abs_error"), F.asc("date")], n)
