"""Exact quantiles with linear interpolation, for groups of any size.

A mergeable sketch proposes cut values around each requested quantile. Rows are
then counted exactly between the cuts, which tells for certain which narrow slice
holds each wanted rank; only those slices are sorted. The sketch's error changes
how thin a slice is, never the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.frames import attach, grouped, meet
from wattline.session import cut

ACCURACY = 10_000
OFFSETS = (2, 20, 200)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], name: str = "q", *more: Column
) -> DataFrame:
    """One row per key with ``name``: array of quantiles in the order of ``probs``.

    ``more`` aggregates of ``df`` come out of the sketch's own pass. The sketch and the
    wanted slices are written, so the planner knows their size: while they are small, no
    row of ``df`` is shuffled outside the slices. ``df`` is read three times.
    """
    keys = list(keys)
    around = [p + side * o / ACCURACY for p in probs for o in OFFSETS for side in (-1, 1)]
    cuts = sorted({min(1.0, max(0.0, p)) for p in around})
    number = F.col(value).cast("double")
    base = cut(grouped(df, keys, F.percentile_approx(number, cuts, ACCURACY).alias("__cuts"), *more), "sketch")
    rows = df.select(*keys, number.alias("__v")).where(F.col("__v").isNotNull())
    sketch = base.select(*keys, "__cuts")
    edges = [F.col("__cuts")[i] for i in range(len(cuts))]
    above = [(F.col("__v") > e).cast("int") for e in edges]
    slice_no = above[0]
    for a in above[1:]:
        slice_no = slice_no + a
    sliced = attach(rows, sketch, keys).select(*keys, "__v", slice_no.alias("__slice"))

    order = Window.partitionBy(*keys).orderBy("__slice")
    counts = sliced.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    placed = counts.select(
        *keys,
        "__slice",
        "__n",
        (F.sum("__n").over(order) - F.col("__n")).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*keys)).alias("__total"),
    )
    at = [F.lit(float(p)) * (F.col("__total") - 1) for p in probs]
    ranks = [f(a).cast("long") for a in at for f in (F.floor, F.ceil)]
    holds = F.lit(False)
    for r in ranks:
        holds = holds | ((F.col("__before") <= r) & (r < F.col("__before") + F.col("__n")))
    needed = cut(placed.where(holds).select(*keys, "__slice", "__before", "__total"), "slices")

    values = meet(sliced, needed, [*keys, "__slice"])
    freq = values.groupBy(*keys, "__slice", "__v").agg(
        F.count(F.lit(1)).alias("__n"), F.first("__before").alias("__before"), F.first("__total").alias("__total")
    )
    inside = Window.partitionBy(*keys, "__slice").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = freq.withColumn("__upto", F.col("__before") + F.sum("__n").over(inside))
    picks = []
    for i, r in enumerate(ranks):
        hit = (F.col("__upto") > r) & (F.col("__upto") - F.col("__n") <= r)
        picks.append(F.max(F.when(hit, F.col("__v"))).alias(f"__r{i}"))
    found = grouped(ranked, keys, F.max("__total").alias("__total"), *picks)
    out = []
    for i, a in enumerate(at):
        lo, hi = F.col(f"__r{2 * i}"), F.col(f"__r{2 * i + 1}")
        out.append(lo + (hi - lo) * (a - F.floor(a)))
    quantiles = found.select(*keys, F.array(*out).alias(name))
    if not more:
        return quantiles
    own = base.drop("__cuts")
    if keys:
        return meet(own, quantiles, keys, "left")
    return own.withColumn(name, quantiles.select(name).scalar())
