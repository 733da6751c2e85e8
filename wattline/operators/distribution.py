"""Distributions as data: histogram, box statistics, densities, Q-Q points."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.frames import attach_stats, grouped, meet
from wattline.operators.ordered import opened, ranked_values
from wattline.operators.quantiles import exact_quantiles

#: Bandwidths beyond which a Gaussian adds less than a double can hold.
REACH = 8.5


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Exactly ``bins`` equal-width bins, last edge closed, empty bins present."""
    v = F.col(value)
    rows = df.select(*keys, v.alias("__v")).where(F.col("__v").isNotNull())
    ends = grouped(
        rows,
        keys,
        F.min("__v").alias("lo"),
        F.max("__v").alias("hi"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    place = F.floor(F.try_divide(F.col("__v") - F.col("lo"), F.col("width")))
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = (
        attach_stats(rows, ends, keys)
        .groupBy(*keys, bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = ends.select(*keys, "lo", "width", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return meet(edges, counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + F.col("width") * F.col("bin")).alias("left_edge"),
        n.alias("n"),
        F.try_divide(n, F.col("total") * F.col("width")).alias("density"),
    )


def box_statistics(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count per group of any size."""
    q = exact_quantiles(df, keys, value, [0.25, 0.5, 0.75], "__q").select(
        *keys,
        F.col("__q")[0].alias("q1"),
        F.col("__q")[1].alias("median"),
        F.col("__q")[2].alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    v = F.col(value)
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    rows = attach_stats(df.select(*keys, value).where(v.isNotNull()), q, keys)
    return rows.groupBy(*keys).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def _points(n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i")


def kernel_density(
    df: DataFrame, value: str, points: int = 200, keys: Sequence[str] = (), error: float | None = 1e-6
) -> DataFrame:
    """Gaussian density with Scott's bandwidth on a grid over the data range.

    Values are spread over fine bins, each between its two nearest bin edges by linear
    weights, and a bin adds to the points within ``REACH`` bandwidths. That puts straight lines
    between the kernel's values at the edges, so with edges sqrt(8 * ``error``) bandwidths
    apart no density is off by more than ``error`` times the peak of a kernel,
    1 / (bandwidth * sqrt(2 * pi)). Rows cost one hash and one sum each. ``error=None``
    is the exact sum, ``points`` terms for each row. Without spread the density is null.
    """
    rows = df.select(*keys, F.col(value).alias("__v")).where(F.col("__v").isNotNull())
    stats = grouped(
        rows,
        keys,
        F.min("__v").alias("__lo"),
        F.max("__v").alias("__hi"),
        F.count(F.lit(1)).alias("__n"),
        (F.stddev_samp("__v") * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("__h"),
    )
    lo, h = F.col("__lo"), F.col("__h")
    step = (F.col("__hi") - lo) / (points - 1)
    peak = F.col("__n") * h * F.sqrt(2 * F.pi())

    def kernel(at: Column) -> Column:
        u = F.try_divide(lo + step * F.col("i") - at, h)
        return F.exp(-u * u / 2)

    with_stats = attach_stats(rows, stats, keys)
    if error is None:
        spread = with_stats.select("*", _points(points))
        sums = spread.groupBy(*keys, "i").agg(F.sum(kernel(F.col("__v"))).alias("__sum"))
    else:
        width = h * math.sqrt(8 * error)
        at = F.try_divide(F.col("__v") - lo, width)
        share = at - F.floor(at)
        carried = [F.first(c).alias(c) for c in ("__lo", "__hi", "__h")]
        bins = (
            with_stats.where(h > 0)
            .groupBy(*keys, F.floor(at).alias("bin"))
            .agg(F.sum(1 - share).alias("__left"), F.sum(share).alias("__right"), *carried)
        )
        edge = lo + width * F.col("bin")
        first = F.greatest(F.ceil((edge - REACH * h - lo) / step), F.lit(0))
        last = F.least(F.floor((edge + width + REACH * h - lo) / step), F.lit(points - 1))
        spread = bins.withColumn("i", F.explode(F.when(first <= last, F.sequence(first, last))))
        term = F.col("__left") * kernel(edge) + F.col("__right") * kernel(edge + width)
        sums = spread.groupBy(*keys, F.col("i").cast("int").alias("i")).agg(F.sum(term).alias("__sum"))
    grid = stats.where(F.col("__n") > 0).select("*", _points(points))
    density = F.when(h > 0, F.try_divide(F.coalesce("__sum", F.lit(0.0)), peak))
    return meet(grid, sums, [*keys, "i"], "left").select(
        *keys, "i", (lo + step * F.col("i")).alias("x"), density.alias("density")
    )


def normal_overlay(df: DataFrame, value: str, points: int = 200, keys: Sequence[str] = ()) -> DataFrame:
    """Normal density with the sample's mean and std over its range."""
    stats = grouped(
        df,
        keys,
        F.min(value).alias("__lo"),
        F.max(value).alias("__hi"),
        F.avg(value).alias("__mu"),
        F.stddev_samp(value).alias("__sd"),
    )
    x = F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("i") / (points - 1)
    z = (x - F.col("__mu")) / F.col("__sd")
    pdf = F.exp(-z * z / 2) / (F.col("__sd") * F.sqrt(2 * F.pi()))
    return stats.select("*", _points(points)).select(*keys, "i", x.alias("x"), pdf.alias("density"))


# Numerator and denominator of the rational approximations of the normal
# quantile (algorithm AS 241), lowest power first, for the middle, the near and the far tail.
MIDDLE = (
    [3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
     45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
    [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
     21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610],
)
NEAR = (
    [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640],
    [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
     0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9],
)
FAR = (
    [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
     0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
    [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
     0.000786869131145613259100, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15],
)


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile of a probability strictly between 0 and 1."""

    def ratio(parts: tuple[list[float], list[float]], x: Column) -> Column:
        top, bottom = (reduce(lambda acc, c: acc * x + c, reversed(c[:-1]), F.lit(c[-1])) for c in parts)
        return top / bottom

    q = p - 0.5
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))
    size = F.when(tail <= 5.0, ratio(NEAR, tail - 1.6)).otherwise(ratio(FAR, tail - 5.0))
    middle = q * ratio(MIDDLE, 0.180625 - q * q)
    return F.when(F.abs(q) <= 0.425, middle).otherwise(F.when(q < 0, -size).otherwise(size))


def normal_qq(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Ordered values against normal order-statistic medians (Filliben), for groups of any size."""
    rows = df.select(*keys, F.col(value).alias("observed"))
    ranked = opened(ranked_values(rows, keys, "observed"), "i").select(
        *keys, "observed", (F.col("i") + 1).cast("int").alias("i"), F.col("total").alias("n")
    )
    last = F.pow(F.lit(0.5), 1 / F.col("n"))
    p = (
        F.when(F.col("i") == F.col("n"), last)
        .when(F.col("i") == 1, 1 - last)
        .otherwise((F.col("i") - 0.3175) / (F.col("n") + 0.365))
    )
    return ranked.select(*keys, "i", inverse_normal(p).alias("theoretical"), "observed")


def qq_line(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return grouped(
        points,
        keys,
        F.regr_slope("observed", "theoretical").alias("slope"),
        F.regr_intercept("observed", "theoretical").alias("intercept"),
        # Null for a constant sample, where F.corr divides by zero.
        F.try_divide(
            F.covar_samp("observed", "theoretical"), F.stddev_samp("observed") * F.stddev_samp("theoretical")
        ).alias("r"),
    )
