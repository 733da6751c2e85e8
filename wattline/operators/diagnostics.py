"""Time-series diagnostics: correlograms, unit-root tests, residual bundle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators import distribution as dist
from wattline.operators.frames import attach, by_date, grouped
from wattline.operators.metrics import residual_statistics, with_health
from wattline.operators.ordered import series_blocks
from wattline.operators.regression import key_schema, solve
from wattline.operators.rolling import autocovariance
from wattline.session import cut

Z95 = 1.959963984540054
#: Rows of a lag matrix held at a time.
SLICE_ROWS = 1 << 13
#: Share of a sum of squares below which what is left of it is rounding.
ROUNDING = 1e-13

# MacKinnon's response surface for the ADF p-value with a constant
# (smallest, largest and switching statistic, and the two polynomials), and the
# KPSS critical values for a level with their p-values.
ADF_MIN, ADF_MAX, ADF_SWITCH = -18.83, 2.74, -1.61
ADF_SMALL = [2.1659, 1.4412, 0.038269]
ADF_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]
KPSS_STAT = [0.347, 0.463, 0.574, 0.739]
KPSS_P = [0.10, 0.05, 0.025, 0.01]


def acf(df: DataFrame, value: str, lags: int = 40, keys: Sequence[str] = ()) -> DataFrame:
    """Autocorrelation with Bartlett's 95 % band."""
    r = autocovariance(df, value, lags, keys)
    before = by_date(keys, "lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(before)
    variance = (1 + 2 * F.coalesce(squares, F.lit(0.0))) / F.col("n")
    band = F.when(F.col("lag") == 0, 0.0).otherwise(Z95 * F.sqrt(variance))
    return r.select(*keys, "lag", "acf", band.alias("band"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def partial_correlations(r: pd.Series) -> pd.Series:
    """Durbin-Levinson recursion over a short autocorrelation array."""

    def one(acf: np.ndarray) -> list[float]:
        out, phi = [1.0], np.zeros(0)
        for k in range(1, len(acf)):
            inner = acf[1:k]
            last = (acf[k] - phi @ inner[::-1]) / (1.0 - phi @ inner)
            phi = np.append(phi - last * phi[::-1], last)
            out.append(float(last))
        return out

    return r.map(lambda a: one(np.asarray(a, dtype=float)))


def pacf(df: DataFrame, value: str, lags: int = 40, keys: Sequence[str] = ()) -> DataFrame:
    """Partial autocorrelation (Yule-Walker, divisor n) with the ±1.96/√n band."""
    r = autocovariance(df, value, lags, keys)
    listed = grouped(
        r,
        keys,
        F.max("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("lag", "acf")))["acf"].alias("__r"),
    )
    band = F.lit(Z95) / F.sqrt("n")
    long = listed.select(*keys, band.alias("band"), F.posexplode(partial_correlations("__r")).alias("lag", "pacf"))
    return long.select(*keys, "lag", "pacf", F.when(F.col("lag") == 0, 0.0).otherwise(F.col("band")).alias("band"))


def adf_p_value(stat: float) -> float:
    if stat > ADF_MAX:
        return 1.0
    if stat < ADF_MIN:
        return 0.0
    curve = ADF_SMALL if stat <= ADF_SWITCH else ADF_LARGE
    return NormalDist().cdf(sum(c * stat**i for i, c in enumerate(curve)))


def adf(df: DataFrame, value: str, keys: Sequence[str] = (), lags: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, lag chosen by AIC, or ``lags`` of them.

    A series is summed in blocks that overlap by the longest lag; the sums of a key merge.
    Every lag length is solved from one matrix of sums over the sample shared by
    all of them; the chosen one is refitted with the few earlier rows it can use,
    which travel as a short array. One row per key, or one in all without keys: a series
    too short for the test (three values or fewer), or one that the lags explain without a
    rest, has a null statistic.
    """
    keys = list(keys)
    # The test ignores the level; taking the mean off keeps the sums of squares small.
    size = grouped(df, keys, F.count(value).alias("n_obs"), F.avg(value).alias("__mean"))
    n_obs = F.col("n_obs")
    reach = F.least(F.ceil(12 * F.pow(n_obs / 100, F.lit(0.25))), F.floor(n_obs / 2) - 2) if lags is None else F.lit(lags)
    # More rows than terms, in the sample that all lags share.
    enough = n_obs - reach - 1 > 2 + (0 if lags is None else lags)
    size = size.withColumn("max_lag", F.when((reach >= 0) & enough, reach.cast("int")))
    known = df.where(F.col(value).isNotNull()).select(*keys, "date", F.col(value).cast("double").alias("y"))
    tested = attach(known, size, keys).where("max_lag IS NOT NULL")
    rows = tested.select(*keys, "date", (F.col("y") - F.col("__mean")).alias("y"), "max_lag")
    blocks = series_blocks(rows, keys, "date", F.col("max_lag") + 1)

    def block_sums(table: pa.Table) -> pa.Table:
        order = np.argsort(table["pos"].to_numpy())
        y, own, pos = (table[c].to_numpy()[order] for c in ("y", "own", "pos"))
        top = table["max_lag"][0].as_py()
        change = np.diff(y)
        at = np.flatnonzero(own & (pos > top))
        products = np.zeros((top + 3, top + 3))
        for start in range(0, len(at), SLICE_ROWS):
            t = at[start : start + SLICE_ROWS]
            # The change of a row, then those of the rows before it.
            recent = change[t[:, None] - 1 - np.arange(top + 1)]
            x = np.column_stack([np.ones(len(t)), y[t - 1], recent[:, 1:], recent[:, :1]])
            products += x.T @ x
        head = y[: top + 1] if pos[0] == 0 else None
        first = table.select([*keys, "max_lag"]).slice(0, 1)
        for name, cell, kind in (
            ("n", len(at), pa.int64()),
            ("products", products.ravel(), pa.list_(pa.float64())),
            ("head", head, pa.list_(pa.float64())),
        ):
            first = first.append_column(name, pa.array([cell], kind))
        return first

    schema = key_schema(df, keys) + "max_lag int, n long, products array<double>, head array<double>"
    parts = blocks.groupBy(*keys, "block").applyInArrow(block_sums, schema)
    merged = [
        F.max("max_lag").alias("max_lag"),
        F.sum("n").alias("n"),
        vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products"),
        F.max("head").alias("head"),
    ]
    sums = parts.groupBy(*(keys or [F.lit(0).alias("__all")])).agg(*merged)

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                n, top, y = int(row["n"]), int(row["max_lag"]), np.asarray(row["head"])
                gram = np.asarray(row["products"]).reshape(top + 3, top + 3)
                target = top + 2
                floor = gram[target, target] * ROUNDING

                def aic(p: int) -> float:
                    rss = solve(gram, n, list(range(2 + p)), target)["rss"]
                    return n * np.log(max(rss, floor, 1e-300) / n) + 2 * (2 + p)

                best = min(range(top + 1), key=aic) if lags is None else lags
                dy = np.diff(y)
                extra = np.zeros((top - best, top + 3))
                for i, t in enumerate(range(best + 1, top + 1)):
                    extra[i, 0], extra[i, 1], extra[i, target] = 1.0, y[t - 1], dy[t - 1]
                    extra[i, 2 : 2 + best] = [dy[t - 1 - k] for k in range(1, best + 1)]
                gram = gram + extra.T @ extra
                s = solve(gram, n + len(extra), list(range(2 + best)), target)
                rest = s["rss"] > gram[target, target] * ROUNDING and s["se"][1] > 0
                stat = float(s["coef"][1] / s["se"][1]) if rest else None
                p = None if stat is None else adf_p_value(stat)
                out.append((*[row[k] for k in keys], stat, p, best, n + len(extra)))
            yield pd.DataFrame(out, columns=[*keys, "statistic", "p", "lags", "n"])

    schema = key_schema(df, keys) + "statistic double, p double, lags int, n long"
    found = sums.select(*keys, "n", "products", "max_lag", "head").mapInPandas(test, schema)
    whole = attach(size.select(*keys), found, keys) if keys else attach(size.select("n_obs"), found).drop("n_obs")
    stat, p = (F.when(~F.isnan(c), F.col(c)) for c in ("statistic", "p"))
    whole = whole.withColumns({"statistic": stat, "p": p, "n": F.coalesce("n", F.lit(0).cast("long"))})
    return whole.withColumn("stationary", F.col("p") < 0.05)


def lag_sums(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What each block of a centred series (``x``) adds to lagged products and to running sums.

    ``block, n, total``, the sums of the block's own running total ``c`` and of its square, and
    ``products``: of every row and the one ``k`` rows earlier, k from 0 to ``top``.
    """

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["pos"].to_numpy())
        x, own = table["x"].to_numpy()[order], table["own"].to_numpy()[order]
        # The block after a series' last one holds copies only.
        start, top = int(np.searchsorted(own, True)), table["top"][0].as_py()
        c = np.cumsum(x[start:])
        products = [float(x[max(start, k) :] @ x[max(start, k) - k : len(x) - k]) for k in range(min(top, len(x) - 1) + 1)]
        products += [0.0] * (top + 1 - len(products))
        first = table.select([*keys, "block"]).slice(0, 1)
        for name, cell in (("n", len(c)), ("total", x[start:].sum()), ("c", c.sum()), ("cc", c @ c)):
            first = first.append_column(name, pa.array([cell], pa.int64() if name == "n" else pa.float64()))
        return first.append_column("products", pa.array([products], pa.list_(pa.float64())))

    schema = key_schema(blocks, keys) + "block long, n long, total double, c double, cc double, products array<double>"
    return blocks.groupBy(*keys, "block").applyInArrow(run, schema)


def kpss(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """KPSS test for a level, with the data-driven lag of Hobijn, Franses and Ooms.

    A series is summed in blocks that overlap by the longest lag; running sums cross blocks
    as one number each. One row per key, or one in all without keys: a series without
    values or without variance has a null statistic.
    """
    keys = list(keys)
    group = keys or [F.lit(0).alias("__all")]
    size = grouped(df, keys, F.count(value).alias("n"), F.avg(value).alias("__m"))
    known = df.where(F.col(value).isNotNull()).select(*keys, "date", F.col(value).cast("double").alias("__v"))
    x = attach(known, size, keys).withColumn("x", F.col("__v") - F.col("__m")).drop("__v", "__m")
    x = x.withColumn("top", F.greatest(F.lit(1), F.floor(F.pow("n", F.lit(2 / 9)))).cast("int")).drop("n")

    def merged(parts: DataFrame) -> Column:
        return vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("s")

    # Sums up to the first lag and the running sums, in one pass.
    parts = cut(lag_sums(series_blocks(x, keys, "date", F.col("top")), keys), "kpss")
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("total").over(before), F.lit(0.0))
    square = F.col("n") * carried * carried + 2 * carried * F.col("c") + F.col("cc")
    spread = parts.select(*keys, "n", "products", square.alias("e"))
    short = spread.groupBy(*group).agg(F.sum("n").alias("n"), F.sum("e").alias("__e"), merged(spread)).drop("__all")
    double = F.transform(F.slice("s", 2, F.size("s")), lambda v: 2 * v)
    s0 = F.col("s")[0] + F.aggregate(double, F.lit(0.0), lambda acc, v: acc + v)
    s1 = F.aggregate(F.transform(double, lambda v, k: (k + 1) * v), F.lit(0.0), lambda acc, v: acc + v)
    # A constant series has no variance: no lag and no statistic.
    share = F.coalesce(F.try_divide(s1, s0), F.lit(0.0))
    ratio = F.pow(share * share, F.lit(1 / 3))
    auto = F.floor(1.1447 * ratio * F.pow("n", F.lit(1 / 3)))
    chosen = cut(short.select(*keys, "n", "__e", F.least(auto, F.col("n") - 1).cast("int").alias("lags")), "kpss-lags")
    far = attach(x.drop("top"), chosen.select(*keys, F.col("lags").alias("top")), keys)
    long = lag_sums(series_blocks(far, keys, "date", F.col("top")), keys)
    sums = long.groupBy(*group).agg(merged(long)).drop("__all")
    both = attach(chosen, sums, keys)
    weighted = F.transform("s", lambda v, k: v * F.when(k == 0, 1.0).otherwise(2 * (1 - k / (F.col("lags") + 1))))
    variance = F.aggregate(weighted, F.lit(0.0), lambda acc, v: acc + v) / F.col("n")
    stat = F.try_divide(F.col("__e") / (F.col("n") * F.col("n")), F.when(variance > 0, variance))
    found = both.select(*keys, stat.alias("statistic"), "lags")
    out = attach(size.select(*keys, "n"), found, keys).select(*keys, "statistic", "lags", "n")
    p = F.when(F.col("statistic").isNotNull(), interpolated("statistic", KPSS_STAT, KPSS_P))
    return out.withColumn("p", p).withColumn(
        "stationary", F.col("p") >= 0.05
    )


def interpolated(c: str, x: Sequence[float], y: Sequence[float]):
    """Piecewise-linear table lookup, flat outside the table."""
    v = F.col(c)
    out = F.when(v <= x[0], F.lit(y[0]))
    for x0, x1, y0, y1 in zip(x, x[1:], y, y[1:]):
        out = out.when(v <= x1, y0 + (y1 - y0) * (v - x0) / (x1 - x0))
    return out.otherwise(F.lit(y[-1]))


def stationarity_report(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """ADF and KPSS verdicts as one row per key and test."""
    tests = {"adf": adf(df, value, keys), "kpss": kpss(df, value, keys)}
    parts = [t.select(*keys, F.lit(n).alias("test"), "statistic", "p", "lags", "stationary") for n, t in tests.items()]
    return parts[0].unionByName(parts[1])


def residual_bundle(df: DataFrame, residual: str, lags: int = 40, error: float | None = 1e-6) -> DataFrame:
    """The data behind a residual diagnostic plot, as (section, x, y) rows; ``error`` is the density's."""
    r = df.where(F.col(residual).isNotNull())
    scale = r.agg(F.avg(residual).alias("__m"), F.stddev_samp(residual).alias("__sd"))
    z = attach(r, scale).select("date", ((F.col(residual) - F.col("__m")) / F.col("__sd")).alias("z"))
    day = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")).cast("double")
    parts = {
        "standardised": z.select(day.alias("x"), F.col("z").alias("y")),
        "histogram": dist.histogram(z, "z", 40).select(F.col("left_edge").alias("x"), F.col("density").alias("y")),
        "density": dist.kernel_density(z, "z", error=error).select("x", F.col("density").alias("y")),
        "qq": dist.normal_qq(z, "z").select(F.col("theoretical").alias("x"), F.col("observed").alias("y")),
        "correlogram": acf(z, "z", lags).select(F.col("lag").cast("double").alias("x"), F.col("acf").alias("y")),
    }
    frames = [f.select(F.lit(n).alias("section"), "x", "y") for n, f in parts.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def health_table(residuals: DataFrame, residual: str, keys: Sequence[str]) -> DataFrame:
    """Residual statistics and the health verdict per run."""
    return with_health(residual_statistics(residuals, residual, keys, digits=None))
