"""Grouped least squares from distributed cross-product sums.

Rows never meet in one place: tasks sum x·xᵀ over their batches, the sums merge
per group, and only a k×k system per group is solved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import erfc, sqrt

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.frames import all_present, attach, ref
from wattline.session import cut

ONE = "__one"


def key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    types = dict(df.dtypes)
    return "".join(f"`{k}` {types[k]}, " for k in keys)


def cross_products(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per key: ``n`` and ``products``, the flattened matrix of sums over ``names``.

    Each Arrow batch gives one partial sum per key it holds, so a key with a third
    of all rows sends one small array per batch to the merge. Rows with a null in
    any of the names are left out.
    """
    keys, names = list(keys), list(names)
    known = df.where(all_present(names))
    rows = known.select(*keys, *[ref(c).cast("double").alias(c) for c in names])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            groups = batch.groupby(keys, sort=False, dropna=False) if keys else [((), batch)]
            out = []
            for key, part in groups:
                x = part[names].to_numpy(dtype=float)
                out.append((*key, len(x), (x.T @ x).ravel()))
            yield pd.DataFrame(out, columns=[*keys, "n", "products"])

    sums = rows.mapInPandas(partial, key_schema(df, keys) + "n long, products array<double>")
    merged = [F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products")]
    return sums.groupBy(*keys).agg(*merged) if keys else sums.agg(*merged).where(F.col("n") > 0)


def solve(gram: np.ndarray, n: int, x: Sequence[int], y: int) -> dict:
    """Least squares of column ``y`` on columns ``x`` of a cross-product matrix.

    Columns are scaled to unit length and the inverse drops null directions, so a
    collinear design gives the minimum-norm solution and reports its rank.
    """
    a, b, yy = gram[np.ix_(x, x)], gram[x, y], gram[y, y]
    k = len(x)
    if not k:
        return {"coef": np.zeros(0), "se": np.zeros(0), "rss": float(yy), "rank": 0, "inverse": np.zeros((0, 0))}
    size = np.sqrt(np.diag(a))
    size[size == 0] = 1.0
    value, vector = np.linalg.eigh(a / np.outer(size, size))
    keep = value > value.max() * 1e-11
    inverse = (vector[:, keep] / value[keep]) @ vector[:, keep].T
    coef = (inverse @ (b / size)) / size
    rss = max(float(yy - 2 * coef @ b + coef @ a @ coef), 0.0)
    dof = max(n - int(keep.sum()), 1)
    cov = (inverse / np.outer(size, size)) * (rss / dof)
    return {"coef": coef, "se": np.sqrt(np.clip(np.diag(cov), 0, None)), "rss": rss, "rank": int(keep.sum()), "inverse": inverse / np.outer(size, size)}


def p_value(coef: float, se: float) -> float | None:
    return erfc(abs(coef / se) / sqrt(2)) if se > 0 else None


def centred_products(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per key: ``n``, ``means`` and ``products``, the sums of products about the means.

    Each Arrow batch is centred on its own means. Merging needs the key's means first,
    then adds to each batch what its distance from them contributes, so columns far from
    zero lose no digits. The batch summaries are a small table, written once.
    """
    keys, names = list(keys), list(names)
    known = df.where(all_present(names))
    rows = known.select(*keys, *[ref(c).cast("double").alias(c) for c in names])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            groups = batch.groupby(keys, sort=False, dropna=False) if keys else [((), batch)]
            out = []
            for key, part in groups:
                x = part[names].to_numpy(dtype=float)
                mean = x.mean(axis=0)
                out.append((*key, len(x), mean, ((x - mean).T @ (x - mean)).ravel()))
            yield pd.DataFrame(out, columns=[*keys, "n", "means", "products"])

    schema = key_schema(df, keys) + "n long, means array<double>, products array<double>"
    parts = cut(rows.mapInPandas(partial, schema), "products")
    totals = F.transform("means", lambda m: m * F.col("n"))
    level = [
        F.sum("n").alias("__n"),
        vector_to_array(Summarizer.sum(array_to_vector(totals))).alias("__sums"),
    ]
    # A constant key where there is none: no rows then give no row instead of an empty sum.
    levels = parts.groupBy(*(keys or [F.lit(0).alias("__all")])).agg(*level)
    levels = levels.select(*keys, F.col("__n"), F.transform("__sums", lambda t: t / F.col("__n")).alias("__means"))

    @F.pandas_udf("array<double>")
    def about(n: pd.Series, own: pd.Series, mean: pd.Series, products: pd.Series) -> pd.Series:
        d = [np.asarray(a) - np.asarray(m) for a, m in zip(own, mean)]
        return pd.Series([np.asarray(p) + k * np.outer(x, x).ravel() for k, x, p in zip(n, d, products)])

    moved = attach(parts, levels, keys).withColumn("products", about("n", "means", "__means", "products"))
    whole = moved.groupBy(*keys, "__n", "__means").agg(
        vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products")
    )
    return whole.select(*keys, F.col("__n").alias("n"), F.col("__means").alias("means"), "products")


def least_squares(
    df: DataFrame, keys: Sequence[str], x: Sequence[str], y: str, intercept: bool = True
) -> DataFrame:
    """One row per key and term: coefficient, standard error, z, p-value, RSS and n.

    With an intercept the slopes come from centred sums and the intercept from the means.
    """
    keys, x = list(keys), list(x)
    names = [*x, y]
    sums = centred_products(df, keys, names)

    def terms(n: int, means: np.ndarray, centred: np.ndarray) -> tuple[dict, list[tuple[str, float, float]]]:
        at = list(range(len(x)))
        if not intercept:
            s = solve(centred + n * np.outer(means, means), n, at, len(x))
            return s, [(t, float(b), float(e)) for t, b, e in zip(x, s["coef"], s["se"])]
        s = solve(centred, n - 1, at, len(x))
        level = means[-1] - s["coef"] @ means[:-1]
        dof = max(n - 1 - s["rank"], 1)
        spread = s["rss"] / dof * (1 / n + means[:-1] @ s["inverse"] @ means[:-1])
        first = (ONE, float(level), float(np.sqrt(max(spread, 0.0))))
        s["rank"] += 1
        return s, [first, *[(t, float(b), float(e)) for t, b, e in zip(x, s["coef"], s["se"])]]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                centred = np.asarray(row.products).reshape(len(names), len(names))
                s, found = terms(int(row.n), np.asarray(row.means), centred)
                for term, b, se in found:
                    label = "intercept" if term == ONE else term
                    z = b / se if se > 0 else None
                    out.append((*row[: len(keys)], label, b, se, z, p_value(b, se), s["rss"], s["rank"], row.n))
            yield pd.DataFrame(out, columns=[*keys, "term", "coef", "se", "z", "p", "rss", "rank", "n"])

    schema = key_schema(df, keys) + "term string, coef double, se double, z double, p double, rss double, rank int, n long"
    return sums.select(*keys, "n", "means", "products").mapInPandas(fit, schema)


def fit_quality(fits: DataFrame, terms: str = "k", rss: str = "rss", n: str = "n") -> DataFrame:
    """Gaussian log-likelihood, AIC and BIC; the variance counts as a parameter."""
    size = F.col(n)
    llf = -size / 2 * (F.log(2 * F.pi()) + F.log(F.col(rss) / size) + 1)
    k = F.col(terms) + 1
    return fits.withColumns({"llf": llf, "aic": -2 * llf + 2 * k, "bic": -2 * llf + k * F.log(size)})


def significant_features(
    coefs: DataFrame, keys: Sequence[str], always: str, threshold: float = 0.10, fewest: int = 3, top: int = 4
) -> DataFrame:
    """Features with p at most the threshold, plus one kept always.

    With fewer than ``fewest`` known p-values the ``top`` largest absolute
    coefficients are taken instead. Features of a model are a short list.
    """
    group = Window.partitionBy(*keys)
    by_size = group.orderBy(F.desc(F.abs("coef")), "term")
    rows = coefs.withColumns({"__known": F.count("p").over(group), "__place": F.row_number().over(by_size)})
    by_p = (F.col("__known") >= fewest) & (F.col("p") <= threshold)
    by_coef = (F.col("__known") < fewest) & (F.col("__place") <= top)
    method = F.when(F.col("__known") >= fewest, "p-value").otherwise("coefficient")
    kept = rows.where(F.coalesce(by_p, F.lit(False)) | by_coef | (F.col("term") == always))
    return kept.select(*keys, "term", "coef", "p", method.alias("method"))
