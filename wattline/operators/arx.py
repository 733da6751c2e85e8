"""Seasonal regression with autoregressive and moving-average terms.

The target and its features are differenced, (1-B)^d (1-B^m)^D. A long
autoregression gives innovations; the final regression uses the features, the
lags of the order and lagged innovations (the two-stage estimator of Hannan and
Rissanen, Biometrika 1982). Innovations are linear in the lagged columns, so both
stages are solved from one matrix of sums over the lag design: one pass over the
data serves every order, feature set and training window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import errors
from wattline.operators.frames import attach, by_date, meet
from wattline.operators.regression import key_schema, p_value, solve

LONG_AR = 28


def lag_set(short: int, seasonal: int, period: int) -> list[int]:
    """Lags with a non-zero weight in the product of two lag polynomials."""
    return sorted({i + period * j for i in range(short + 1) for j in range(seasonal + 1)} - {0})


def difference_weights(d: int, seasonal: int, period: int) -> np.ndarray:
    """Coefficients of (1-B)^d (1-B^m)^D, index = lag."""
    out = np.array([1.0])
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    for _ in range(seasonal):
        out = np.convolve(out, [1.0, *[0.0] * (period - 1), -1.0])
    return out


@dataclass(frozen=True)
class Spec:
    """Orders (p, d, q)(P, D, Q, m), features, and how far the design looks back."""

    order: tuple[int, int, int] = (2, 0, 1)
    seasonal: tuple[int, int, int, int] = (2, 1, 0, 7)
    features: tuple[str, ...] = ()
    long_ar: int = LONG_AR
    design_features: tuple[str, ...] = field(default=())
    design_ma: tuple[int, ...] = field(default=())

    @property
    def ar(self) -> list[int]:
        return lag_set(self.order[0], self.seasonal[0], self.seasonal[3])

    @property
    def ma(self) -> list[int]:
        return lag_set(self.order[2], self.seasonal[2], self.seasonal[3])

    @property
    def weights(self) -> np.ndarray:
        return difference_weights(self.order[1], self.seasonal[1], self.seasonal[3])

    @property
    def wide_features(self) -> list[str]:
        return list(self.design_features or self.features)

    @property
    def ma_columns(self) -> list[int]:
        return sorted(set(self.design_ma) | set(self.ma))

    @property
    def depth(self) -> int:
        """Deepest target lag of the design."""
        return max([self.long_ar + max([0, *self.ma_columns]), *self.ar])

    @property
    def names(self) -> list[str]:
        """Design columns: w0..wK, then the features now and at each innovation lag."""
        lags = [f"w{k}" for k in range(self.depth + 1)]
        return lags + [f"z{j}_{f}" for j in [0, *self.ma_columns] for f in self.wide_features]

    def of(self, **changes) -> Spec:
        """A model inside this design: same columns, other orders or features."""
        keep = {"design_features": tuple(self.wide_features), "design_ma": tuple(self.ma_columns)}
        return replace(self, **(keep | changes))


def difference(c: str, weights: np.ndarray, keys: Sequence[str]) -> Column:
    w = by_date(keys)
    out = F.col(c)
    for lag, weight in enumerate(weights):
        if lag and weight:
            out = out + F.lag(c, lag).over(w) * F.lit(float(weight))
    return out


def design(df: DataFrame, target: str, spec: Spec, keys: Sequence[str] = ()) -> DataFrame:
    """Differenced target, its lags, and the differenced features, on a dense daily series."""
    w = by_date(keys)
    features = spec.wide_features
    base = df.select(
        *keys,
        "date",
        F.col(target).alias("y"),
        *features,
        difference(target, spec.weights, keys).alias("w0"),
        *[difference(f, spec.weights, keys).alias(f"z0_{f}") for f in features],
    )
    return base.select(
        "*",
        (F.row_number().over(w) - 1).alias("pos"),
        *[F.lag("w0", k).over(w).alias(f"w{k}") for k in range(1, spec.depth + 1)],
        *[F.lag(f"z0_{f}", j).over(w).alias(f"z{j}_{f}") for j in spec.ma_columns for f in features],
    )


@dataclass(frozen=True)
class Chosen:
    """A model of ``spec``'s orders whose features a fit of ``spec`` itself picks.

    Kept are those with a p-value of at most ``threshold``, and ``always``. With fewer than
    ``fewest`` known p-values it is the ``top`` largest coefficients, each times the spread of
    its differenced feature.
    """

    spec: Spec
    always: str = "production_mw_lag1"
    threshold: float = 0.10
    fewest: int = 3
    top: int = 4

    @property
    def names(self) -> list[str]:
        return self.spec.names

    def pick(self, fitted: dict, gram: np.ndarray, names: list[str]) -> tuple[list[str], str]:
        """The features, in the order of the design, and what they were picked by."""
        features = self.spec.features
        p = {f: p_value(b, s) for f, b, s in zip(features, fitted["coef"], fitted["se"])}
        if sum(v is not None for v in p.values()) >= self.fewest:
            return [f for f in features if f == self.always or (p[f] is not None and p[f] <= self.threshold)], "p-value"
        size = {f: abs(b) * np.sqrt(gram[i, i]) for f, b in zip(features, fitted["coef"]) for i in [names.index(f"z0_{f}")]}
        largest = sorted(features, key=lambda f: (-size[f], f))[: self.top]
        return [f for f in features if f == self.always or f in largest], "coefficient"


def estimates(gram: np.ndarray, n: int, names: list[str], specs: dict[str, Spec]) -> dict[str, dict]:
    """Both regression stages of every model from the cross-products of the design columns.

    Models of one feature set share the long autoregression and the products of all their
    regressors; each solves its own part of them.
    """
    at = {c: i for i, c in enumerate(names)}
    size, y = len(names), at["w0"]
    groups: dict[tuple, list[str]] = {}
    for model, spec in specs.items():
        groups.setdefault((spec.features, spec.long_ar if spec.ma else 0), []).append(model)
    found = {}
    for (features, long_ar), models in groups.items():
        now = [at[f"z0_{f}"] for f in features]
        ar = sorted({k for m in models for k in specs[m].ar})
        ma = sorted({k for m in models for k in specs[m].ma})
        innovation = np.zeros(size)
        stage = np.zeros((len(ma), size))
        if ma:
            lags = [at[f"w{k}"] for k in range(1, long_ar + 1)]
            first = solve(gram, n, now + lags, y)["coef"]
            long_beta, long_phi = first[: len(now)], first[len(now) :]
            innovation[now], innovation[lags] = long_beta, long_phi
            for i, j in enumerate(ma):
                stage[i, at[f"w{j}"]] += 1.0
                for f, b in zip(features, long_beta):
                    stage[i, at[f"z{j}_{f}"]] -= b
                for lag, a in enumerate(long_phi, 1):
                    stage[i, at[f"w{j + lag}"]] -= a
        direct = now + [at[f"w{k}"] for k in ar]
        pick = np.zeros((len(direct) + 1, size))
        pick[np.arange(len(direct) + 1), [*direct, y]] = 1.0
        basis = np.vstack([pick[:-1], stage, pick[-1:]])
        place = {t: i for i, t in enumerate([*features, *[f"ar{k}" for k in ar], *[f"ma{k}" for k in ma]])}
        small = basis @ gram @ basis.T
        for m in models:
            terms = [*features, *[f"ar{j}" for j in specs[m].ar], *[f"ma{j}" for j in specs[m].ma]]
            own = [place[t] for t in terms]
            out = solve(small, n, own, len(basis) - 1)
            found[m] = out | {"terms": terms, "k": len(terms), "predictor": out["coef"] @ basis[own], "innovation": innovation}
    return found


FIT_SCHEMA = (
    "model string, n long, k int, rank int, rss double, tss double, terms array<string>, coef array<double>, "
    "se array<double>, p array<double>, predictor array<double>, innovation array<double>, features array<string>, method string"
)
#: Column of sums with the features a model was given, by its name.
GIVEN = "chosen"


def fit(sums: DataFrame, specs: dict[str, Spec | Chosen], keys: Sequence[str] = ()) -> DataFrame:
    """One row per key and model from the cross-product sums of a shared design.

    A ``Chosen`` model takes the features that a column ``chosen`` (model to list) gives it,
    else those it picks from the same sums. ``features`` are the ones used.
    """
    keys = list(keys)
    names = next(iter(specs.values())).names
    columns = [*keys, *[c.split()[0] for c in FIT_SCHEMA.split(", ")]]
    given = [GIVEN] if GIVEN in sums.columns else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, (n, g) in enumerate(zip(batch["n"], batch["products"])):
                key = tuple(batch[c].iloc[i] for c in keys)
                gram = np.asarray(g).reshape(len(names), len(names))
                listed = dict(batch[GIVEN].iloc[i] or {}) if given else {}
                whole = {m: s for m, s in specs.items() if isinstance(s, Spec)}
                ask = {m: s for m, s in specs.items() if isinstance(s, Chosen) and m not in listed}
                probes = estimates(gram, int(n), names, {m: s.spec for m, s in ask.items()}) if ask else {}
                picks = {m: s.pick(probes[m], gram, names) for m, s in ask.items()}
                picks |= {m: (list(f), "given") for m, f in listed.items() if m in specs}
                whole |= {m: specs[m].spec.of(features=tuple(f)) for m, (f, _) in picks.items()}
                solved = estimates(gram, int(n), names, whole)
                for model in specs:
                    e = solved[model]
                    p = [p_value(b, s) for b, s in zip(e["coef"], e["se"])]
                    out.append(
                        (*key, model, int(n), e["k"], e["rank"], e["rss"], float(gram[0, 0]), e["terms"])
                        + (e["coef"], e["se"], p, e["predictor"], e["innovation"])
                        + (list(whole[model].features), picks[model][1] if model in picks else None)
                    )
            yield pd.DataFrame(out, columns=columns)

    return sums.select(*keys, "n", "products", *given).mapInPandas(run, key_schema(sums, keys) + FIT_SCHEMA)


def dot(names: Sequence[str], weights: str) -> Column:
    """Design row times a coefficient array; unknown cells count only when their weight is zero."""
    return weighted(F.array(*[F.col(c) for c in names]), F.col(weights))


def weighted(cells: Column, weights: Column) -> Column:
    terms = F.zip_with(cells, weights, lambda v, b: F.when(b == 0.0, 0.0).otherwise(v * b))
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


def one_step(rows: DataFrame, spec: Spec, weights: str = "predictor") -> Column:
    """One-step prediction on the level: what differencing took away, plus the regression."""
    return (F.col("y") - F.col("w0")) + dot(spec.names, weights)


def fitted(rows: DataFrame, fits: DataFrame, spec: Spec, keys: Sequence[str] = ()) -> DataFrame:
    """In-sample frame: actual, fitted and error columns for every day the design covers."""
    known = fits.select(*keys, "model", "predictor")
    if keys:
        joined = meet(rows, known, keys)
    else:
        listed = known.agg(F.collect_list(F.struct("model", "predictor")).alias("__fits"))
        joined = attach(rows, listed).select(*rows.columns, F.inline("__fits"))
    out = joined.select(*keys, "model", "date", F.col("y").alias("actual"), one_step(rows, spec).alias("fitted"))
    out = out.where(F.col("fitted").isNotNull() & F.col("actual").isNotNull())
    return out.withColumns(errors(F.col("actual"), F.col("fitted"))).withColumns(
        {"residual": F.col("actual") - F.col("fitted"), "month": F.month("date"), "dow": F.weekday("date")}
    )


def origin_rows(rows: DataFrame, spec: Spec, horizon: int, keys: Sequence[str] = ()) -> DataFrame:
    """What a forecast from each day needs: recent history and the known future, as arrays.

    All arrays come from lag and lead over the daily series, bounded by the design
    depth and the horizon.
    """
    w = by_date(keys)
    features = spec.wide_features
    back = max([1, *spec.ma_columns])
    steps = range(1, horizon + 1)

    def array(cells: list[Column]) -> Column:
        return F.array(*cells) if cells else F.array().cast("array<double>")

    return rows.select(
        *keys,
        F.col("date").alias("start_date"),
        "pos",
        array([F.lag("y", i).over(w) for i in range(len(spec.weights) - 1)]).alias("y_past"),
        array([F.lag("w0", i).over(w) for i in range(back + spec.long_ar)]).alias("w_past"),
        array([F.lag(f"z0_{f}", i).over(w) for i in range(back) for f in features]).alias("z_past"),
        array([F.lead(f"z0_{f}", h).over(w) for h in steps for f in features]).alias("z_next"),
        array([F.lead("y", h).over(w) for h in steps]).alias("y_next"),
    )


def forecast(
    origins: DataFrame, spec: Spec, horizon: int, specs: dict[str, Spec | Chosen], keys: Sequence[str] = ()
) -> DataFrame:
    """Recursive forecast of ``horizon`` days from every origin row joined with a fit.

    Predictions feed the later lags; the recursion runs over the horizon for a whole
    batch of origins at once. An origin whose history or future is incomplete gives
    rows with a null prediction, not silence.
    """
    keys = list(keys)
    width = len(spec.wide_features)
    deltas = spec.weights[1:]
    column_at = {c: i for i, c in enumerate(spec.wide_features)}

    def stack(cells: pd.Series, size: int) -> np.ndarray:
        return np.array([np.asarray(c, dtype=float) for c in cells]).reshape(len(cells), size)

    def predict(part: pd.DataFrame, model: Spec) -> np.ndarray:
        n, use = len(part), [column_at[f] for f in model.features]
        back = max([1, *spec.ma_columns])
        y = stack(part["y_past"], len(deltas))
        w = stack(part["w_past"], back + spec.long_ar)
        z_past = stack(part["z_past"], back * width).reshape(n, back, width)[:, :, use]
        z_next = stack(part["z_next"], horizon * width).reshape(n, horizon, width)[:, :, use]
        names = {c: i for i, c in enumerate(spec.names)}
        terms = [*model.features, *[f"ar{j}" for j in model.ar], *[f"ma{j}" for j in model.ma]]
        table = stack(part["coef"], len(terms))
        coef = {t: table[:, i] for i, t in enumerate(terms)}
        beta = np.column_stack([coef[f] for f in model.features]) if model.features else np.zeros((n, 0))
        inn = stack(part["innovation"], len(spec.names))
        long_beta = inn[:, [names[f"z0_{f}"] for f in model.features]]
        long_phi = inn[:, [names[f"w{k}"] for k in range(1, spec.long_ar + 1)]]
        e = {}
        for s in range(back if model.ma else 0):
            past = w[:, s + 1 : s + 1 + spec.long_ar]
            e[-s] = w[:, s] - (z_past[:, s] * long_beta).sum(1) - (past * long_phi).sum(1)
        level = {-i: y[:, i] for i in range(y.shape[1])}
        diff = {-i: w[:, i] for i in range(w.shape[1])}
        out = np.empty((n, horizon))
        for h in range(1, horizon + 1):
            step = (z_next[:, h - 1] * beta).sum(1)
            for j in model.ar:
                step = step + coef[f"ar{j}"] * diff[h - j]
            for j in model.ma:
                if h - j <= 0:
                    step = step + coef[f"ma{j}"] * e[h - j]
            diff[h] = step
            level[h] = step - sum(d * level[h - i] for i, d in enumerate(deltas, 1) if d)
            out[:, h - 1] = level[h]
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            used = batch["features"].map(tuple)
            for (model, features), part in batch.groupby(["model", used], sort=False):
                rule = specs[model]
                predicted = predict(part, rule.spec.of(features=features) if isinstance(rule, Chosen) else rule)
                actual = stack(part["y_next"], horizon)
                n = len(part)
                out = {k: np.repeat(part[k].to_numpy(), horizon) for k in [*keys, "model", "start_date"]}
                out["horizon"] = np.tile(np.arange(1, horizon + 1), n)
                out["actual"], out["predicted"] = actual.ravel(), predicted.ravel()
                yield pd.DataFrame(out)

    schema = key_schema(origins, keys) + "model string, start_date date, horizon int, actual double, predicted double"
    needed = [*keys, "model", "start_date", "y_past", "w_past", "z_past", "z_next", "y_next", "coef", "innovation", "features"]
    rows = origins.select(*needed).mapInPandas(run, schema)
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c in ("actual", "predicted")}
    error = F.col("predicted") - F.col("actual")
    return rows.withColumns(clean).withColumns(
        {"target_date": F.date_add("start_date", F.col("horizon")), "error": error, "abs_error": F.abs(error)}
    )
