"""Small plan-building helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattline.session import cut


def ref(name: str) -> Column:
    """Column by its exact name, dots included ("Ech. physiques")."""
    return F.col(f"`{name}`")


def by_date(keys: Sequence[str] = (), date: str = "date") -> WindowSpec:
    """Window over one daily series.

    The input holds at most one row per (keys, date), so a partition is bounded
    by the calendar (36,525 rows for a century) however large the raw data is.
    """
    return Window.partitionBy(*keys).orderBy(date)


def meet(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join by keys in which a null key meets a null key, as it does in ``groupBy``.

    ``left`` and ``right`` share no columns but the keys, which come from ``left``.
    """
    named = {k: f"__meet_{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(named)
    same = F.lit(True)
    for k, n in named.items():
        same = same & ref(k).eqNullSafe(ref(n))
    return left.join(other, same, how).drop(*named.values())


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add the columns of ``stats`` (one row per key) to every row of ``df``.

    With keys this is an equi-join; rows whose key is null belong to the null group.
    Without keys ``stats`` is a single row and becomes a scalar subquery, evaluated once,
    so no cross join is planned.
    """
    if keys:
        return meet(df, stats, keys, "left")
    names = stats.columns
    one = stats.select(F.struct(*names)).scalar()
    return df.withColumn("__one", one).select(
        *df.columns, *[F.col("__one")[c].alias(c) for c in names]
    )


def attach_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``attach`` for statistics of a table too large to shuffle.

    The statistics are written first, so the planner knows their size when it plans the
    join: below its broadcast limit no row of ``df`` moves, above it they meet by key.
    """
    return attach(df, cut(stats, "statistics"), keys)


def grouped(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Aggregate by keys, or over the whole frame when there are none."""
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def one_of_each(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Fail the job when a key repeats, else pass the rows through.

    The count is an aggregate on the join key, so a following join on the same
    key reuses its partitioning, and a hot repeated key collapses map-side.
    """
    rest = [c for c in df.columns if c not in keys]
    checked = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*rest)).alias("__row")
    )
    guard = F.when(
        F.col("__n") > 1,
        F.raise_error(F.lit(f"{label}: key is not unique")).cast(checked.schema["__row"].dataType),
    ).otherwise(F.col("__row"))
    return checked.select(*keys, guard.alias("__row")).select(*keys, "__row.*")


#: Names (stations, columns, header layouts) that a plan or the driver may hold as one list.
MOST_NAMES = 100_000


def bounded(names: Column, what: str) -> Column:
    """A collected list of names, or an error that says which list has outgrown its bound."""
    error = F.raise_error(F.lit(f"more than {MOST_NAMES} {what}"))
    return F.when(F.size(names) > MOST_NAMES, error).otherwise(names)


def listed(names: DataFrame, what: str) -> list[str]:
    """The one column of a short frame on the driver; a named error beyond the bound."""
    rows = names.limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} {what}")
    return [r[0] for r in rows]


def all_present(columns: Sequence[str]) -> Column:
    """Every column has a value, as one conjunct per column.

    ``dropna`` builds a single predicate over all columns, which the optimizer
    rewrites once per subset of computed columns; conjuncts stay linear.
    """
    out = F.lit(True)
    for c in columns:
        out = out & ref(c).isNotNull()
    return out
