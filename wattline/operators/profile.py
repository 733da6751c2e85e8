"""Table profiles: nulls, ranges, describe, correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.frames import grouped, ref
from wattline.operators.quantiles import exact_quantiles


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type, null count and null rate per column; all columns in one aggregate."""
    types = dict(df.dtypes)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("dtype"),
                F.count_if(ref(c).isNull()).alias("n_null"),
                F.avg(ref(c).isNull().cast("double")).alias("null_rate"),
            )
            for c in columns
        ]
    )
    return df.agg(cells.alias("cells")).select(F.inline("cells"))


def table_summary(df: DataFrame, date: str = "date") -> DataFrame:
    """Date range, rows and distinct dates as (item, value) rows."""
    one = df.agg(
        F.min(date).cast("string").alias("date_min"),
        F.max(date).cast("string").alias("date_max"),
        F.count(F.lit(1)).cast("string").alias("n_rows"),
        F.count_distinct(date).cast("string").alias("n_dates"),
    )
    return one.unpivot([], one.columns, "item", "value")


def describe(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max for groups of any size."""
    both = exact_quantiles(
        df,
        keys,
        value,
        [0.25, 0.5, 0.75],
        "__q",
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quart = [F.col("__q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    return both.select(*keys, "count", "mean", "std", "min", *quart, "max")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form; each pair uses the rows where both are present."""

    def pair(a: str, b: str):
        both = ref(a).isNotNull() & ref(b).isNotNull()
        return F.corr(F.when(both, ref(a)), F.when(both, ref(b)))

    upper = {(a, b): pair(a, b) for i, a in enumerate(columns) for b in columns[i:]}
    one = df.agg(*[c.alias(f"{a}|{b}") for (a, b), c in upper.items()])
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("a"),
                F.lit(b).alias("b"),
                ref(f"{a}|{b}" if (a, b) in upper else f"{b}|{a}").alias("r"),
            )
            for a, b in product(columns, columns)
        ]
    )
    return one.select(F.inline(cells))
