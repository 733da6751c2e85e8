"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

SPANS = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
BLOCK = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names, so that no other column can clash."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, x: acc + x)


def sums_before(lengths: Column) -> Column:
    """For each entry of an int array the sum of the entries before it.

    Sums of blocks first, then within the block, so a text with m matches costs
    about m * BLOCK steps and not m squared.
    """

    def by_block(numbers: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
            lambda b: total(F.slice(numbers, (b * BLOCK + 1).cast("int"), F.lit(BLOCK))),
        )
        starts = bind(
            blocks,
            lambda sums: F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b))),
        )
        return bind(
            starts,
            lambda base: F.transform(
                numbers,
                lambda _, i: base[F.floor(i / BLOCK).cast("int")]
                + total(F.slice(numbers, i - i % BLOCK + 1, i % BLOCK)),
            ),
        )

    return F.when(F.size(lengths) > 0, bind(lengths, by_block)).otherwise(F.array().cast("array<int>"))


def match_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, value, before, after>>.

    Offsets count code points, ``end`` is exclusive. ``before`` and ``after`` are the
    stretches between this match and its neighbours. The lengths of the stretches give
    the offsets, so whole texts are read a fixed number of times.
    """

    def spans(pair: Column) -> Column:
        values, between = pair["values"], pair["between"]
        advance = F.transform(values, lambda v, i: F.length(v) + F.length(between[i]))
        return bind(
            sums_before(advance),
            lambda at: F.transform(
                values,
                lambda v, i: F.struct(
                    (at[i] + F.length(between[i])).alias("start"),
                    (at[i] + F.length(between[i]) + F.length(v)).alias("end"),
                    v.alias("value"),
                    between[i].alias("before"),
                    between[i + 1].alias("after"),
                ),
            ),
        )

    pair = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
        F.split(text, pattern, -1).alias("between"),
    )
    return F.when(text.rlike(pattern), bind(pair, spans)).otherwise(F.array().cast(SPANS))
