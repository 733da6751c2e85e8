"""Order-dependent operators over series of any length.

A file or source may hold a third of all rows, so no window here spans a whole
one. Rows carry a ``chunk`` (a bounded slice in order, such as a file block) and
an ``order`` within it. Work inside a chunk is a bounded window; what crosses
chunk borders is one summary row per chunk, scanned in order and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.frames import meet, ref
from wattline.session import cut

CHUNK_ROWS = 1 << 18
#: Rows of a series that one task works on, besides those it looks back or ahead at.
SERIES_ROWS = 1 << 16
#: Rows of one value that one task opens.
RUN_ROWS = 1 << 16


def with_chunk(df: DataFrame, order: str, rows: int = CHUNK_ROWS, name: str = "chunk") -> DataFrame:
    """Slice a dense numeric order into chunks of ``rows``."""
    return df.withColumn(name, F.floor(F.col(order) / F.lit(rows)).cast("long"))


def positions(
    df: DataFrame, keys: Sequence[str], chunk: str, order: str, name: str = "pos"
) -> DataFrame:
    """0-based row position within each key, without one task per key."""
    across = Window.partitionBy(*keys).orderBy(chunk)
    starts = (
        df.groupBy(*keys, chunk)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, chunk, (F.sum("__n").over(across) - F.col("__n")).alias("__start"))
    )
    inside = Window.partitionBy(*keys, chunk).orderBy(order)
    return (
        meet(df, starts, [*keys, chunk])
        .withColumn(name, F.col("__start") + F.row_number().over(inside) - 1)
        .drop("__start")
    )


def range_chunks(df: DataFrame, keys: Sequence[str], order: str, name: str = "chunk") -> DataFrame:
    """Rows with the slice of their key's order that they lie in, written once.

    Spark cuts the rows into even ranges, so a slice is a partition's size however long a
    series is; the slices of a key ascend with its order.
    """
    spread = df.repartitionByRange(*[ref(k) for k in keys], ref(order))
    return cut(spread.withColumn(name, F.spark_partition_id()), name)


def series_blocks(
    df: DataFrame, keys: Sequence[str], order: str, back: Column | int = 0, ahead: Column | int = 0, rows: int | None = None
) -> DataFrame:
    """Rows of each series in blocks: ``pos`` (0-based), ``block``, and ``own``.

    A block has the rows it owns, and copies of the ``back`` rows before and the ``ahead``
    rows after them, so a window over (keys, block) sees what its own rows ask for. Both may
    be columns that are constant in a key; a block is never shorter than either.
    """
    back, ahead = (F.lit(c) if isinstance(c, int) else c for c in (back, ahead))
    placed = positions(range_chunks(df, keys, order), keys, "chunk", order).drop("chunk")
    size = F.greatest(F.lit(rows or SERIES_ROWS), back, ahead)
    block = F.floor(F.col("pos") / size).cast("long")
    inside = F.pmod(F.col("pos"), size)

    def stands(at: Column, own: bool, when: Column) -> Column:
        return F.when(when, F.struct(at.alias("block"), F.lit(own).alias("own")))

    places = F.array(
        stands(block, True, F.lit(True)),
        stands(block + 1, False, inside >= size - back),
        stands(block - 1, False, (inside < ahead) & (block > 0)),
    )
    return placed.select("*", F.inline(F.filter(places, lambda p: p.isNotNull())))


def ranked_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, value, first, n, total``: each distinct value, its rows' first 0-based rank, their number.

    Equal values fall together first; ranges of the distinct ones are counted, and their
    totals, one row each, give the ranks across ranges. No window spans a whole group.
    """
    keys = list(keys)
    counted = df.where(ref(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    chunks = range_chunks(counted, keys, value)
    across = Window.partitionBy(*keys).orderBy("chunk")
    sums = chunks.groupBy(*keys, "chunk").agg(F.sum("n").alias("__n"))
    starts = sums.select(
        *keys,
        "chunk",
        (F.sum("__n").over(across) - F.col("__n")).alias("__start"),
        F.sum("__n").over(Window.partitionBy(*keys)).alias("total"),
    )
    inside = Window.partitionBy(*keys, "chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("__start") + F.sum("n").over(inside) - F.col("n")
    return meet(chunks, starts, [*keys, "chunk"]).select(*keys, value, first.alias("first"), "n", "total")


def opened(ranked: DataFrame, name: str = "pos") -> DataFrame:
    """One row per row behind ``ranked_values``, with its rank; a value of very many rows is opened by several tasks."""
    last = F.col("first") + F.col("n") - 1
    runs = ranked.withColumn("__run", F.explode(F.sequence(F.col("first"), last, F.lit(RUN_ROWS).cast("long"))))
    spread = runs.repartition("__run")
    rank = F.explode(F.sequence(F.col("__run"), F.least(F.col("__run") + RUN_ROWS - 1, last)))
    return spread.withColumn(name, rank).drop("__run")


def fill(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: str,
    columns: Sequence[str],
    direction: str = "backward",
) -> DataFrame:
    """Unlimited backward or forward fill of ``columns`` in row order."""
    if not columns:
        return df
    back = direction == "backward"
    edge = F.min_by if back else F.max_by
    summary = df.groupBy(*keys, chunk).agg(
        *[edge(ref(c), F.when(ref(c).isNotNull(), F.col(order))).alias(f"__edge_{c}") for c in columns]
    )
    across = Window.partitionBy(*keys).orderBy(F.desc(chunk) if back else F.asc(chunk))
    beyond = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys, chunk, *[F.last(ref(f"__edge_{c}"), True).over(beyond).alias(f"__edge_{c}") for c in columns]
    )
    inside = Window.partitionBy(*keys, chunk).orderBy(F.desc(order) if back else F.asc(order))
    seen = inside.rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.coalesce(F.last(ref(c), True).over(seen), ref(f"__edge_{c}")) for c in columns}
    return (
        meet(df, carried, [*keys, chunk], "left")
        .withColumns(filled)
        .drop(*[f"__edge_{c}" for c in columns])
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keyed de-duplication that keeps the last row in file order.

    An aggregate with map-side combine, so a key repeated a billion times
    reaches the reducer as one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*[ref(c) for c in rest]), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(last).select(*keys, "__row.*").select(*[ref(c) for c in df.columns])
