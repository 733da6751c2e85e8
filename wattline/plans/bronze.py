"""Raw files to bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import build_stamp
from wattline.functions.grid_rules import alternating, as_variants, coerce_per_file, column_facts, half_missing
from wattline.operators.frames import listed, ref
from wattline.operators.joins import wide_by_station
from wattline.operators.ordered import fill, positions
from wattline.session import cut
from wattline.sources.grid_files import GridText, drop_place


def backfill_alternating(
    df: DataFrame, columns: list[str], file: str = "path", facts: DataFrame | None = None
) -> DataFrame:
    """Backward fill, file by file, of the columns missing on every other row of that file.

    Rows are numbered only where some file's share of gaps leaves the question open, and
    only gaps travel with the numbers. ``facts`` of ``column_facts`` spare the pass that
    measures the shares.
    """
    if facts is None:
        facts = df.groupBy(file).agg(*[half_missing(c).alias(f"__half_{c}") for c in columns])
    likely = facts.agg(*[F.bool_or(ref(f"__half_{c}")).alias(c) for c in columns]).first() if columns else {}
    columns = [c for c in columns if likely[c]]
    if not columns:
        return df
    gaps = [F.when(ref(c).isNotNull(), True).alias(c) for c in columns]
    placed = positions(df.select(file, "chunk", "row", *gaps), [file], "chunk", "row")
    flags = cut(placed.groupBy(file).agg(*[alternating(c).alias(f"__alt_{c}") for c in columns]), "gap-flags")
    anywhere = flags.agg(*[F.bool_or(ref(f"__alt_{c}")).alias(c) for c in columns]).first()
    chosen = [c for c in columns if anywhere[c]]
    if not chosen:
        return df
    kept = df.withColumns({f"__raw_{c}": ref(c) for c in chosen})
    filled = fill(kept, [file], "chunk", "row", chosen, "backward").join(
        flags.select(file, *[ref(f"__alt_{c}") for c in chosen]), file
    )
    back = {c: F.when(ref(f"__alt_{c}"), ref(c)).otherwise(ref(f"__raw_{c}")) for c in chosen}
    return filled.withColumns(back).select(*[ref(c) for c in df.columns])


def grid_rows(text: GridText) -> DataFrame:
    """Typed, back-filled and stamped grid rows of all years; equal rows are all there.

    A statistics job chooses columns from the data, so the parsed text is cut
    to a table first and read from there.
    """
    cells = cut(text.cells, "grid-cells", "zstd")
    facts = cut(column_facts(cells, text.columns, "path"), "column-facts")
    typed = coerce_per_file(cells, facts, text.columns, "path")
    filled = backfill_alternating(typed, [c for c in text.columns if c in typed.columns], "path", facts)
    present = set(filled.columns)
    stamped = build_stamp(filled, *(c if c in present else None for c in (text.day, text.hour)))
    return drop_place(stamped)


def grid_bronze(text: GridText) -> DataFrame:
    """Typed, back-filled, stamped and de-duplicated grid rows of all years.

    A column that is numeric in some files and text in others is a VARIANT column.
    """
    return as_variants(grid_rows(text).dropDuplicates())


#: Values that rows of one year, or of one timestamp, are spread by.
SPREAD = 1 << 16


def grid_bronze_for_sink(text: GridText) -> DataFrame:
    """``grid_bronze`` as a sink of one folder per year wants it."""
    return as_variants(distinct_for_sink(grid_rows(text)))


def distinct_for_sink(rows: DataFrame) -> DataFrame:
    """Each row once, as a sink of one folder per year wants them: each task a stretch of one year or two, in order.

    Stretches are even, so tasks follow the rows and not the years. Inside a year, and
    inside a timestamp, rows are spread by a hash. All of it is equal in equal rows, which
    so come together in one stretch: rows are shuffled once, for both the order and the
    de-duplication. Copies of a row meet in one task, which keeps one of them as they pass.
    """
    stamp = ["timestamp"] if "timestamp" in rows.columns else []
    spread = F.pmod(F.hash(*[ref(c) for c in rows.columns]), F.lit(SPREAD))
    ranged = rows.withColumn("__spread", spread).repartitionByRange("source_year", *stamp, "__spread")
    order = [F.asc_nulls_last(c) for c in ("source_year", *stamp)]
    return ranged.dropDuplicates().sortWithinPartitions(*order).drop("__spread")


def sorted_for_sink(bronze: DataFrame) -> DataFrame:
    """Global order of the sink: timestamp (nulls last), then year; year alone without a timestamp."""
    order = [F.asc("source_year")]
    if "timestamp" in bronze.columns:
        order = [F.asc_nulls_last("timestamp"), *order]
    return bronze.orderBy(*order)


def station_bronze(low: DataFrame, high: DataFrame) -> DataFrame:
    """Long bronze of both variables."""
    return low.unionByName(high)


def station_bronze_wide(long: DataFrame) -> DataFrame:
    """One float column per variable and station; the station list is bounded."""
    name = F.concat_ws("_", "variable", "station")
    names = listed(long.select(name.alias("n")).distinct(), "station columns")
    return wide_by_station(long, sorted(names), name)
