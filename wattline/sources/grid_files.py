"""Yearly grid files: tab-separated text of untyped cells."""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.columns import GRID_NULLS, READER_NULLS, clean_name, null_tokens
from wattline.operators.frames import listed, ref
from wattline.session import cut
from wattline.sources.lines import blocks_of, decoded, describe_files, fail_when_all_rejected, joined_records, read_lines

YEAR_IN_NAME = r"(\d{4})\.xls$"
PLACE = ["path", "source_file", "chunk", "row", "source_year"]


@dataclass
class GridText:
    """Cells as text with their place in the files, and the files left out."""

    cells: DataFrame
    columns: list[str]
    rejects: DataFrame
    day: str | None = None
    hour: str | None = None


def read_grid_text(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = "eCO2mix_RTE_Annuel-Definitif_*.xls",
    year_pattern: str = YEAR_IN_NAME,
    blocks: str | None = None,
) -> GridText:
    """Read every file of a folder, skipping the unreadable ones.

    The text is read once, into a table of lines. One pass over that table describes the
    files (encoding, header, verdict), one more parses all layouts together: each line is
    split once, and a column takes its cell from the place that its file's header gives it.
    Files with line breaks inside quoted cells have their lines joined to records first; one
    whose last quote stays open is left out. ``blocks`` is the size of the pieces a file is
    read in, the session's where it is not given.
    """
    with blocks_of(spark, blocks):
        raw = cut(read_lines(spark, path, glob), "grid-lines", "zstd")
    described = cut(describe_files(raw), "grid-text")
    spanning = described.where("spans").select("path")
    unclosed = spanning.where("false")
    if not spanning.isEmpty():
        records, unclosed = joined_records(raw.join(spanning, "path", "left_semi"))
        unclosed = cut(unclosed, "grid-unclosed")
        raw = raw.join(spanning, "path", "left_anti").unionByName(records)
        described = describe_files(raw)
    year = F.regexp_extract("path", year_pattern, 1).try_cast("int")
    reason = (
        F.when(F.col("source_year").isNull(), "no year in file name")
        .when(F.col("open"), "a quote is never closed")
        .when(~F.col("header").contains("\t"), "fewer than two columns")
    )
    judged = described.join(unclosed.withColumn("open", F.lit(True)), "path", "left").withColumn("source_year", year)
    files = cut(judged.withColumn("reason", reason).drop("open", "spans"), "grid-files")
    fail_when_all_rejected(files, "yearly grid")
    good, rejects = files.where(F.col("reason").isNull()), files.where(F.col("reason").isNotNull())
    layouts = listed(good.select("header").distinct(), "header layouts")
    after_header = F.struct("chunk", "row") > F.struct("first.chunk", "first.row")
    body = (
        raw.join(good.drop("source_file", "reason"), "path")
        .where(after_header & (F.col("line") != ""))
        .withColumn("line", decoded(F.col("line")))
    )
    columns = {header: clean_header(header) for header in sorted(layouts)}
    names = list(dict.fromkeys(c for listed in columns.values() for c in listed))
    day = next((c for c in names if "date" in c.lower()), None)
    hour = next((c for c in names if "heure" in c.lower() or "hour" in c.lower()), None)
    return GridText(parse_layouts(body, columns, names), names, rejects.select("path", "source_file", "reason"), day, hour)


def clean_header(header: str) -> list[str]:
    """Trimmed names; a repeated name gets a numeric suffix."""
    seen: dict[str, int] = {}
    out = []
    for i, cell in enumerate(next(csv.reader(io.StringIO(header, newline=""), delimiter="\t"), [])):
        name = clean_name(cell)
        if len(name) > 1 and name[0] == name[-1] == '"':
            name = clean_name(name[1:-1])
        name = name or f"Unnamed: {i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(name if n == 0 else f"{name}.{n}")
    return out


def parse_layouts(body: DataFrame, layouts: dict[str, list[str]], names: list[str]) -> DataFrame:
    """Lines of all layouts as named text cells; null tokens become null.

    Rows of null tokens only are dropped on the line itself, before it is parsed.
    """
    width = max(map(len, layouts.values()))
    schema = ", ".join(f"`{i}` string" for i in range(width))
    cells = F.from_csv("line", schema, {"sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    tokens = GRID_NULLS + READER_NULLS
    some = F.exists(F.split("line", "\t"), lambda c: ~F.replace(c, F.lit('"'), F.lit("")).isin(tokens))
    number = F.create_map(*[F.lit(x) for i, h in enumerate(layouts) for x in (h, i)])

    def cell(name: str) -> Column:
        """The cell at each layout's place for the name; layouts with the same place share a case."""
        places: dict[int, list[int]] = {}
        for i, columns in enumerate(layouts.values()):
            if name in columns:
                places.setdefault(columns.index(name), []).append(i)
        found = [F.when(F.col("__layout").isin(who), F.col("__c")[str(at)]) for at, who in places.items()]
        return null_tokens(F.coalesce(*found), tokens).alias(name)

    return (
        body.where(some)
        .withColumns({"__c": cells, "__layout": F.element_at(number, F.col("header"))})
        .select(*PLACE, *[cell(c) for c in names])
    )


def drop_place(df: DataFrame, keep: tuple[str, ...] = ("source_year",)) -> DataFrame:
    return df.select(*[ref(c) for c in df.columns if c in keep or c not in (*PLACE, "pos")])
