"""Station temperature files: ``;``-separated text after nine metadata lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.columns import STATION_NULLS, null_tokens
from wattline.functions.grid_rules import NUMBER
from wattline.operators.ordered import keep_last
from wattline.session import cut
from wattline.sources.lines import (
    fail_when_all_rejected,
    read_lines,
    split_rejects,
    with_line_number,
)

STATION_IN_NAME = r"(\d{9})\.csv$"
METADATA_LINES = 9
DAY, VALUE = "AAAAMMJJ", "VALEUR"


@dataclass
class StationRows:
    """Long rows ``date, station, variable, value`` and the files left out."""

    rows: DataFrame
    rejects: DataFrame


def cell(line: Column, header: Column, name: str) -> Column:
    at = F.array_position(F.split(header, ";"), name).cast("int")
    return F.trim(F.try_element_at(F.split(line, ";"), F.when(at > 0, at)))


def read_station_files(
    spark: SparkSession,
    path: str | list[str],
    variable: str,
    glob: str | None = None,
    station_pattern: str = STATION_IN_NAME,
) -> StationRows:
    """Read one variable's folder; a file with a bad name, header or value is skipped whole.

    The text is read once, into a table of lines that numbering, verdict and rows share.
    """
    raw = cut(read_lines(spark, path, glob), "station-lines")
    line = F.regexp_replace("line", "\r$", "")
    lines = with_line_number(raw).withColumn("line", line).where(F.col("line_no") >= METADATA_LINES)
    header = F.max(F.when(F.col("line_no") == METADATA_LINES, F.col("line"))).alias("header")
    headers = lines.groupBy("path").agg(header)
    number = null_tokens(F.col("value_text"), STATION_NULLS)
    body = (
        lines.where((F.col("line_no") > METADATA_LINES) & (F.col("line") != ""))
        .join(headers, "path")
        .withColumn("value_text", cell(F.col("line"), F.col("header"), VALUE))
        .select(
            "path",
            "chunk",
            "row",
            F.try_to_timestamp(cell(F.col("line"), F.col("header"), DAY), F.lit("yyyyMMdd"))
            .cast("date")
            .alias("date"),
            F.when(number.rlike(NUMBER), number.try_cast("double")).alias("value"),
            (number.isNotNull() & ~number.rlike(NUMBER)).alias("bad"),
        )
    )
    bad = body.groupBy("path").agg(F.bool_or("bad").alias("bad"))
    station = F.regexp_extract("path", station_pattern, 1)
    names = F.split("header", ";")
    judged = headers.join(bad, "path", "left").select(
        "path",
        station.alias("station"),
        F.when(station == "", "no station id in file name")
        .when(F.col("header").isNull() | ~F.array_contains(names, DAY) | ~F.array_contains(names, VALUE), "no header")
        .when(F.col("bad"), "value is not a number")
        .alias("reason"),
    )
    verdict = cut(judged, "station-files")
    fail_when_all_rejected(verdict, "station")
    good, rejects = split_rejects(verdict, verdict)
    dated = body.where(F.col("date").isNotNull()).join(good.select("path"), "path", "left_semi")
    last = keep_last(dated.select("path", "date", "chunk", "row", "value"), ["path", "date"], ["chunk", "row"])
    named = last.withColumn("station", F.regexp_extract("path", station_pattern, 1))
    rows = named.select("date", "station", F.lit(variable).alias("variable"), F.col("value").cast("float").alias("value"))
    return StationRows(rows, rejects.select("path", "reason"))
