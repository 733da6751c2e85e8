"""Text files as rows of lines, split across tasks, with their order kept.

Files are read in blocks, so one huge file is many tasks. A line carries its
file, the block it lies in (``chunk``) and a row id that grows inside a block;
(file, chunk, row) is file order.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.session import cut

# Characters windows-1252 puts at bytes 0x80 to 0x9F, and the five
# bytes it leaves undefined.
CP1252_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
UNDEFINED = "[\u0081\u008d\u008f\u0090\u009d]"


BLOCK_KEY, TASKS_KEY = "spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"


@contextmanager
def blocks_of(spark: SparkSession, size: str | None) -> Iterator[None]:
    """Files read inside are split into blocks of this size; None leaves the session's.

    A task reads many blocks: there are no more tasks than a shuffle has, however many blocks.
    """
    ours = {BLOCK_KEY: size, TASKS_KEY: spark.conf.get("spark.sql.shuffle.partitions")} if size else {}
    before = {k: spark.conf.get(k, None) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_lines(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """``path, source_file, chunk, row, line``; sub-folders only if asked for; an empty match is an error."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path)
    if not raw.inputFiles():
        raise FileNotFoundError(f"No files matching {glob or path}")
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """``seq, path`` of the files of a folder, sorted by path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    order = Window.orderBy("path")
    return reader.load(path).select((F.row_number().over(order) - 1).alias("seq"), "path")


def with_line_number(lines: DataFrame) -> DataFrame:
    """0-based line number in the file.

    Rows of a block are consecutive ids, so one summary row per block is enough:
    no line is shuffled, whatever a file's size.
    """
    order = Window.partitionBy("path").orderBy("chunk")
    starts = (
        lines.groupBy("path", "chunk")
        .agg(F.count(F.lit(1)).alias("__n"), F.min("row").alias("__first"))
        .select("path", "chunk", "__first", (F.sum("__n").over(order) - F.col("__n")).alias("__start"))
    )
    number = F.col("__start") + F.col("row") - F.col("__first")
    return lines.join(starts, ["path", "chunk"]).withColumn("line_no", number).drop("__start", "__first")


def latin1(raw: Column) -> Column:
    return F.decode(raw.cast("binary"), "ISO-8859-1")


def cp1252(raw: Column) -> Column:
    return F.translate(latin1(raw), "".join(map(chr, CP1252_BYTES)), CP1252_CHARS)


def decoded(raw: Column) -> Column:
    """Text of a line by its file's encoding flags ``utf8`` and ``odd``."""
    text = F.when(F.col("utf8"), raw).when(F.col("odd"), latin1(raw)).otherwise(cp1252(raw))
    return F.regexp_replace(text, "^\ufeff|\r$", "")


def quote_map(line: Column, sep: str = "\t") -> tuple[Column, Column]:
    """Does the line end inside quotes: if it begins outside of them, and if it begins inside.

    Quotes count at the start of a cell only, and a doubled one is a character; what
    follows a closing quote belongs to the cell as it is.
    """
    rest = f'[^"]*+(?:""[^"]*+)*+"[^{sep}]*+'

    def opens(text: Column) -> Column:
        return F.regexp_replace(text, f'(?:^|(?<={sep}))"{rest}', "").rlike(f'(?:^|{sep})"')

    some = F.contains(line, F.lit('"'))
    inside = F.when(some & line.rlike(f"^{rest}"), opens(F.regexp_replace(line, f"^{rest}", ""))).otherwise(True)
    return some & opens(line), inside


def block_starts(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """``path, chunk, start, end``: is a block's first line inside quotes, and what follows its last one.

    A line is a map from the state it begins in to the state it ends in: it keeps the state,
    swaps it, or fixes it. Maps compose, so a block's map is its last fixed state, or its
    start, swapped as often as lines after that say; the maps of a file's blocks, one row
    each, are scanned in order. Lines that keep the state take no part.
    """
    place = ["path", "chunk"]
    a, b = (c.cast("int") for c in quote_map(F.col("line"), sep))
    maps = lines.select(*place, "row", a.alias("__a"), b.alias("__b"))
    marks = cut(maps.where((F.col("__a") != 0) | (F.col("__b") != 1)), "quote-marks")
    fixed = F.when(F.col("__a") == F.col("__b"), F.struct("row", F.col("__a").alias("state")))
    fixes = marks.groupBy(*place).agg(F.max(fixed).alias("__fix"))
    since = (F.col("__a") > F.col("__b")) & (F.col("row") > F.coalesce("__fix.row", F.lit(-1)))
    found = marks.join(fixes, place).groupBy(*place).agg(F.first("__fix.state").alias("__state"), F.count_if(since).alias("__swaps"))
    blocks = lines.select(*place).distinct().join(found, place, "left").fillna(0, ["__swaps"])
    across = Window.partitionBy("path").orderBy("chunk")
    blocks = blocks.withColumn("__turns", F.sum(F.when(F.col("__state").isNull(), F.col("__swaps")).otherwise(0)).over(across))
    after = F.pmod(F.col("__state") + F.col("__swaps"), F.lit(2))
    whole = F.when(F.col("__state").isNotNull(), F.struct(after.alias("state"), F.col("__turns").alias("at")))
    last = F.last(whole, True).over(across)
    end = F.pmod(F.coalesce(last["state"], F.lit(0)) + F.col("__turns") - F.coalesce(last["at"], F.lit(0)), F.lit(2))
    ended = blocks.withColumn("end", end)
    return ended.select(*place, F.coalesce(F.lag("end").over(across), F.lit(0)).alias("start"), "end")


def joined_records(lines: DataFrame, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Lines of one record joined by line breaks, and the files whose last quote stays open.

    ``block_starts`` tells every block whether it begins inside a cell, so a block's lines
    become records, or parts of them, on their own: lines are shuffled once, by block. What
    lies at the two ends of a block meets the ends of its neighbours, two rows per block.
    A block is one task, however long its file.
    """
    place = ["path", "chunk"]
    starts = cut(block_starts(lines, sep), "quote-starts")
    ends = starts.groupBy("path").agg(F.max_by("end", "chunk").alias("state"))
    inside_block = Window.partitionBy(*place).orderBy("row")
    so_far = inside_block.rowsBetween(Window.unboundedPreceding, 0)
    a, b = (c.cast("int") for c in quote_map(F.col("line"), sep))
    known = lines.withColumns({"__a": a, "__b": b}).join(starts.select(*place, "start"), place)
    known = known.withColumn("__swaps", F.sum(F.when(F.col("__a") > F.col("__b"), 1).otherwise(0)).over(so_far))
    fixes = F.when(F.col("__a") == F.col("__b"), F.struct(F.col("__a").alias("state"), F.col("__swaps").alias("at")))
    known = known.withColumn("__fix", F.last(fixes, True).over(so_far))
    # The last state that was fixed, or the block's start, swapped as often as since then.
    turned = F.coalesce(F.col("__fix.state"), F.col("start")) + F.col("__swaps") - F.coalesce(F.col("__fix.at"), F.lit(0))
    known = known.withColumn("__end", F.pmod(turned, F.lit(2)))
    begins = F.coalesce(F.lag("__end").over(inside_block), F.col("start")) == 0
    known = known.withColumn("__begins", begins.cast("int")).withColumn("__n", F.sum("__begins").over(so_far))
    # A record is a few lines; only they meet.
    parts = F.sort_array(F.collect_list(F.struct("row", "line")))
    pieces = known.groupBy(*place, "source_file", "__n").agg(parts.alias("__parts")).select(
        *place, "source_file", "__n", F.col("__parts")[0]["row"].alias("row"), F.array_join("__parts.line", "\n").alias("line")
    )
    latest = F.max("__n").over(Window.partitionBy(*place))
    pieces = cut(pieces.withColumn("__edge", (F.col("__n") == 0) | (F.col("__n") == latest)), "grid-pieces", "zstd")
    # Part 0 of a block goes on with the record that the last block before with a beginning has left open.
    edges, across = pieces.where("__edge"), Window.partitionBy("path").orderBy("chunk", "__n")
    first = F.when(F.col("__n") > 0, F.struct("chunk", "row"))
    owned = edges.withColumn("__first", F.last(first, True).over(across))
    parts = F.sort_array(F.collect_list(F.struct("chunk", "__n", "line")))
    joined = owned.groupBy("path", "source_file", "__first").agg(F.array_join(parts["line"], "\n").alias("line"))
    columns = ["path", "source_file", "chunk", "row", "line"]
    joined = joined.select("path", "source_file", "__first.chunk", "__first.row", "line")
    return pieces.where("NOT __edge").select(*columns).unionByName(joined), ends.where(F.col("state") == 1).select("path")


def describe_files(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """One row per file: its encoding flags, its first line that is not empty, and ``spans``:
    has it a line that ends inside quotes.

    A file is UTF-8 when every line is, else windows-1252 unless it uses a byte
    that encoding leaves undefined, else Latin-1. All of it is one aggregate with
    map-side combine, so a huge file is described by many tasks.
    """
    place = F.when(F.col("line") != "", F.struct("chunk", "row", "line"))
    files = lines.groupBy("path", "source_file").agg(
        F.bool_and(F.is_valid_utf8("line")).alias("utf8"),
        F.bool_or(latin1(F.col("line")).rlike(UNDEFINED)).alias("odd"),
        F.min(place).alias("first"),
        F.bool_or(quote_map(F.col("line"), sep)[0]).alias("spans"),
    )
    return files.withColumn("header", decoded(F.col("first.line"))).withColumn(
        "first", F.struct("first.chunk", "first.row")
    )


def split_rejects(rows: DataFrame, verdict: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """Good rows and one reject row per bad file.

    ``verdict`` holds one row per file with a ``reason``, null when it is good.
    """
    good = verdict.where(F.col("reason").isNull()).select(key)
    return rows.join(good, key, "left_semi"), verdict.where(F.col("reason").isNotNull())


def fail_when_all_rejected(verdict: DataFrame, what: str) -> None:
    if verdict.where(F.col("reason").isNull()).isEmpty():
        raise RuntimeError(f"No {what} file could be loaded")
