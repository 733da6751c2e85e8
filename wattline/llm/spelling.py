"""Spelling variants by permuterm rotations.

A word ends in a terminator and is rotated at every place. A rotation puts the character
before the place where it starts at its end, so leaving the last character out leaves that one out:
two words of one length that differ in one character share such a shortened rotation, and
a word shares its whole rotation with the shortened one of any word that has one character
more. Sorted by these prefixes, near words stand together; one scan of each prefix range
gives every word its number of neighbours there and the largest of them, without a list of
pairs. A range holds words that differ in one given character, so at most as many as the
alphabet has letters, and one more.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import cut

#: Ends a word; no run holds it.
END = "$"
RUN = re.compile(r"[A-Za-z\u00C0-\u00FF]+")
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
#: Characters of a text that are searched at a time.
SLICE = 1 << 20

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5


def runs(text: str | None) -> Counter[str]:
    """The text's runs, A-Z lower-cased, with their numbers; a long text is read by slices."""
    if not text:
        return Counter()
    low = text.encode().lower().decode()
    if len(low) <= SLICE:
        return Counter(RUN.findall(low))
    counts: Counter[str] = Counter()
    start = 0
    while start < len(low):
        # A slice ends where no run goes on.
        stop = start + SLICE
        while stop < len(low) and RUN.match(low[stop - 1]) and RUN.match(low[stop]):
            stop += 1
        counts.update(RUN.findall(low[start:stop]))
        start = stop
    return counts


def misspelt(prefix: int, run: str, every: int) -> str:
    """The run, less one character if ``every`` divides its checksum."""
    h = zlib.crc32(run.encode(), prefix)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counter(every: int | None, held: int):
    """mapInArrow: word, occurrences; summed as far as ``held`` distinct words allow."""

    def out(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                doc = doc.as_py()
                prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in runs(text.as_py()).items():
                    counts[misspelt(prefix, word, every) if every else word] += n
                    if len(counts) >= held:
                        yield out(counts)
                        counts = Counter()
        yield out(counts)

    return run


def vocabulary(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    held: int = HELD,
) -> DataFrame:
    """word, n: words of at least ``min_length`` code points and ``min_count`` occurrences.

    Words are maximal runs of letters, A-Z lower-cased. With ``every``, a run whose checksum
    with its document's id that number divides loses one character. Null and empty texts
    have no words; a null id reads as empty text; repeated rows are counted each.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    counted = rows.mapInArrow(counter(every, held), "word string, n long").where(F.length("word") >= min_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """key, last, word, n: every rotation whole (``last`` null), and without its last character.

    The terminator is never left out, so no two words of a range agree in ``last``.
    """
    marked = F.concat("word", F.lit(END))
    turned = words.select(
        "word", "n", F.explode(F.sequence(F.lit(1), F.length(marked))).alias("place"), marked.alias("marked")
    ).select("word", "n", F.expr("concat(substr(marked, place), left(marked, place - 1))").alias("whole"))
    shortened = F.expr("left(whole, length(whole) - 1)")
    last = F.right("whole", F.lit(1))
    forms = F.array(
        F.struct(F.col("whole").alias("key"), F.lit(None).cast("string").alias("last")),
        F.struct(shortened.alias("key"), last.alias("last")),
    )
    return (
        turned.select("word", "n", F.explode(forms).alias("form"))
        .select("form.key", "form.last", "word", "n")
        .where(F.col("last").isNull() | (F.col("last") != END))
    )


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, near (its largest neighbour: struct<rest, word, n>) of every word with one.

    Words that differ in one replaced character meet in one range. A character may be
    deleted from a run of equal ones at any of its places: such a pair meets once for each, and
    counts where the character differs from the one before it.
    """
    size = F.struct((-F.col("n")).alias("rest"), F.col("word").alias("word"), F.col("n").alias("n"))
    span = Window.partitionBy("key")
    ordered = span.orderBy("size").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.right("key", F.lit(1))
    repeats = F.col("last").isNotNull() & (F.col("last") == before)
    scanned = rotations(words).withColumn("size", size).select(
        "word",
        "last",
        "size",
        (F.col("last").isNotNull() & (before == F.col("last"))).alias("repeat"),
        F.count("last").over(span).alias("changed"),
        (F.count("*").over(span) - F.count("last").over(span)).alias("whole"),
        F.count(F.when(repeats, 1)).over(span).alias("repeats"),
        F.first("size").over(ordered).alias("top"),
        F.nth_value("size", 2).over(ordered).alias("next"),
    )
    found = F.when(
        F.col("last").isNull(), F.col("changed") - F.col("repeats")
    ).otherwise(F.col("changed") - 1 + F.when(F.col("repeat"), 0).otherwise(F.col("whole")))
    other = F.when(F.col("top.word") == F.col("word"), F.col("next")).otherwise(F.col("top"))
    return (
        scanned.where(F.col("changed") + F.col("whole") > 1)
        .groupBy("word")
        .agg(F.sum(found).alias("n_near"), F.min(other).alias("near"))
        .where("n_near > 0")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the forms (columns ``word``, ``form``) that lead away from a word.

    Every form occurs more often than its word, so there are no circles. A step doubles the
    way that is followed.
    """
    way = cut(forms.select("word", F.col("form").alias("root")), "word-forms")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = cut(way.join(on, "root", "left"), "word-roots")
        if longer.where("further IS NOT NULL").isEmpty():
            return way
        way = longer.select("word", F.coalesce("further", "root").alias("root"))


def group_variants(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``vocabulary``.

    Two words are near if one inserted, deleted or replaced code point makes one of the
    other. A word's form is its near word of largest n (ties: the first in code-point order)
    if that is at least ``ratio`` (2 or more) times its own; ``root`` follows the forms to
    the last. An empty table gives an empty result; extra columns are left out.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms must lead to more frequent words")
    words = cut(vocabulary(docs, min_length, min_count, every, id_col, text_col), "words")
    near = words.join(neighbours(words), "word", "left")
    formed = F.col("near.n") >= ratio * F.col("n")
    found = cut(
        near.select(
            "word",
            F.when(formed, F.col("near.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(formed, F.col("near.n")).alias("form_n"),
        ),
        "word-neighbours",
    )
    led = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
