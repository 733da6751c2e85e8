"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Texts are normalised to words; the automaton's alphabet is the benchmark's vocabulary,
so its offsets are word positions, which map back to offsets in the original text. Each
text is scanned once, however many windows there are.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.session import cut

WINDOW = 10
#: Benchmark text in one automaton; a larger benchmark takes several passes.
AUTOMATON_BYTES = 2 << 20

#: Letters, digits and everything beyond ASCII make words; the rest is white space. A-Z are lower-cased.
NORMALISE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
WORD_IN_TEXT = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(NORMALISE).split() if text else []


class Windows:
    """The automaton over all windows of some items, and what each window stands for."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str | None]] = {}
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[i : i + window]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, who in owners.items():
            self.automaton.add_word(key, (len(key), sorted(i for i in who if i is not None)))
        self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """First word, word after the last, items of each occurrence."""
        if self.empty:
            return []
        ids = tuple(map(self.vocabulary.get, words, repeat(0)))
        if not any(ids):
            return []
        return [(end + 1 - n, end + 1, who) for end, (n, who) in self.automaton.iter(ids)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    automaton_bytes: int = AUTOMATON_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """Where windows of benchmark items occur in each text.

    Returns ``record`` (the row, or its columns in ``carry``, as a struct, so extra
    columns cannot clash), ``n_words``,
    ``hits`` (merged runs of hit words with their character offsets in the original
    text: array<struct<first_word, end_word, start, end>>) and ``items`` (ids as strings,
    sorted). Null and empty texts and items have no words. An item without an id hits
    words but names none. Repeated rows are scanned each; repeated items count once.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(f"`{item_id_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").alias("text")
    ).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(size / automaton_bytes))
    items = items.withColumn("pass", F.pmod(F.xxhash64("item", "text"), F.lit(passes)))

    text = F.col(f"`{text_col}`")
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("record"),
        text.alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first_word:int,end_word:int,start:int,end:int>>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    schema, last = found.schema, found.drop("text").schema
    for k in range(passes):
        # At most automaton_bytes of benchmark text reaches the driver at a time.
        mine = [(r["item"], words_of(r["text"])) for r in items.where(F.col("pass") == k).collect()]
        automaton = spark.sparkContext.broadcast(mine)
        more = k + 1 < passes
        found = found.mapInArrow(scanner(automaton, window, more), schema if more else last)
        if more:
            found = cut(found, "decontamination")
    return found


def scanner(shared, window: int, keep_text: bool):
    """The scan of one automaton; it adds to the hits that earlier automata have found."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holder = shared.value
        # The worker's copy of the items becomes the automaton, once per worker.
        if not (holder and isinstance(holder[-1], Windows)):
            holder.append(Windows([(i, w) for i, w in holder], window))
        windows = holder[-1]
        for batch in batches:
            n_words, hits, items = [], [], []
            columns = zip(batch.column("text").to_pylist(), batch.column("hits"), batch.column("items"))
            for text, had, named in columns:
                words = words_of(text)
                n_words.append(len(words))
                occurrences = windows.scan(words)
                if not occurrences:
                    hits.append(had.as_py())
                    items.append(named.as_py())
                    continue
                runs = merged(
                    [(a, b) for a, b, _ in occurrences]
                    + [(h["first_word"], h["end_word"]) for h in had.as_py()]
                )
                at = [m.span() for m in WORD_IN_TEXT.finditer(text)]
                hits.append(
                    [
                        {"first_word": a, "end_word": b, "start": at[a][0], "end": at[b - 1][1]}
                        for a, b in runs
                    ]
                )
                new = {i for _, _, who in occurrences for i in who}
                items.append(sorted(new | set(named.as_py())))
            out = {
                "record": batch.column("record"),
                "text": batch.column("text"),
                "n_words": pa.array(n_words, pa.int64()),
                "hits": pa.array(hits, batch.schema.field("hits").type),
                "items": pa.array(items, batch.schema.field("items").type),
            }
            if not keep_text:
                del out["text"]
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return scan
