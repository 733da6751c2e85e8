"""SimHash near-duplicates by multi-index hashing.

A fingerprint's bits are majority votes over the hashes of the text's word shingles.
Fingerprints are cut into segments. Each one is filed under every value within a small
Hamming ball of each of its segments, so that two fingerprints close enough in some segment
meet in a table entry; there their complete distance is verified. Links become components
by alternating star contraction. Equal fingerprints are merged before anything is compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.session import cut

SEED = 42
#: Rows of a table entry that are compared in one task; larger entries are linked through midpoints.
ENTRY_ROWS = 20_000
#: Entries up to this size are compared pair by pair, many entries at a time.
SMALL_ENTRY = 48
#: Rows whose links are thinned together to a forest.
FOREST_ROWS = 1 << 18
#: Rows for which a comparison of two fingerprints costs as much as filing one.
COMPARE_COST = 1 / 30
#: Rows of midpoints that are made at a time.
MIDPOINT_ROWS = 1 << 19
#: Hashes of a text whose bits are summed at a time.
VOTES = 1 << 16


def votes(hashes: np.ndarray) -> int:
    """Majority bits of the hashes."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), VOTES):
        part = hashes[start : start + VOTES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hash of every shingle in order; a text with fewer words than a shingle is one shingle."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return np.zeros(0, "<u8")
    joined = b" ".join(tokens)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    k = min(shingle, len(tokens))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[k - 1 :])], "<u8")


def fingerprint(text: str | None, shingle: int) -> bytes:
    """Big-endian bytes of the fingerprint; zero for a text without words."""
    return votes(shingle_hashes(text, shingle)).to_bytes(8, "big")


def segment_plan(bits: int, distance: int, n: int) -> tuple[list[int], list[int]]:
    """Widths and ball radii of the segments of a 64-bit word for ``n`` fingerprints.

    Both sides of a link are filed under their balls, so radius r finds segments that differ
    in up to 2r bits; two fingerprints that differ in more than that in every segment differ
    in at least the sum of all (2r + 1). Any plan whose sum exceeds ``distance`` finds every
    link; ``n`` only decides which of them is cheapest. Plans without any ball are left out:
    their segments are so short that entries would grow with the corpus.
    """
    best, choice = math.inf, ([bits], [0])
    for parts in range(2, max(3, distance + 1)):
        widths = [bits // parts + (i < bits % parts) for i in range(parts)]
        radii = [0] * parts
        while sum(2 * r + 1 for r in radii) <= distance:
            radii[radii.index(min(radii))] += 1
        balls = [ball_size(w, r) for w, r in zip(widths, radii)]
        cost = sum(balls) + COMPARE_COST * n * sum(b * b / 2**w for b, w in zip(balls, widths))
        if cost < best:
            best, choice = cost, (widths, radii)
    return choice


def ball_size(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1))


def ball_masks(width: int, radius: int) -> np.ndarray:
    """All words of ``width`` bits with at most ``radius`` ones."""
    masks = {0}
    for _ in range(radius):
        masks |= {m ^ (1 << b) for m in masks for b in range(width)}
    return np.array(sorted(m for m in masks if m.bit_count() <= radius), np.uint64)


def as_words(fingerprints: pa.Array) -> np.ndarray:
    """Fingerprints of an Arrow column as 64-bit words."""
    return np.frombuffer(b"".join(fingerprints.to_pylist()), ">u8").astype(np.uint64)


def as_column(rows: np.ndarray) -> pa.Array:
    raw = rows.astype(">u8").tobytes()
    return pa.array([raw[i : i + 8] for i in range(0, len(raw), 8)], pa.binary())


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def spanning_links(rows: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among ``rows``: a search that visits each row once.

    Each visited row is compared with the rows not reached yet, so a dense group costs
    little more than its size and never lists its pairs.
    """
    left = np.arange(len(rows))
    links, queue = [], []
    while len(left) or queue:
        if not queue:
            queue, left = [left[0]], left[1:]
        at = queue.pop()
        near = distances(rows[left], rows[at]) <= distance
        links += [(int(at), int(x)) for x in left[near]]
        queue += left[near].tolist()
        left = left[~near]
    return links


def forest(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as connect what the links ``a``-``b`` between places of ``rows`` connect.

    Equal rows are one. Every row that the links reach gets one link, to the smallest of
    its component, so a group gives links in proportion to its rows, however many
    entries its rows share. Returns the rows at both ends.
    """
    ends, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    _, first, name = np.unique(rows[ends], return_index=True, return_inverse=True)
    left, right = np.split(name[place], 2)
    least = np.arange(len(first))
    while True:
        low = np.minimum(least[left], least[right])
        before = least.copy()
        np.minimum.at(least, left, low)
        np.minimum.at(least, right, low)
        while not np.array_equal(least, least[least]):
            least = least[least]
        if np.array_equal(before, least):
            break
    linked = np.flatnonzero(least != np.arange(len(first)))
    return rows[ends[first[least[linked]]]], rows[ends[first[linked]]]


def filed(segments: list[tuple[int, int, np.ndarray]]):
    """mapInArrow: a row (key, fingerprint) for each value in the ball of each segment.

    A segment is (number, shift, masks) with the mask of its width first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = as_words(batch.column(0))
            for number, shift, masks in segments:
                value = (rows >> np.uint64(shift)) & masks[0]
                keys = ((value[:, None] ^ masks[None, 1:]) | np.uint64(number << 56)).view(np.int64)
                repeated = np.repeat(np.arange(len(rows)), keys.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), batch.column(0).take(pa.array(repeated))], names=["key", "fp"]
                )

    return run


def compared(distance: int, entry_rows: int):
    """mapInArrow over rows sorted by key: a forest of verified links, and the rows of entries too large.

    Rows (a, b) connect what verified links connect, of many entries at a time; a row
    (a, null) says that ``a`` stands in an entry of more than ``entry_rows`` rows. At most
    that many rows of an entry are held at a time.
    """

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, n = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), as_words(batch.column(1))))
            n += len(batch)
            if n >= FOREST_ROWS:
                yield np.concatenate([k for k, _ in held]), np.concatenate([r for _, r in held])
                held, n = [], 0
        if n:
            yield np.concatenate([k for k, _ in held]), np.concatenate([r for _, r in held])

    def links_of(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both ends of the forest of some whole entries."""
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        left, right = [], []
        for lag in range(1, min(SMALL_ENTRY, int(size.max())) if len(size) else 0):
            at = np.flatnonzero(keys[lag:] == keys[:-lag])
            if lag == 1:
                small = np.repeat(size <= SMALL_ENTRY, size)
            at = at[small[at]]
            near = at[distances(rows[at], rows[at + lag]) <= distance]
            left.append(near)
            right.append(near + lag)
        for s, n in zip(start[size > SMALL_ENTRY].tolist(), size[size > SMALL_ENTRY].tolist()):
            found = np.array(spanning_links(rows[s : s + n], distance), np.int64).reshape(-1, 2)
            left.append(found[:, 0] + s)
            right.append(found[:, 1] + s)
        none = np.zeros(0, np.int64)
        return forest(rows, np.concatenate([none, *left]), np.concatenate([none, *right]))

    def out(a: pa.Array, b: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows, overflowing = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for more_keys, more_rows in gathered(batches):
            keys, rows = np.concatenate([keys, more_keys]), np.concatenate([rows, more_rows])
            if overflowing is not None:
                more = int(np.searchsorted(keys != overflowing, True))
                if more:
                    yield out(as_column(rows[:more]), pa.nulls(more, pa.binary()))
                keys, rows = keys[more:], rows[more:]
                if not len(keys):
                    continue
                overflowing = None
            # The last entry may go on in the next batch.
            whole = len(keys) - int(np.searchsorted((keys != keys[-1])[::-1], True))
            if whole:
                a, b = links_of(keys[:whole], rows[:whole])
                if len(a):
                    yield out(as_column(a), as_column(b))
                keys, rows = keys[whole:], rows[whole:]
            if len(keys) > entry_rows:
                overflowing = keys[0]
                yield out(as_column(rows), pa.nulls(len(rows), pa.binary()))
                keys, rows = keys[:0], rows[:0]
        if len(keys):
            a, b = links_of(keys, rows)
            if len(a):
                yield out(as_column(a), as_column(b))

    return run


def midpoint_rows(distance: int):
    """mapInArrow: each fingerprint under every word within half the distance, rounded up.

    ``outer`` is true where the word is further than half the distance rounded down.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = ball_masks(64, (distance + 1) // 2)
        outer = np.bitwise_count(masks) > distance // 2
        step = max(1, MIDPOINT_ROWS // len(masks))
        for batch in batches:
            rows = as_words(batch.column(0))
            for s in range(0, len(rows), step):
                keys = (rows[s : s + step, None] ^ masks[None, :]).view(np.int64)
                fps = batch.column(0).slice(s, step)
                repeated = np.repeat(np.arange(len(fps)), len(masks))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), fps.take(pa.array(repeated)), pa.array(np.tile(outer, len(fps)))],
                    names=["key", "fp", "outer"],
                )

    return run


def midpoint_links(crowded: DataFrame, distance: int) -> DataFrame:
    """Links among fingerprints of crowded entries, without comparing any two.

    Two words differ in at most 2r bits exactly if a word lies within r bits of both, and in
    at most 2r + 1 if a word lies within r bits of one and r + 1 of the other. Each
    fingerprint is linked with the smallest inner one at each of its midpoints, so the rows
    grow with the fingerprints and not with their pairs.
    """
    rows = crowded.mapInArrow(midpoint_rows(distance), "key long, fp binary, outer boolean")
    inner = F.min(F.when(~F.col("outer"), F.col("fp")))
    least = rows.groupBy("key").agg(inner.alias("m"), F.count("*").alias("n")).where("n > 1 AND m IS NOT NULL")
    return (
        rows.join(least, "key")
        .where("m <> fp")
        .select(F.least("m", "fp").alias("a"), F.greatest("m", "fp").alias("b"))
        .distinct()
    )


def links(
    fingerprints: DataFrame,
    distance: int,
    segments: tuple[list[int], list[int]] | None = None,
    entry_rows: int = ENTRY_ROWS,
) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column ``fp``, distinct) within ``distance``.

    Every link within the distance is found by construction (see ``segment_plan``).
    """
    widths, radii = segments or segment_plan(64, distance, max(1, fingerprints.count()))
    plan = [
        (i, sum(widths[:i]), np.append(np.uint64((1 << w) - 1), ball_masks(w, r)))
        for i, (w, r) in enumerate(zip(widths, radii))
    ]
    rows = fingerprints.select("fp").mapInArrow(filed(plan), "key long, fp binary")
    entries = rows.repartition("key").sortWithinPartitions("key")
    found = cut(entries.mapInArrow(compared(distance, entry_rows), "a binary, b binary"), "simhash-links")
    near = found.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    near = near.where("a < b").distinct()
    crowded = found.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    if not crowded.isEmpty():
        near = near.union(midpoint_links(crowded, distance))
    return near


def components(edges: DataFrame) -> DataFrame:
    """node, root (its component's smallest node) for every node of ``edges`` (a < b).

    Alternating star contraction: every node hands its larger neighbours, then its smaller
    ones, to its smallest neighbour, until nothing changes; that takes a logarithmic number
    of rounds. Each round is one aggregate and one join per star and ends in a written table.
    """
    edges, seen = cut(edges, "edges"), None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # Small star: b hands its smaller neighbours a to the smallest of them.
        smallest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(smallest, "b")
            .select(F.explode(F.array(F.struct("m", F.col("a").alias("x")), F.struct("m", F.col("b").alias("x")))).alias("e"))
            .select(F.col("e.m").alias("a"), F.col("e.x").alias("b"))
            .where("a < b")
            .distinct()
        )
        edges = cut(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    distance: int = 4,
    segments: tuple[list[int], list[int]] | None = None,
    entry_rows: int = ENTRY_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text_key (MD5 of the text), fp (big-endian bytes), component_id, keeper of every row.

    Texts link if their fingerprints differ in at most ``distance`` bits. ``component_id`` is
    the smallest id that links reach. ``keeper`` is true for the
    one (id, text) of the component that stays in a deduplicated corpus: the smallest id,
    then the smallest text_key. Letters A-Z are lower-cased; repeated shingles vote each time.
    A text with fewer words than a shingle is one shingle; null, empty and blank texts have
    the fingerprint zero, which links like any other. A long text's votes are summed by slices.
    Rows with a null id take part but give no component its id; a component without any id
    has a null one. Repeated rows are kept; extra columns are left out; an empty table gives
    an empty result.
    """

    @F.pandas_udf("binary")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts])

    text = F.col(f"`{text_col}`")
    rows = cut(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"), text_key(text).alias("text_key"), fingerprints(text).alias("fp")
        ),
        "simhash",
    )
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    first = cut(rows.groupBy("fp").agg(F.min(place).alias("first")), "fingerprints")
    roots = components(links(first, distance, segments, entry_rows))
    rooted = first.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    # One row per fingerprint: its component's first row.
    least = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = rooted.join(least, "root").select("fp", "head")
    return rows.join(named, "fp").select(
        "doc_id",
        "text_key",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        place.eqNullSafe(F.col("head")).alias("keeper"),
    )


def text_key(text: Column) -> Column:
    """Tells texts apart where ids are missing or repeated; null for a null text."""
    return F.unhex(F.md5(text.cast("binary")))
