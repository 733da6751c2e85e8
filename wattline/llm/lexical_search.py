"""Ranked lexical search by presence masks.

A first scan counts the terms of every text that any item asks for and writes them as
postings; the counts over the corpus give the weights. Then each segment of documents is
searched for every item: bitmap operations give each document the mask of the item's terms
that it holds, documents with one mask form a group, and a group's score is bounded by what
its terms can reach in the segment. Groups are scored by descending bound until the next
bound is below the last of the best scores found so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import cut

#: Item text that reaches the driver and the workers at a time; more items take further passes.
ITEM_BYTES = 8 << 20
#: Postings of a segment; a segment holds one document at least.
SEGMENT_POSTINGS = 1 << 20
#: Documents that are scored together: whole groups up to this number, one group at least.
SCORED = 256
#: Bytes of text that are split into terms at a time.
SLICE = 1 << 20

#: Letters, digits and everything beyond ASCII make terms; the rest parts them. A-Z are lower-cased.
TERMS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def term_counts(text: str | None) -> Counter[bytes]:
    """Occurrences of each term; a long text is split a slice at a time."""
    raw = text.encode().translate(TERMS) if text else b""
    if len(raw) <= SLICE:
        return Counter(raw.split())
    counts: Counter[bytes] = Counter()
    start = 0
    while start < len(raw):
        stop = raw.find(b" ", start + SLICE)
        stop = len(raw) if stop < 0 else stop
        counts.update(raw[start:stop].split())
        start = stop
    return counts


class Asked:
    """The items of a pass: their vocabulary, and each one's terms with repeats."""

    def __init__(self, texts: list[str | None]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[np.ndarray, np.ndarray]] = []
        for text in texts:
            counts = term_counts(text)
            ids = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in counts]
            self.items.append((np.array(ids, np.int64), np.array(list(counts.values()), np.int64)))


def indexer(shared):
    """mapInArrow: id, number of terms, and the counts of asked terms by ascending number.

    The last row of a task has its totals instead: documents and terms, and the documents
    that hold each term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value.vocabulary
        holding = np.zeros(len(vocabulary), np.int64)
        docs = words = 0

        def out(ids: pa.Array, n: list, terms: list, counts: list, totals: list) -> pa.RecordBatch:
            few = [None] * len(ids)
            arrays = [
                ids,
                pa.array(n, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())),
                pa.array([t[0] for t in totals] or few, pa.int64()),
                pa.array([t[1] for t in totals] or few, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "counts", "docs", "words"])

        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            at, n, terms, counts = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                found = term_counts(text.as_py())
                if not found:
                    continue
                size = found.total()
                docs, words = docs + 1, words + size
                hits = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                if hits:
                    at.append(i)
                    n.append(size)
                    terms.append([t for t, _ in hits])
                    counts.append([c for _, c in hits])
                    holding[terms[-1]] += 1
            yield out(batch.column("doc_id").take(pa.array(at, pa.int64())), n, terms, counts, [])
        if docs:
            seen = np.flatnonzero(holding)
            yield out(pa.nulls(1, kind), [None], [seen.tolist()], [holding[seen].tolist()], [(docs, words)])

    return run


class Segment:
    """Some documents' postings, by document and by term."""

    def __init__(self, ids: pa.Array, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, docs: int, words: int):
        self.ids = ids
        sizes = np.diff(np.append(0, ends))
        rows = np.repeat(np.arange(len(n)), sizes)
        share = 100 - 75 + 75 * n * docs // words
        #: What a term adds to a document's score for each unit of its weight.
        self.gain = 1_000_000_000 * counts // (1000 * counts + 8 * share[rows])
        self.width = int(terms.max(initial=0)) + 1
        self.key = rows * self.width + terms
        order = np.argsort(terms, kind="stable")
        self.rows, by_term = rows[order], terms[order]
        first = np.flatnonzero(np.append(True, by_term[1:] != by_term[:-1])) if len(terms) else np.zeros(0, np.int64)
        self.place = {t: i for i, t in enumerate(by_term[first].tolist())}
        self.starts = np.append(first, len(terms))
        self.most = np.maximum.reduceat(self.gain[order], first) if len(terms) else first
        # Documents in the order of their ids, null last.
        self.by_id = np.empty(len(n), np.int64)
        self.by_id[np.array(pc.sort_indices(ids, null_placement="at_end"))] = np.arange(len(n))

    def groups(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents sorted by their group, where each group ends, its bound; best bound first."""
        held = [(j, self.place[t]) for j, t in enumerate(terms.tolist()) if t in self.place]
        words = (len(held) + 63) // 64
        masks = np.zeros((len(self.ids), max(1, words)), np.uint64)
        for bit, (_, p) in enumerate(held):
            masks[self.rows[self.starts[p] : self.starts[p + 1]], bit // 64] |= np.uint64(1 << bit % 64)
        some = np.flatnonzero(masks.any(axis=1))
        if words <= 1:
            distinct, group = np.unique(masks[some, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, group = np.unique(masks[some], axis=0, return_inverse=True)
        bits = np.unpackbits(np.ascontiguousarray(distinct).view(np.uint8), axis=1, bitorder="little")[:, : len(held)]
        reach = np.array([weights[j] * self.most[p] for j, p in held], np.int64)
        bounds = bits.astype(np.int64) @ reach
        order = np.argsort(-bounds, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        placed = place[group.reshape(-1)]
        sorted_docs = some[np.argsort(placed, kind="stable")]
        return sorted_docs, np.cumsum(np.bincount(placed, minlength=len(order))), bounds[order]

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        inside = terms < self.width
        terms, weights = terms[inside], weights[inside]
        wanted = docs[:, None] * self.width + terms[None, :]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return np.where(self.key[at] == wanted, self.gain[at] * weights, 0).sum(axis=1)


def searched(segment: Segment, terms: np.ndarray, weights: np.ndarray, best: list, k: int) -> list:
    """``best`` (loss, unnamed, id) with what the segment has, cut to ``k``."""
    docs, ends, bounds = segment.groups(terms, weights)
    start = group = 0
    while group < len(ends) and bounds[group] > 0 and (len(best) < k or bounds[group] >= -best[-1][0]):
        last = max(group, int(np.searchsorted(ends, start + SCORED, "right")) - 1)
        mine = docs[start : ends[last]]
        scores = segment.scores(mine, terms, weights)
        top = np.lexsort((segment.by_id[mine], -scores))[:k]
        ids = segment.ids.take(pa.array(mine[top])).to_pylist()
        new = [(-s, i is None, i) for s, i in zip(scores[top].tolist(), ids) if s > 0]
        best = sorted([*best, *new])[:k]
        start, group = int(ends[last]), last + 1
    return best


def searcher(shared, weights, docs: int, words: int, k: int):
    """mapInArrow over postings: item (its number), id, score of the best of all the task's segments."""

    def segments(batch: pa.RecordBatch) -> Iterator[Segment]:
        n = batch.column("n").to_numpy()
        terms, counts = batch.column("terms"), batch.column("counts")
        ends = terms.offsets.to_numpy()[1:] - terms.offsets.to_numpy()[0]
        start = 0
        while start < len(n):
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + SEGMENT_POSTINGS, "right")))
            part = slice(start, stop)
            yield Segment(
                batch.column("doc_id")[part],
                n[part],
                ends[part] - base,
                terms[part].flatten().to_numpy().astype(np.int64),
                counts[part].flatten().to_numpy(),
                docs,
                words,
            )
            start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [(t, c * weights.value[t]) for t, c in shared.value.items]
        best: list[list] = [[] for _ in items]
        kind = pa.int64()
        for batch in batches:
            kind = batch.column("doc_id").type
            for segment in segments(batch):
                for i, (terms, weight) in enumerate(items):
                    if len(terms):
                        best[i] = searched(segment, terms, weight, best[i], k)
        found = [(i, doc, -loss) for i, top in enumerate(best) for loss, _, doc in top]
        arrays = [
            pa.array([f[0] for f in found], pa.int64()),
            pa.array([f[1] for f in found], kind),
            pa.array([f[2] for f in found], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    return run


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of every item.

    Only scores above 0 count; equal scores go by ascending id, null last. Every row of
    ``items`` is an item of its own, so a repeated one is answered each time. Null and empty
    texts have no terms: such a document is never found nor counted, such an item finds
    nothing. Repeated documents count and are found each. Sums are 64-bit integers. Extra
    columns are left out; empty tables give an empty result.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_id_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    asked = asked.where("text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(size / item_bytes))
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), asked.schema["item_id"].dataType
    found = []
    for number in range(passes):
        # About item_bytes of item text reach the driver at a time.
        mine = asked.where(F.col("pass") == number).select("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(Asked([r["text"] for r in mine]))
        schema = f"doc_id {kind}, n long, terms array<int>, counts array<long>, docs long, words long"
        postings = cut(rows.mapInArrow(indexer(shared), schema), "postings")
        totals = postings.where("docs IS NOT NULL")
        n_docs, n_words = totals.agg(F.sum("docs"), F.sum("words")).first()
        holding = totals.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        weights = np.zeros(len(shared.value.vocabulary), np.int64)
        for term, n in holding.groupBy("t.terms").agg(F.sum("t.counts")).collect():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
        weights = spark.sparkContext.broadcast(weights)
        best = postings.where("n IS NOT NULL").select("doc_id", "n", "terms", "counts")
        best = best.mapInArrow(searcher(shared, weights, n_docs or 0, n_words or 1, k), f"item long, doc_id {kind}, score long")
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(mine)], f"item long, item_id {item_kind.simpleString()}"
        )
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = cut(best, "local-tops").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found.append(names.join(best, "item").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
