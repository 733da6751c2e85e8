"""Removal of byte strings that an earlier document already has, by enhanced suffix arrays.

A sorted suffix array with the lengths of common prefixes of neighbours is a tree of
intervals; a stack scan visits it. An interval whose suffixes continue differently to the
left is a maximal repeat, and all its suffixes are its occurrences. Whole corpora don't fit
one array, so texts are thinned out first, by rules that only look at content:

1. Every 50-byte window picks an anchor, the 16 bytes in it with the smallest hash. Equal
   windows pick the same anchor, so it is enough to bring equal anchors together. An anchor
   stands for the stretch of all windows that picked it.
2. Anchors travel as hashes, once per chunk of documents, and come back with a verdict:
   unique, in a stretch that an earlier document has whole, or contested (the same anchor
   in stretches that differ, as at the ends of a shared passage).
3. Only contested stretches travel as bytes. Those of one anchor meet in one suffix array,
   whose maximal repeats say which windows an earlier document has.

An anchor with very many stretches would be a hot key. Its windows travel one by one
instead, by their own hashes: windows of one stretch spread out, equal ones fall together
in their chunk before they travel.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 50
GRAM = 16
PICKS = LENGTH - GRAM + 1
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
#: Buckets of stretches for each bucket of hashes: a stretch's suffixes take far more memory than its hash.
FINER = 4
#: Stretches of one anchor beyond which its windows travel one by one: in a chunk, in a bucket.
CHUNK_STRETCHES = 16
BUCKET_STRETCHES = 1000
UNIQUE, EARLIER, CONTESTED, CROWDED = range(4)
BLOCK = 1 << 15
LAST = np.iinfo(np.int64).max

_rng = np.random.default_rng(11)
BYTES = _rng.integers(0, 1 << 64, 256, np.uint64)
MULTIPLIERS = _rng.integers(0, 1 << 64, 8, np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MULTIPLIERS[7]
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on; blocks of it stay in the cache."""
    n = max(0, len(data) - GRAM + 1)
    out = np.empty(n, np.uint64)
    for a in range(0, n, BLOCK):
        g = BYTES[data[a : min(a + BLOCK, n) + GRAM - 1]]
        for i in range(4):
            g = g[: -(1 << i)] * MULTIPLIERS[i] + g[1 << i :]
        out[a : a + BLOCK] = mixed(g)
    return out


def picks(grams: np.ndarray) -> np.ndarray:
    """For each window start the position of its anchor: smallest hash, then leftmost."""
    n = max(0, len(grams) - PICKS + 1)
    out = np.empty(n, np.int64)
    low = np.uint64((1 << 31) - 1)
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        m = (grams[a : b + PICKS - 1] & ~low) | np.arange(a, b + PICKS - 1, dtype=np.uint64)
        width = 1
        while width * 2 <= PICKS:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        rest = PICKS - width
        m = np.minimum(m[: len(m) - rest], m[rest:])
        out[a:b] = (m & low).astype(np.int64)
    return out


def combined(grams: np.ndarray, positions: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    h = extra.astype(np.uint64)
    for p in positions:
        h = mixed(h * MULTIPLIERS[5] + grams[p])
    return h >> np.uint64(16)


def packed(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit values, byte by byte, so that equal high bytes compress away."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = raw.reshape(width, -1).T
    return out.view("<u8").ravel()


class Anchors(NamedTuple):
    """Stretches of one chunk and, sorted by (anchor, content), their distinct entries."""

    first: np.ndarray  # first and last window start of each stretch
    last: np.ndarray
    doc: np.ndarray
    entry: np.ndarray  # the entry of each stretch
    entry_anchor: np.ndarray
    entry_content: np.ndarray
    entry_doc: np.ndarray  # smallest id of the chunk that has the entry
    entry_at: np.ndarray  # a stretch of that document
    sent: np.ndarray  # entries that travel; those of crowded anchors don't


class Chunk:
    """Some documents end to end, in a fixed order, so that each visit finds the same."""

    def __init__(self, table: pa.Table):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        rows = sorted(((LAST if i is None else i), t or b"", i is None) for i, t in zip(ids, texts))
        self.ids = np.array([i for i, _, _ in rows], np.int64)
        self.unnamed = [u for _, _, u in rows]
        self.texts = [t for _, t, _ in rows]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.grams = gram_hashes(self.data)

    def anchors(self) -> Anchors:
        pick = picks(self.grams)
        inside = np.zeros(len(self.data) + 1, np.int32)
        long = self.ends - self.starts >= LENGTH
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, self.ends[long] - LENGTH + 1, -1)
        at = np.flatnonzero(np.cumsum(inside)[: len(pick)])
        chosen = pick[at]
        new = np.ones(len(at), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
        run = np.flatnonzero(new)
        first, last = at[run], at[np.append(run[1:], len(at))[: len(run)] - 1] if len(run) else at[:0]
        place = chosen[run]
        doc = self.ids[np.searchsorted(self.ends, first, "right")]
        # Anchors are the smallest hashes around, so they are mixed once more to spread evenly.
        anchor = mixed(self.grams[place] * MULTIPLIERS[6]) >> np.uint64(16)
        end = last + LENGTH - GRAM
        parts = [np.minimum(first + GRAM * j, end) for j in range(math.ceil((LENGTH + PICKS) / GRAM))] + [end]
        content = combined(self.grams, parts, ((place - first) << 8) + (end - first))
        content = np.maximum(content, np.uint64(1))  # 0 marks a crowded anchor

        order = np.lexsort((doc, content, anchor))
        a, c = anchor[order], content[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        heads = order[new]
        entry_anchor, entry_doc = anchor[heads], doc[heads]
        _, back, count = np.unique(entry_anchor, return_inverse=True, return_counts=True)
        crowded = count[back] > CHUNK_STRETCHES
        return Anchors(first, last, doc, entry, entry_anchor, content[heads], entry_doc, heads, ~crowded)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of 48-bit hashes; sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def by_bucket(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """The slice of each bucket in a sorted array."""
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    stop = [*start[1:], len(bucket)] if len(bucket) else []
    return [(int(bucket[a]), slice(int(a), int(b))) for a, b in zip(start, stop)]


def travelling(anchors: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content, document of what travels: entries, and one mark for each crowded anchor."""
    marks = np.unique(anchors.entry_anchor[~anchors.sent])
    a = np.concatenate([anchors.entry_anchor[anchors.sent], marks])
    c = np.concatenate([anchors.entry_content[anchors.sent], np.zeros(len(marks), np.uint64)])
    d = np.concatenate([anchors.entry_doc[anchors.sent], np.full(len(marks), LAST)])
    return a, c, d


def verdicts(a: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """For entries of all chunks: what is known of their stretches."""
    order = np.lexsort((d, c, a))
    a, c, d = a[order], c[order], d[order]
    new_a, new = np.ones(len(a), bool), np.ones(len(a), bool)
    new_a[1:] = a[1:] != a[:-1]
    new[1:] = new_a[1:] | (c[1:] != c[:-1])
    stretch, anchor = np.cumsum(new) - 1, np.cumsum(new_a) - 1
    heads, tops = np.flatnonzero(new), np.flatnonzero(new_a)
    least = d[heads][stretch]
    # Per anchor: how many stretches, and whether their first documents differ. A mark counts as crowded.
    of = anchor[heads]
    stretches = np.bincount(of)
    head_doc = d[heads]
    begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    differ = np.minimum.reduceat(head_doc, begins) != np.maximum.reduceat(head_doc, begins)
    crowded = (c[tops] == 0) | (stretches > BUCKET_STRETCHES)
    shared = (stretches > 1) & differ
    code = np.where(
        d > least,
        EARLIER,
        np.where(crowded[anchor], CROWDED, np.where(shared[anchor], CONTESTED, UNIQUE)),
    )
    out = np.empty(len(a), np.uint8)
    out[order] = code
    return out


class Records(NamedTuple):
    """Stretches that travel as bytes, sorted by the hash they travel by."""

    key: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    order: np.ndarray  # where each of the contested entries, then of the windows, has gone
    contested: np.ndarray  # entries
    stretches: np.ndarray  # stretches of crowded entries, in their smallest documents
    window: np.ndarray  # start of each of their windows
    window_of: np.ndarray  # the distinct window it is
    window_doc: np.ndarray  # that window's smallest document here


def records_of(chunk: Chunk, anchors: Anchors, code: np.ndarray) -> Records:
    contested = np.flatnonzero(code == CONTESTED)
    at = anchors.entry_at[contested]
    crowded = np.flatnonzero((code[anchors.entry] == CROWDED) & (anchors.doc == anchors.entry_doc[anchors.entry]))
    count = anchors.last[crowded] - anchors.first[crowded] + 1
    window = np.repeat(anchors.first[crowded], count) + within(count)
    doc = np.repeat(anchors.doc[crowded], count)
    offsets = [*range(0, LENGTH - GRAM, GRAM), LENGTH - GRAM]
    hashes = combined(chunk.grams, [window + o for o in offsets], np.zeros(len(window)))
    order = np.lexsort((doc, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    heads = order[new]

    key = np.concatenate([anchors.entry_anchor[contested], hashes[heads]])
    place = np.argsort(key, kind="stable")
    goes = np.empty(len(key), np.int64)
    goes[place] = np.arange(len(key))
    docs = np.concatenate([anchors.entry_doc[contested], doc[heads]])[place]
    start = np.concatenate([anchors.first[at], window[heads]])[place]
    size = np.concatenate([anchors.last[at] - anchors.first[at] + LENGTH, np.full(len(heads), LENGTH)])[place]
    return Records(key[place], docs, start, size, goes, contested, crowded, window, of, doc[heads])


def within(count: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``count``, end to end."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def repeated_windows(data: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each record the windows that a record of an earlier document has, as bits.

    The enhanced suffix array of all records: suffixes of at least LENGTH bytes, sorted, with
    the common prefix of neighbours. The scan's stack holds open intervals as (depth, first
    suffix, smallest document, left bytes). A closed interval with different left bytes is
    a maximal repeat; in every occurrence in a later document than its first, the windows of
    the repeat are marked. One with a single left byte is part of the repeat one byte to
    the left, with the same occurrences, and is skipped.
    """
    masks = [0] * len(start)
    count = size - LENGTH + 1
    record = np.repeat(np.arange(len(start)), count)
    offset = within(count)
    at = start[record] + offset
    # Only suffixes whose first LENGTH bytes occur in two documents can share an interval that counts.
    grams = gram_hashes(data)
    offsets = [*range(0, LENGTH - GRAM, GRAM), LENGTH - GRAM]
    hashes = combined(grams, [at + o for o in offsets], np.zeros(len(at)))
    by_hash = np.argsort(hashes, kind="stable")
    ordered, owner = hashes[by_hash], doc[record[by_hash]]
    begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else by_hash
    if not len(begins):
        return np.zeros(len(start), np.uint64)
    shared = np.minimum.reduceat(owner, begins) != np.maximum.reduceat(owner, begins)
    kept = np.sort(by_hash[np.repeat(shared, np.diff(np.append(begins, len(ordered))))])
    del grams, hashes, by_hash, ordered, owner
    if not len(kept):
        return np.zeros(len(start), np.uint64)
    record, offset, at = record[kept], offset[kept], at[kept]
    length = size[record] - offset
    raw = data.tobytes()
    suffixes = [raw[a : a + n] for a, n in zip(at.tolist(), length.tolist())]
    order = np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__))
    del raw, suffixes
    record, offset, at, length = record[order], offset[order], at[order], length[order]
    left = np.where(offset > 0, data[at - 1].astype(np.int64), -1 - np.arange(len(at))).tolist()
    docs = doc[record].tolist()
    records, offsets_list = record.tolist(), offset.tolist()

    def close(depth: int, begin: int, end: int, least: int) -> None:
        bits = (1 << (depth - LENGTH + 1)) - 1
        for i in range(begin, end):
            if docs[i] > least:
                masks[records[i]] |= bits << offsets_list[i]

    stack: list[list] = []
    common = [*common_prefixes(data, at, length).tolist(), 0]
    for i, depth in enumerate(common):
        # Suffix i joins the innermost open interval; ``depth`` is what it shares with i + 1.
        if stack:
            stack[-1][2] = min(stack[-1][2], docs[i])
            stack[-1][3] = stack[-1][3] if stack[-1][3] == left[i] else None
        begin, least, one = i, docs[i], left[i]
        while stack and stack[-1][0] > depth:
            d, begin, least, one = stack.pop()
            if one is None:
                close(d, begin, i + 1, least)
            if stack:
                stack[-1][2] = min(stack[-1][2], least)
                stack[-1][3] = stack[-1][3] if stack[-1][3] == one else None
        if depth >= LENGTH and not (stack and stack[-1][0] == depth):
            stack.append([depth, begin, least, one])
    return np.array(masks, np.uint64)


def common_prefixes(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bytes that each sorted suffix shares with the next one."""
    out = np.zeros(max(0, len(at) - 1), np.int64)
    reach = np.arange(LENGTH + PICKS)
    block = BLOCK // 8
    for s in range(0, len(out), block):
        a, b = at[s : s + block + 1][:-1], at[s + 1 : s + block + 1]
        most = np.minimum(length[s : s + block + 1][:-1], length[s + 1 : s + block + 1])
        inside = reach[None, :] < most[:, None]
        top = len(data) - 1
        same = (
            data[np.minimum(a[:, None] + reach, top)] == data[np.minimum(b[:, None] + reach, top)]
        ) & inside
        out[s : s + len(a)] = np.where(same.all(axis=1), len(reach), same.argmin(axis=1))
    return out


def blobs(chunk: int, rows: list[tuple[int, bytes]], name: str = "bucket") -> pa.Table:
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(rows), pa.int64()),
            name: pa.array([b for b, _ in rows], pa.int64()),
            "data": pa.array([d for _, d in rows], pa.binary()),
        }
    )


def covered(chunk: Chunk, anchors: Anchors, code: np.ndarray, records: Records, masks: np.ndarray) -> np.ndarray:
    """Which bytes of the chunk lie in a window that an earlier document has."""
    edge = np.zeros(len(chunk.data) + 1, np.int32)

    def cover(first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(edge, first, 1)
        np.add.at(edge, last + LENGTH, -1)

    mine = anchors.doc == anchors.entry_doc[anchors.entry]
    whole = (code[anchors.entry] == EARLIER) | ~mine
    cover(anchors.first[whole], anchors.last[whole])

    of_entry = np.zeros(len(code), np.uint64)
    of_entry[records.contested] = masks[records.order[: len(records.contested)]]
    some = np.flatnonzero(mine & (of_entry[anchors.entry] > 0))
    bits = of_entry[anchors.entry[some]]
    for j in range(PICKS):
        at = anchors.first[some[(bits >> np.uint64(j)) & np.uint64(1) > 0]] + j
        cover(at, at)

    count = anchors.last[records.stretches] - anchors.first[records.stretches] + 1
    doc = np.repeat(anchors.doc[records.stretches], count)
    earlier = masks[records.order[len(records.contested) :]] > 0
    hit = (doc > records.window_doc[records.window_of]) | earlier[records.window_of]
    cover(records.window[hit], records.window[hit])
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    keep_bytes: bool = False,
) -> DataFrame:
    """What is left of each text without the 50-byte strings that an earlier document has.

    Returns doc_id, n_bytes, removed (array<struct<start, end>>, maximal runs of bytes),
    kept_sha256 and, with ``keep_bytes``, kept (the bytes left). Texts are UTF-8 bytes and
    matches lie within a document. "Earlier" means a smaller id: rows with equal ids don't
    remove from each other, a null id comes after all others. Null, empty and short texts
    lose nothing; repeated rows are handled each; extra columns are left out; an empty table
    gives an empty result. Ids are integers; null and repeated ones spread by their texts, and
    rows that agree in both share a chunk. A chunk holds each of its documents whole, at
    some dozens of bytes a byte of text, so the longest text must fit a worker that often.

    Everything is one job: texts are dealt to chunks once, and each visit to a chunk
    reads the same shuffle files again.
    """
    text = F.col(f"`{text_col}`").cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = max(1, math.ceil(size / chunk_bytes)), max(1, math.ceil(size / bucket_bytes))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    here = dealt.groupBy("chunk")

    def propose(table: pa.Table) -> pa.Table:
        a, c, d = travelling(Chunk(table).anchors())
        order = np.argsort(a, kind="stable")
        a, c, d = a[order], c[order], d[order].view(np.uint64)
        parts = [
            (b, packed(a[s], 6) + packed(c[s], 6) + packed(d[s], 8)) for b, s in by_bucket(bucket_of(a, buckets))
        ]
        return blobs(table["chunk"][0].as_py(), parts)

    def answer(table: pa.Table) -> pa.Table:
        raw = [np.frombuffer(x, np.uint8) for x in table["data"].to_pylist()]
        n = [len(x) // 20 for x in raw]
        a = np.concatenate([unpacked(x[: 6 * k], 6) for x, k in zip(raw, n)])
        c = np.concatenate([unpacked(x[6 * k : 12 * k], 6) for x, k in zip(raw, n)])
        d = np.concatenate([unpacked(x[12 * k :], 8) for x, k in zip(raw, n)]).view(np.int64)
        codes = np.split(verdicts(a, c, d), np.cumsum(n)[:-1])
        return reply(table, [x.tobytes() for x in codes], 0)

    def reply(table: pa.Table, data: list[bytes], number: int) -> pa.Table:
        return pa.table(
            {
                "chunk": table["chunk"],
                "round": pa.array([number] * len(data), pa.int32()),
                "bucket": table["bucket"],
                "data": pa.array(data, pa.binary()),
            }
        )

    def replies(table: pa.Table, number: int, kind: type) -> np.ndarray:
        found = sorted(
            (b, d)
            for r, b, d in zip(*(table[x].to_pylist() for x in ("round", "bucket", "data")))
            if r == number
        )
        return np.frombuffer(b"".join(d for _, d in found), kind)

    def revisit(table: pa.Table, told: pa.Table) -> tuple[Chunk, Anchors, np.ndarray, Records]:
        chunk = Chunk(table)
        anchors = chunk.anchors()
        a, _, _ = travelling(anchors)
        order = np.argsort(a, kind="stable")
        answers = np.empty(len(a), np.uint8)
        answers[order] = replies(told, 0, np.uint8)
        code = np.full(len(anchors.sent), CROWDED, np.uint8)
        code[anchors.sent] = answers[: int(anchors.sent.sum())]
        return chunk, anchors, code, records_of(chunk, anchors, code)

    def contest(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blobs(0, [])
        chunk, _, _, rec = revisit(table, told)
        parts = []
        for b, s in by_bucket(bucket_of(rec.key, buckets * FINER)):
            size, start = rec.size[s], rec.start[s]
            body = chunk.data[np.repeat(start, size) + within(size)]
            head = np.array([len(size)], "<u8").tobytes()
            parts.append((b, head + packed(rec.doc[s].view(np.uint64), 8) + size.astype(np.uint8).tobytes() + body.tobytes()))
        return blobs(table["chunk"][0].as_py(), parts)

    def decide(table: pa.Table) -> pa.Table:
        docs_, sizes, bodies, n = [], [], [], []
        for x in table["data"].to_pylist():
            k = int(np.frombuffer(x, "<u8", 1)[0])
            raw = np.frombuffer(x, np.uint8)[8:]
            docs_.append(unpacked(raw[: 8 * k], 8).view(np.int64))
            sizes.append(raw[8 * k : 9 * k].astype(np.int64))
            bodies.append(raw[9 * k :])
            n.append(k)
        size = np.concatenate(sizes)
        masks = repeated_windows(np.concatenate(bodies), np.cumsum(size) - size, size, np.concatenate(docs_))
        return reply(table, [x.tobytes() for x in np.split(masks, np.cumsum(n)[:-1])], 1)

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return result.empty_table()
        chunk, anchors, code, rec = revisit(table, told)
        gone = covered(chunk, anchors, code, rec, replies(told, 1, np.uint64))
        runs, sums, left = [], [], []
        for t, a, b in zip(chunk.texts, chunk.starts.tolist(), chunk.ends.tolist()):
            mask = gone[a:b]
            if mask.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).view(np.int8)))
                runs.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2])])
                t = chunk.data[a:b][~mask].tobytes()
            else:
                runs.append([])
            sums.append(hashlib.sha256(t).hexdigest())
            left.append(t)
        ids = [None if u else i for i, u in zip(chunk.ids.tolist(), chunk.unnamed)]
        columns = [ids, (chunk.ends - chunk.starts).tolist(), runs, sums, *([left] if keep_bytes else [])]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, result)], schema=result)

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    result = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", spans), ("kept_sha256", pa.string())]
        + ([("kept", pa.binary())] if keep_bytes else [])
    )
    schema = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept_sha256 string"
    blob, note = "chunk long, bucket long, data binary", "chunk long, round int, bucket long, data binary"
    first = here.applyInArrow(propose, blob).groupBy("bucket").applyInArrow(answer, note)
    stretches = here.cogroup(first.groupBy("chunk")).applyInArrow(contest, blob)
    second = stretches.groupBy("bucket").applyInArrow(decide, note)
    told = first.union(second)
    return here.cogroup(told.groupBy("chunk")).applyInArrow(finish, schema + (", kept binary" if keep_bytes else ""))
