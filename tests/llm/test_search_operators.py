"""Searches and spelling variants against brute force, on awkward rows and on empty tables."""

import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import edge  # noqa: E402

from wattline.llm import lexical_search, queries, spelling, vector_search  # noqa: E402

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---- lexical search


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(text or ""))


def brute_ranks(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_words = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            m = 100 - 75 + 75 * c.total() * n_docs // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return edge.plain(out)


ITEMS = [
    (1, "abcde fghijk Lomnop uvéw 日本ab"),
    (2, "abab abab abab abcde"),
    (3, None),
    (4, " .,! "),
    (5, "nowhere to be found"),
    (None, "same line of text"),
    (7, " ".join(a + b for a in "ab cde fghi jk lo mnop rst uvé w 日本".split() for b in "ab cde fghi jk lo mnop rst uvé w 日本".split())),
    (7, "a b c one"),
]


@pytest.mark.parametrize("limits", [(1 << 20, 256, 8 << 20, 1 << 20), (40, 2, 60, 100)])
def test_ranks_match_brute_force(spark, limits, monkeypatch):
    monkeypatch.setattr(lexical_search, "SEGMENT_POSTINGS", limits[0])
    monkeypatch.setattr(lexical_search, "SCORED", limits[1])
    monkeypatch.setattr(lexical_search, "SLICE", limits[3])
    docs = edge.table(spark)
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, score long")
    found = lexical_search.rank_documents(docs, items, item_bytes=limits[2])
    got = edge.plain(found.select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute_ranks([(i, t) for i, t, _, _ in edge.rows()], ITEMS)


def test_ranks_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = edge.table(spark)
    assert lexical_search.rank_documents(docs.where("false"), items).count() == 0
    assert lexical_search.rank_documents(docs, items.where("false")).count() == 0


def test_ranks_of_the_tables(spark):
    got = edge.plain(queries.op11_lexical_search(spark, SF).collect())
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got == brute_ranks(docs, items)


def test_few_groups_are_scored(spark, monkeypatch):
    """Most documents share only common terms; their groups end the search unscored."""
    scored = []
    plain = lexical_search.Segment.scores
    monkeypatch.setattr(lexical_search.Segment, "scores", lambda self, docs, *a: scored.append(len(docs)) or plain(self, docs, *a))
    rng = np.random.default_rng(1)
    n = 4000
    held = [sorted({0, 1, *([2, 3, 4] if i % 400 == 0 else []), *rng.integers(5, 9, 2).tolist()}) for i in range(n)]
    sizes = np.array([len(h) for h in held])
    import pyarrow as pa

    segment = lexical_search.Segment(
        pa.array(range(n)), np.full(n, 50), np.cumsum(sizes), np.concatenate(held).astype(np.int64), np.ones(sizes.sum(), np.int64), n, 50 * n
    )
    best = lexical_search.searched(segment, np.arange(5), np.array([1, 1, 5000, 5000, 5000]), [], 10)
    assert [e[2] for e in best] == list(range(0, n, 400)) and sum(scored) == 10


# ---- vector search


def brute_nearest(rows, k, every):
    out = []
    valid = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    most = 2**63 - 2
    for i, q in valid:
        if i is None or i % every:
            continue
        found = []
        for j, c in valid:
            if j != i and len(c) == len(q):
                found.append((-max(-most, min(most, sum(a * b for a, b in zip(q, c)))), j is None, j))
        out += [(i, r, j, -s) for r, (s, _, j) in enumerate(sorted(found)[:k], 1)]
    return edge.plain(out)


def vectors():
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(200)]
    copies = [(200 + i, rows[5][1]) for i in range(100)] + [(10, rows[5][1])] * 3
    odd = [(None, rows[0][1]), (301, None), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (310, [float("inf")] * 6)]
    other = [(320, [1.0, 2.0]), (321, [2.0, -1.0]), (330, []), (331, []), (340, [0.5] * 7), (350, [0.0] * 6)]
    return rows + copies + odd + other


@pytest.mark.parametrize("sizes", [(2048, 1 << 16, 64), (7, 16, 2)])
def test_nearest_match_brute_force(spark, sizes):
    tile, group, fan_in = sizes
    table = spark.createDataFrame([(*r, 0, "x") for r in vectors()], "vec_id long, embedding array<double>, shard long, tile string")
    found = vector_search.search(table.repartition(5), lambda i: i % 10 == 0, 4, tile_rows=tile, group_rows=group, fan_in=fan_in)
    assert edge.plain(found.collect()) == brute_nearest(vectors(), 4, 10)


def test_huge_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** rng.choice([3, 20, 30, 50, 70]) for _ in range(3)]) for i in range(40)]
    rows += [(100 + i, [rng.uniform(-1, 1) * 2.0**22 for _ in range(4)]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_search.search(table, lambda i: i % 4 == 0, 3)
    assert edge.plain(found.collect()) == brute_nearest(rows, 3, 4)


def test_nearest_of_few_rows(spark):
    table = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>")
    assert vector_search.search(table.where("false"), lambda i: i % 10 == 0).count() == 0
    assert vector_search.search(table, lambda i: i < 0).count() == 0
    assert vector_search.search(table.where("vec_id = 0"), lambda i: i % 10 == 0).count() == 0


def test_nearest_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert edge.plain(queries.op12_vector_search(spark, SF).collect()) == brute_nearest(rows, 5, 50)


# ---- spelling


def brute_words(docs, least, times, every):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= times}


def near_pairs(words):
    """Pairs one edit apart, through the words with one character masked or left out."""
    near = defaultdict(set)
    masks = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i] + "*" + w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute_variants(docs, least, times, ratio, every):
    words = brute_words(docs, least, times, every)
    near, form = near_pairs(words), {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= ratio * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return edge.plain(out)


def test_variants_match_brute_force(spark):
    rng = random.Random(4)
    base = ["aabbaa", "aabba", "abcabc", "éèêéèê", "ÀÿÀÿÀÿ", "aaaaaa", "bookkeeper"]
    pool = set(base)
    for w in base * 60:
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "a", "b", "é"]) + w[at + rng.randrange(2) :]
        pool.add(w)
    pool = sorted(pool)
    texts = [" ".join(rng.choices(pool, weights=[1.5 ** (i % 12) for i in range(len(pool))], k=400)) for _ in range(20)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + edge.rows(20)
    rows += [(None, "bookkeeper Bookkeeper $ bookkeepers", None, None)] * 6
    want = brute_variants([(i, t) for i, t, _, _ in rows], 3, 1, 2, 7)
    assert sum(r[1] is not None for r in want) > 100
    found = spelling.group_variants(edge.table(spark, rows), 3, 1, 2, 7)
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    assert edge.plain(found.select(*columns).collect()) == want
    again = spelling.group_variants(edge.table(spark, rows, 11), 3, 1, 2, 7)
    assert edge.plain(again.select(*columns).collect()) == want


def test_long_texts_are_cut_between_runs(monkeypatch):
    text = "Wörter " * 50 + "x" * 300 + " ÀÉ1ab2" * 20
    want = Counter(lower(r) for r in re.findall("[A-Za-zÀ-ÿ]+", text))
    for size in (1, 7, 64):
        monkeypatch.setattr(spelling, "SLICE", size)
        assert spelling.runs(text) == want


def test_words_are_handed_on_in_parts(spark):
    docs = edge.table(spark)
    got = spelling.vocabulary(docs, 3, 2, 5, held=10).collect()
    assert dict(got) == brute_words([(i, t) for i, t, _, _ in edge.rows()], 3, 2, 5)


def test_variants_of_the_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = queries.op13_spelling(spark, SF).select("word", "form", "root", "n", "n_near", "form_n")
    assert edge.plain(found.collect()) == brute_variants(docs, 6, 5, 5, 199)
    assert spelling.group_variants(edge.table(spark).where("false")).count() == 0
