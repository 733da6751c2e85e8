"""A small table with the awkward cases, and brute-force helpers."""

import random
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside; as extra columns they must not get in the way.
CLASHING = "record size key chunk bucket row fp hits shard slot place words lines record_size span hash taken target".split()


def texts(n=60, seed=3):
    rng = random.Random(seed)
    syllables = ["ab", "cde", "fghi", "jk", "Lo", "mnop", "Rst", "uvé", "w", "日本"]

    def words(k):
        return " ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(k))

    shared = [words(rng.randint(12, 40)) for _ in range(5)]
    out = [words(rng.randint(5, 120)) + " " + rng.choice(shared) + "\n" + words(rng.randint(0, 30)) for _ in range(n)]
    out += [out[0]] * 4 + [out[1].replace("ab", "xy", 1)] * 2
    out += ["", " \n\t ", "one", "a b c", None, "x" * 5000, " ".join(["same"] * 3000), words(6000)]
    out += ["line of text\n" * 30, "# $ % " * 40, "▁ ▁▁ \x00 �", "é" * 70, "A B\r\nC\x0bD\x0cE  F"]
    return out


def rows(n=60, seed=3):
    """doc_id, text, lang, source; with null and repeated ids and repeated rows."""
    out = []
    for i, t in enumerate(texts(n, seed)):
        out.append((i * 3, t, [None, "en", "fr"][i % 3], None if i % 11 == 0 else f"src{i % 4}"))
    out += [(None, "a text without an id " * 5, None, None), (None, None, None, None)]
    out += [out[7], out[7], (out[8][0], "another text with the same id", "en", "src1")]
    return out


def table(spark, data=None, partitions=3):
    data = rows() if data is None else data
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    return frame.repartition(partitions).select("*", *[F.lit("x").alias(c) for c in CLASHING if c != "n_chars"])


def plain(row_iterable):
    """Rows as sorted tuples; None sorts first."""
    return sorted(map(tuple, row_iterable), key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_components(prints, distance):
    distinct = sorted(set(prints))
    words = np.array([np.frombuffer(p, ">u8") for p in distinct]).astype(np.uint64)
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(words ^ words[i]).sum(axis=1) <= distance):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return {p: find(i) for i, p in enumerate(distinct)}


def hand_fingerprint(text, shingle):
    w = WORD.findall(lower(text or ""))
    if not w:
        return bytes(8)
    hashes = [
        xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))
    ]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits.to_bytes(8, "big")
