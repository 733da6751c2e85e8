"""Token counts of a byte-fallback BPE vocabulary by rank-synchronous array merging.

Pre-tokens of a batch lie end to end in one array of symbols. In each round every
sequence merges its pair of lowest rank (the leftmost if several tie), all sequences at
once; a sequence without a pair left is done. What survives is counted.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Sequences of more symbols are merged one by one with a heap, which takes n log n steps.
ARRAY_SYMBOLS = 64
#: Distinct pre-tokens a Python worker remembers.
REMEMBERED = 400_000


class RankMerger:
    """Counts the symbols that merging leaves of a pre-token.

    ``pieces`` maps each mergeable piece to its score; a higher score merges first.
    Characters without a piece count their UTF-8 bytes.
    """

    def __init__(self, pieces: dict[str, float]):
        scores = sorted(set(pieces.values()), reverse=True)
        rank_of_score = {s: r for r, s in enumerate(scores)}
        # Characters of pieces come first, then longer pieces.
        symbols = sorted({c for p in pieces for c in p} | set(pieces), key=lambda p: (len(p), p))
        self.ids = {p: i for i, p in enumerate(symbols) if len(p) == 1}
        every = {p: i for i, p in enumerate(symbols)}
        self.width = len(symbols) + 1  # the last id stands for any other character
        keys, ranks, made = [], [], []
        for piece, score in pieces.items():
            for cut in range(1, len(piece)):
                left, right = every.get(piece[:cut]), every.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    ranks.append(rank_of_score[score])
                    made.append(every[piece])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        # What a symbol left over counts: one, or its bytes if it has no piece.
        self.weight = np.array([1 if p in pieces else len(p.encode()) for p in symbols] + [0], np.int64)
        self.known: dict[str, int] = {}
        self.pairs: dict[int, tuple[int, int]] | None = None

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.weight)), self.made[at]

    def symbols(self, word: str) -> tuple[list[int], int]:
        """Ids of the characters, and the bytes of those without a piece."""
        other = self.width - 1
        ids = [self.ids.get(c, other) for c in word]
        return ids, sum(len(c.encode()) for c, i in zip(word, ids) if i == other) if other in ids else 0

    def count_batch(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token of at most ARRAY_SYMBOLS characters."""
        cut = [self.symbols(w) for w in words]
        out = np.array([extra for _, extra in cut], np.int64)
        sym = np.fromiter((s for ids, _ in cut for s in ids), np.int64)
        seq = np.repeat(np.arange(len(words)), [len(ids) for ids, _ in cut])
        none = len(self.weight)
        while len(sym):
            rank, made = self.pair_ranks(sym[:-1], sym[1:])
            rank = np.append(np.where(seq[:-1] == seq[1:], rank, none), none)
            first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            # Rank and position in one number: the minimum is the leftmost lowest pair.
            best = np.minimum.reduceat(rank * len(sym) + np.arange(len(sym)), first)
            merges = best // len(sym) < none
            at = best[merges] % len(sym)
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            if not merges.all():
                done = np.repeat(~merges, np.diff(np.append(first, len(sym))))
                out += np.bincount(seq[done], self.weight[sym[done]], len(out)).astype(np.int64)
                keep &= ~done
            sym, seq = sym[keep], seq[keep]
        return out

    def count_long(self, word: str) -> int:
        """Tokens of one long sequence: a linked list of symbols and a heap of pairs."""
        if self.pairs is None:
            self.pairs = {
                k: (r, m) for k, r, m in zip(self.keys.tolist(), self.ranks.tolist(), self.made.tolist())
            }
        sym, extra = self.symbols(word)
        n, width, pairs = len(sym), self.width, self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := pairs.get(sym[i] * width + sym[j])):
                heapq.heappush(heap, (found[0], i, sym[i], sym[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if sym[i] != left or j >= n or sym[j] != right:
                continue
            sym[i], sym[j] = pairs[left * width + right][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return extra + int(sum(self.weight[s] for s in sym if s >= 0))

    def count_texts(self, texts: list[str]) -> list[int]:
        split = [PRE_TOKEN.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        short = [w for w in new if len(w) <= ARRAY_SYMBOLS]
        for i in range(0, len(short), 20_000):
            part = short[i : i + 20_000]
            known.update(zip(part, self.count_batch(part).tolist()))
        known.update((w, self.count_long(w)) for w in new if len(w) > ARRAY_SYMBOLS)
        return [sum(map(known.__getitem__, words)) for words in split]


#: No piece has a space mark after another character, so no merge crosses these borders.
PRE_TOKEN = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def load_merger(model_path: str) -> RankMerger:
    """From a sentencepiece model: BPE, byte fallback, dummy prefix, white space kept."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece holds a space mark after another character; borders would not hold")
    return RankMerger(pieces)


def count_tokens(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    Null and empty texts have no token. Characters unknown to the vocabulary count their
    bytes. Repeated rows are counted each; extra columns are left out. The vocabulary
    (tables of a few MB, fixed by the tokenizer) goes to each worker once.
    """
    merger = docs.sparkSession.sparkContext.broadcast(load_merger(model_path))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(merger.value.count_texts(texts.fillna("").tolist()), dtype="int64")

    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        tokens(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


