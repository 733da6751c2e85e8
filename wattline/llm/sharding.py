"""Sharding by a two-pass external shuffle.

Pass one scatters every record into a bucket by a seeded hash of all its columns; a bucket is
small enough for one task's memory whatever the size of the corpus. Pass two puts each
bucket into a fixed order and Fisher-Yates shuffles it. Buckets laid end to end are one
uniform permutation of the corpus, which is cut into shards of equal row counts.

Only a count per bucket is gathered to know where each bucket starts; records cross the
network once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SEED = 20_240_601
BUCKET_BYTES = 32 << 20
#: Added to a text's bytes for the record's other fields.
RECORD_BYTES = 16


def record_size(text) -> F.Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A permutation of 0..n-1: position i swaps with a random position at or after it."""
    order = np.arange(n)
    picks = np.random.default_rng(seed).integers(np.arange(n), n) if n else order
    for i, j in enumerate(picks.tolist()):
        order[i], order[j] = order[j], order[i]
    return order


def shard_of(rank: np.ndarray, rows: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of each global rank; the first ``rows % shards`` shards get one row more."""
    small, larger = divmod(rows, shards)
    edge = larger * (small + 1)
    low = rank < edge
    shard = np.where(low, rank // (small + 1), larger + (rank - edge) // max(small, 1))
    slot = np.where(low, rank % (small + 1), (rank - edge) % max(small, 1))
    return shard, slot


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 40,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with its shard and its slot in the shard.

    Returns ``record`` (the whole row as a struct, so extra columns cannot clash with
    the operator's own), ``size``, ``text_crc32``, ``shard`` and ``slot``. Shards differ by one row at
    most; slots run from 0 without gaps. Null ids, null and empty texts are ordinary
    records (a null text has the checksum of an empty one). Null and repeated ids spread by
    the rest of their rows; only rows that agree in every column share a bucket, and they are
    interchangeable. An empty table gives an empty result. Reruns agree, however the input
    is partitioned.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Maps have no hash of their own.
    hashed = [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c for c, f in zip(columns, docs.schema)]
    record = docs.select(
        F.struct(*columns).alias("record"),
        F.xxhash64(F.lit(seed), *hashed).alias("key"),
        record_size(F.col(f"`{text_col}`")).alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))).alias("text_crc32"),
    )
    corpus = record.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(corpus / bucket_bytes))
    record = record.withColumn("bucket", F.pmod("key", F.lit(buckets)))

    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        record.groupBy("bucket")
        .agg(F.count("*").alias("rows"))
        .select(
            "bucket",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
            F.sum("rows").over(Window.partitionBy()).alias("all_rows"),
        )
    )

    def shuffle(records: pa.Table, start: pa.Table) -> pa.Table:
        if not records.num_rows:
            return records.select(["record", "size", "text_crc32"]).append_column(
                "shard", pa.array([], pa.int32())
            ).append_column("slot", pa.array([], pa.int64()))
        bucket = records["bucket"][0].as_py()
        fixed = np.lexsort([records[c].to_numpy() for c in ("text_crc32", "size", "key")])
        order = fixed[fisher_yates(len(fixed), [seed, bucket])]
        rank = start["start"][0].as_py() + np.arange(len(order))
        shard, slot = shard_of(rank, start["all_rows"][0].as_py(), shards)
        out = records.select(["record", "size", "text_crc32"]).take(pa.array(order))
        return out.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(slot))

    fields = record.select("record", "size", "text_crc32").schema.add("shard", T.IntegerType()).add("slot", T.LongType())
    return record.groupBy("bucket").cogroup(starts.groupBy("bucket")).applyInArrow(shuffle, fields)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; a row's place in its shard is its slot."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
