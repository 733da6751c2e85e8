"""Exact top-k search: tiled products of queries and shards.

Vectors are packed into tiles, matrices of a few thousand rows. Groups of query tiles meet
shards of candidate tiles; a task multiplies tile by tile, keeps the best columns of each
row of a product, and hands on one short list per query. The lists of the shards are merged
as a tree. Neither side is collected or broadcast, and nothing larger than one group, one
shard and one product is held at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.session import cut

#: Rows of a tile; a product has the square of that many numbers.
TILE_ROWS = 2048
#: Query rows of a group and candidate rows of a shard, at most; a task holds one of each.
GROUP_ROWS = 1 << 16
#: Lists that one step of the merge takes together.
FAN_IN = 64
#: A number below this is exact in a double, whatever the order of a sum.
EXACT = 2.0**53

TILE = "tile long, dim int, ids array<long>, matrix binary"
TOP = "array<struct<loss:long,unnamed:boolean,id:long>>"


def vectors_of(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Id and vector of the rows whose vectors have only finite components."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return table.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & finite
    )


def packer(rows_of_tile: int, scale: float):
    """mapInArrow: tiles of vectors of one length, their rows by ascending id, null last."""

    def tiles_of(ids: pa.Array, rows: np.ndarray, number: Iterator[int]) -> pa.RecordBatch:
        order = np.array(pa.compute.sort_indices(ids, null_placement="at_end"))
        rows = rows[order]
        narrow = rows.size and np.abs(rows).max() < 2**15
        data = {
            "tile": pa.array([next(number)], pa.int64()),
            "dim": pa.array([rows.shape[1]], pa.int32()),
            "ids": pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
            "matrix": pa.array([rows.astype("<i2" if narrow else "<f8").tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(data.values()), names=list(data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A rerun of a task gives its tiles the same numbers.
        first = TaskContext.get().partitionId() << 32
        number = iter(range(first, first + (1 << 32)))
        held: dict[int, list[tuple[pa.Array, np.ndarray]]] = {}
        for batch in batches:
            vectors = batch.column("vector")
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            dims = np.diff(vectors.offsets.to_numpy())
            start = np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                rows = np.floor(scale * values[start[at][:, None] + np.arange(dim)])
                parts = held.setdefault(dim, [])
                parts.append((batch.column("id").take(pa.array(at)), rows))
                if sum(len(i) for i, _ in parts) < rows_of_tile:
                    continue
                ids, rows = pa.concat_arrays([i for i, _ in parts]), np.concatenate([r for _, r in parts])
                whole = len(ids) // rows_of_tile * rows_of_tile
                for s in range(0, whole, rows_of_tile):
                    yield tiles_of(ids[s : s + rows_of_tile], rows[s : s + rows_of_tile], number)
                held[dim] = [(ids[whole:], rows[whole:])] if whole < len(ids) else []
        for parts in held.values():
            if parts:
                yield tiles_of(pa.concat_arrays([i for i, _ in parts]), np.concatenate([r for _, r in parts]), number)

    return run


def matrix(tile: dict) -> np.ndarray:
    n, dim, raw = len(tile["ids"]), tile["dim"], tile["matrix"]
    kind = "<i2" if dim and len(raw) == 2 * n * dim else "<f8"
    return np.frombuffer(raw, kind).astype(np.float64).reshape(n, dim)


def product(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products, exact; beyond 64 bits they are cut to the range.

    Doubles hold every sum of this size exactly, so that is an ordinary matrix product;
    longer integers and, beyond those, Python's are for vectors of huge components.
    """
    reach = queries.shape[1] * np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0)
    if reach < EXACT:
        return queries @ candidates.T
    if reach < 2.0**62:
        return queries.astype(np.int64) @ candidates.astype(np.int64).T
    whole = [np.array([[int(x) for x in row] for row in m.tolist()], object) for m in (queries, candidates)]
    most = (1 << 63) - 2
    return np.clip(whole[0] @ whole[1].T, -most, most).astype(np.int64)


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the ``k`` best of each row; of equal ones the first columns.

    Selects one column a round: the maximum's first place. ``scores`` is used up.
    """
    rows, least = np.arange(len(scores)), lowest(scores)
    columns, values = [], []
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        columns.append(at)
        values.append(scores[rows, at])
        scores[rows, at] = least
    return np.stack(columns, axis=1), np.stack(values, axis=1)


def lowest(scores: np.ndarray):
    """Marks a pair that doesn't count."""
    return -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min


def without_own(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray) -> None:
    """Marks the rows that carry the query's own id; ``ids`` ascend."""
    low, high = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for row in np.flatnonzero(low < high).tolist():
        scores[row, low[row] : high[row]] = lowest(scores)


def searcher(k: int):
    """Cogrouped task: the best ``k`` candidates of one shard for each query of one group."""

    def tiles(table: pa.Table) -> Iterator[dict]:
        for batch in table.select(["tile", "dim", "ids", "matrix"]).to_batches(max_chunksize=1):
            yield from batch.to_pylist()

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "query_id": [], "top": []}
        shard = candidates["shard"][0].as_py() if len(candidates) else 0
        for query_tile in tiles(queries) if len(candidates) else ():
            asked = matrix(query_tile)
            own = np.array(query_tile["ids"], np.int64)
            best: list[list[tuple[int, bool, int | None]]] = [[] for _ in own]
            for tile in tiles(candidates):
                if tile["dim"] != query_tile["dim"]:
                    continue
                ids = tile["ids"]
                named = np.array([i for i in ids if i is not None], np.int64)
                scores = product(asked, matrix(tile))
                without_own(scores, own, named)
                none = lowest(scores)
                columns, values = best_columns(scores, k)
                for row, (at, value) in enumerate(zip(columns.tolist(), values.tolist())):
                    new = [(-int(v), ids[c] is None, ids[c]) for c, v in zip(at, value) if v != none]
                    best[row] = merged(best[row], new, k)
            for i, top in enumerate(best):
                if top:
                    out["query"].append((query_tile["tile"], i))
                    out["query_id"].append(query_tile["ids"][i])
                    out["top"].append(top)
        entry = pa.struct([("loss", pa.int64()), ("unnamed", pa.bool_()), ("id", pa.int64())])
        return pa.table(
            {
                "tile": pa.array([t for t, _ in out["query"]], pa.int64()),
                "row": pa.array([r for _, r in out["query"]], pa.int32()),
                "query_id": pa.array(out["query_id"], pa.int64()),
                "shard": pa.array([shard] * len(out["top"]), pa.int64()),
                "top": pa.array([[dict(zip(("loss", "unnamed", "id"), e)) for e in t] for t in out["top"]], pa.list_(entry)),
            }
        )

    return run


def merged(a: list, b: list, k: int) -> list:
    """The first ``k`` of two lists of (loss, unnamed, id)."""
    return sorted([*a, *b])[:k] if a else b


def merge_tree(lists: DataFrame, shards: int, k: int, fan_in: int = FAN_IN) -> DataFrame:
    """One list per query out of one per query and shard, ``fan_in`` of them at a time."""
    while shards > 1:
        lists = (
            lists.withColumn("shard", F.floor(F.col("shard") / fan_in))
            .groupBy("tile", "row", "query_id", "shard")
            .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
        )
        shards = math.ceil(shards / fan_in)
    return lists


def search(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 5,
    scale: float = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tile_rows: int = TILE_ROWS,
    group_rows: int = GROUP_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` largest inner products.

    Components count as floor(scale * x). ``is_query`` picks the queries by their id; the
    candidates of a query are all rows with another id. Equal scores go by ascending id,
    null last. Vectors that are null or hold null or non-finite components take no part;
    a row with a null id is a candidate only. Vectors meet those of their own length; empty
    ones score zero among themselves. Repeated rows are candidates each, and a repeated
    query is answered each time. Scores are exact; beyond 64 bits they are cut to the range.
    Extra columns are left out; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors_of(vectors, id_col, vector_col)
    asked = rows.where(F.col("id").isNotNull() & is_query(F.col("id")))
    tiles = cut(rows.mapInArrow(packer(tile_rows, scale), TILE), "vector-tiles")
    n, n_asked = tiles.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0], asked.count()
    # The few queries of each input task come together in full tiles.
    asked = asked.repartition(max(1, math.ceil(n_asked / group_rows)))
    asked = cut(asked.mapInArrow(packer(min(tile_rows, 1024), scale), TILE), "query-tiles")
    # As many shards as the session has cores, or more so that none exceeds its rows.
    cores = spark.sparkContext.defaultParallelism
    shards = max(1, math.ceil(n / min(group_rows, max(tile_rows, math.ceil(n / cores)))))
    groups = max(1, math.ceil(n_asked / group_rows))

    def dealt(number: int) -> Column:
        return F.pmod(F.xxhash64("tile"), F.lit(number))

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long")))

    left = asked.withColumn("group", dealt(groups)).withColumn("shard", every(shards))
    right = tiles.withColumn("shard", dealt(shards)).withColumn("group", every(groups))
    lists = (
        left.groupBy("group", "shard")
        .cogroup(right.groupBy("group", "shard"))
        .applyInArrow(searcher(k), f"tile long, row int, query_id long, shard long, top {TOP}")
    )
    top = merge_tree(lists, shards, k, fan_in)
    return top.select("query_id", F.posexplode("top").alias("place", "hit")).select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("hit.id").alias("vec_id"),
        (-F.col("hit.loss")).alias("score"),
    )
