"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of blocks of equally many words. Seats (blocks) go to sources by highest
quotients target / (2k + 1), and each source's seats go on to its shards the same way. In
a shard, documents lie end to end in a seeded order and a seeded draw picks the blocks.
DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import WORD
from wattline.session import cut

SEED = "mix-1"
BLOCK_WORDS = 64
#: Words in one shard of a source; a hot source has more shards, not larger ones.
SHARD_WORDS = 1 << 18
MAX_REPEATS = 3


def cycle_weights(cycle: tuple[float, ...]) -> Callable[[DataFrame], DataFrame]:
    """Weights that repeat over the sources in code point order, null last."""

    def weigh(sources: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        weights = F.array(*[F.lit(float(w)) for w in cycle])
        return sources.withColumn("weight", weights[place % len(cycle)])

    return weigh


def with_targets(sources: DataFrame, share: float, max_repeats: int) -> DataFrame:
    """``target`` words of each source: its weight's part of all words times ``share``.

    No target exceeds ``max_repeats`` times its source; the excess is dealt to the others
    by weight. Sources in order of cap over weight fill up one after another, so those at
    their cap are a prefix, and prefix sums give the common level of the rest.
    """
    one = Window.partitionBy()
    cap = (F.col("source_size") * max_repeats).cast("double")
    before = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    level = (
        sources.withColumn("all_words", F.sum("source_size").over(one) * F.lit(share))
        .withColumn("weights", F.sum("weight").over(one))
        .withColumn("full", F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        .withColumn("full_weight", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("all_words") - F.col("full")) / (F.col("weights") - F.col("full_weight")))
        .withColumn("capped", cap < F.col("weight") * F.col("level"))
    )
    # The first source below its cap holds the final level.
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(one)
    target = F.when(F.col("capped"), cap).otherwise(F.least(cap, F.col("weight") * final))
    return level.withColumn("target", target).select("source", "source_size", "weight", "all_words", "target")


def apportion(rows: DataFrame, part: list[str], order: list[Column], votes: str, seats: str, out: str) -> DataFrame:
    """Sainte-Lague within each ``part``: ``seats`` go one by one to the highest votes / (2k + 1).

    Seats differ from exact proportion by less than half the number of claimants, scaled;
    so all but the last few seats of each claimant are certain, and only those few
    quotients are ranked, not one for each seat.
    """
    over = Window.partitionBy(*[F.col(c) for c in part])
    claims, all_votes = F.count(F.lit(1)).over(over), F.sum(votes).over(over)
    per = F.when(F.col("all_votes") > 0, F.col(votes) / F.col("all_votes")).otherwise(F.lit(0.0))
    ranked = (
        rows.withColumn("claims", claims)
        .withColumn("all_votes", all_votes)
        .withColumn("sure", F.greatest(F.lit(0), F.floor(per * (F.col(seats) - F.col("claims") / 2) - 0.5) - 1))
        .withColumn("most", F.ceil(per * (F.col(seats) + F.col("claims") / 2) + 0.5) + 1)
    )
    keep = rows.columns
    picked = (
        ranked.withColumn("sure_seats", F.sum("sure").over(over))
        .withColumn("k", F.explode(F.sequence("sure", "most")))
        .withColumn("quotient", F.col(votes) / (2 * F.col("k") + 1))
        .withColumn(
            "place",
            F.row_number().over(
                Window.partitionBy(*[F.col(c) for c in part]).orderBy(F.col("quotient").desc(), *order, F.col("k"))
            ),
        )
    )
    won = (F.col("place") <= F.col(seats) - F.col("sure_seats")).cast("long")
    return picked.groupBy(*keep, "sure").agg(F.sum(won).alias("won")).select(
        *keep, (F.col("sure") + F.col("won")).alias(out)
    )


def mix(
    docs: DataFrame,
    weigh: Callable[[DataFrame], DataFrame] | None = None,
    share: float = 1.0,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """How many words of each document the mix takes.

    ``carry`` names further small columns to return with each row.

    Returns doc_id, source, size, source_size, target, taken and key, one row per input row.
    ``taken`` counts repeats and is at most ``max_repeats`` times the size. A null or empty
    text has size 0 and is never taken; a null source is a source of its own, last in
    order; null and repeated ids are ordinary rows; extra columns are left out; an empty
    table gives an empty result. Reruns agree, however the input is partitioned. Rows are
    dealt and drawn by ``key``, a seeded hash of the id and ``carry``; rows without an id, and
    those that agree in all that is returned, are told apart by size and number.
    """
    weigh = weigh or cycle_weights((5, 2, 1))
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    carry = carry or {}
    carried = [F.xxhash64("carried")] if carry else []
    again = F.when(F.col("doc_id").isNull() | (F.col("number") > 1), F.concat_ws(":", "size", "number"))
    sized = cut(
        docs.select(
            F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in carry.items()]).alias("carried"),
            doc_id.alias("doc_id"),
            F.col(f"`{source_col}`").alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .groupBy("carried", "doc_id", "source", "size")
        .agg(F.count("*").alias("equal"))
        .withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "equal")))
        .withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), "doc_id", *carried, again).cast("binary")))
        .drop("equal", "number"),
        "mix-sizes",
    )
    sources = with_targets(weigh(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), share, max_repeats)
    sources = sources.withColumn("everyone", F.lit(1)).withColumn(
        "seats", F.floor(F.col("all_words") / block_words + 0.5)
    )
    by_source = [F.col("source").asc_nulls_last()]
    sources = cut(
        apportion(sources, ["everyone"], by_source, "target", "seats", "quota").select(
            "source",
            "source_size",
            "target",
            "quota",
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
        ),
        "mix-sources",
    )

    s = sources.select(F.col("source").alias("s"), "source_size", "target", "quota", "shards")
    placed = sized.join(s, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "shard", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("shards")
    )
    shards = (
        placed.groupBy("source", "shard")
        .agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))
        .withColumn("blocks", F.ceil(F.col("words") / block_words))
    )
    shards = apportion(shards, ["source"], [F.col("shard")], "words", "quota", "taken_blocks").select(
        F.col("source").alias("s"),
        F.col("shard").alias("h"),
        "blocks",
        F.least("taken_blocks", F.col("blocks") * max_repeats).alias("taken_blocks"),
    )

    line = Window.partitionBy("source", "shard").orderBy(F.substring("key", 9, 24), F.col("doc_id"), F.col("size"))
    whole = (
        placed.drop("s", "quota", "shards")
        .join(shards, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))
        .withColumn("place", F.row_number().over(line))
        .withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("end") - F.col("size"))
    )
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words)
    pieces = whole.withColumn(
        "block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last)))
    ).withColumn(
        "draw", F.md5(F.concat_ws(":", F.lit(seed), "source", "shard", "block").cast("binary"))
    )
    drawn = Window.partitionBy("source", "shard").orderBy(F.col("block").isNull(), "draw", "block")
    times = F.floor(F.col("taken_blocks") / F.col("blocks")) + (
        F.dense_rank().over(drawn) <= F.col("taken_blocks") % F.col("blocks")
    ).cast("long")
    words = F.least("end", (F.col("block") + 1) * block_words) - F.greatest("start", F.col("block") * block_words)
    return (
        pieces.withColumn("times", F.when(F.col("block").isNotNull(), times))
        .groupBy("source", "shard", "place", "key", "doc_id", "size", "source_size", "target", "carried")
        .agg(F.coalesce(F.sum(F.col("times") * words), F.lit(0)).cast("long").alias("taken"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "key", *[f"carried.{n}" for n in carry])
    )


def copies(seed: str = SEED) -> Column:
    """Whole copies of a document that stand for its ``taken`` words.

    The remainder of ``taken`` by ``size`` becomes one more copy with that probability, by
    a seeded hash of the row's key, so a source's copies come to its taken words on average.
    """
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.lit("copy"), "key").cast("binary"))
    chance = F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") / float(1 << 32)
    part = F.try_divide(F.col("taken"), F.col("size"))
    return F.coalesce(F.floor(part) + (chance < part - F.floor(part)).cast("long"), F.lit(0))
