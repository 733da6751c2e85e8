"""From raw documents to shards of training text, in five stages.

Each stage takes all that its predecessor kept and returns the columns of ``documents``;
the last one adds each row's shard and slot. ``run`` writes every stage as Parquet in the
shared folder and reads it back, so a lost executor costs tasks, not stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import decontamination, mixing, quality, sharding, simhash
from wattline.llm.common import table
from wattline.session import cut

#: Near copies: words of a shingle, differing bits of a 64-bit fingerprint.
SHINGLE = 4
DISTANCE = 4


def quoted(docs: DataFrame) -> list[Column]:
    """All columns; a row travels through a stage as one struct of them, so no name can clash."""
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a certified rule rejects.

    Null, empty and blank texts have fewer words than the base rule asks for and go.
    Repeated rows are judged each; extra columns stay, whatever their names. Without rows
    or labels nothing is certified: the base rule decides.
    """
    judged = quality.judge(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return judged.where("kept").select("record.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Two texts are near copies if their fingerprints differ in few bits, and a group is what such
    links connect. Of documents with one id and one text one row stays. Null, empty
    and blank texts are copies of each other; null ids are the last choice. Extra columns
    stay, whatever their names; an empty table gives an empty result.
    """
    found = simhash.near_duplicates(docs, shingle=SHINGLE, distance=DISTANCE)
    keepers = found.where("keeper").select(F.col("doc_id").alias("keeper_id"), F.col("text_key").alias("keeper_text"))
    records = docs.select(
        F.col("doc_id").alias("id"), simhash.text_key(F.col("text")).alias("key"), F.struct(*quoted(docs)).alias("record")
    )
    same = F.col("id").eqNullSafe(F.col("keeper_id")) & F.col("key").eqNullSafe(F.col("keeper_text"))
    kept = records.join(keepers, same, "left_semi").dropDuplicates(["id", "key"])
    return kept.select("record.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item.

    Null and empty texts hold none and stay. Repeated rows and extra columns stay as they
    are; with an empty benchmark every document stays.
    """
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select("record.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights of their sources; over-weighted ones repeat, at most three times.

    Null and empty texts have no words, so none of them is drawn. Rows that agree in all
    columns are one record with the copies of all of them. Extra columns stay, whatever
    their names; an empty table gives an empty result.
    """
    others = [c for c, n in zip(quoted(docs), docs.columns) if n not in ("doc_id", "text")]
    key = {"text_key": simhash.text_key(F.col("text")), "row_key": F.xxhash64(F.lit(0), *others)}
    mixed = mixing.mix(docs, carry=key)
    copies = (
        mixed.withColumn("copies", mixing.copies())
        .groupBy(F.col("doc_id").alias("mixed_id"), F.col("text_key").alias("mixed_text"), F.col("row_key").alias("mixed_row"))
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("equal"))
        .where("copies > 0")
    )
    copies = cut(copies, "mix-copies")
    same = (
        F.col("id").eqNullSafe(F.col("mixed_id"))
        & F.col("text_key").eqNullSafe(F.col("mixed_text"))
        & (F.col("row_key") == F.col("mixed_row"))
    )
    records = docs.select(
        F.col("doc_id").alias("id"), *[c.alias(n) for n, c in key.items()], F.struct(*quoted(docs)).alias("record")
    )
    found = records.join(copies.where("equal = 1"), same)
    # Only repeated records have to be brought together.
    if not copies.where("equal > 1").isEmpty():
        repeated = records.join(copies.where("equal > 1"), same).dropDuplicates(["id", *key])
        found = found.union(repeated)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("record.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot after the two-pass shuffle.

    Null ids and texts and repeated rows are ordinary rows. Extra columns stay but for any
    named shard or slot, which give way to the stage's own. An empty table gives an empty result.
    """
    kept = [F.col("record").getField(c).alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    return sharding.shuffle_into_shards(docs).select(*kept, "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: SimHash votes over 64-bit hashes are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
