"""One query per operator, over whole tables with production parameters.

``ORACLES`` has the SQL of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    decontamination,
    html_text,
    lexical_search,
    mixing,
    pii,
    quality,
    repeats,
    secret_scan,
    sharding,
    simhash,
    spelling,
    tokens,
    vector_search,
)
from wattline.llm.common import table
from wattline.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.cycle_weights((5, 2, 1)), share=1.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return left.select(
        "doc_id",
        "n_bytes",
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def digest(base: list[str], spans: list[str]) -> list[Column]:
    """Checksum of the base spans and the list of all spans."""
    return [
        F.sha2(pii.listed(F.concat(*base)), 256).alias("base_sha256"),
        pii.listed(F.concat(*spans)).alias("spans"),
    ]


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A source is taken for an owner, its documents of one language for a repository.
    found = secret_scan.scan_secrets(
        table(spark, sf_dir, "documents"),
        owner=F.col("source"),
        repository=F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))),
    )
    base = [k.name for k in secret_scan.BASE]
    every = [k.name for k in secret_scan.BASE + secret_scan.ADDED]
    span = "array<struct<start:int,place:int,end:int,kind:string>>"
    places = [
        F.transform(c, lambda s: F.struct(s["start"], s["place"], s["end"], s["kind"])).cast(span).alias(c)
        for c in every
    ]
    plain = found.select("doc_id", *places, secret_scan.LIVE, "candidates", "copied", "spread")
    return plain.select(
        "doc_id",
        *[F.size(c).cast("long").alias(f"n_{c}") for c in base],
        *digest(base, [*every, secret_scan.LIVE]),
        "candidates",
        "copied",
        F.transform("spread", lambda s: s["owners"]).alias("owners"),
        F.transform("spread", lambda s: s["repositories"]).alias("repositories"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = [k.name for k in pii.BASE]
    every = [k.name for k in pii.BASE + pii.ADDED]
    # Checksums and context words of each span, in the order of ``spans``.
    scores = F.transform(F.sort_array(F.concat(*every)), lambda s: F.round(s["score"], 2))
    return found.select(
        "doc_id",
        *[F.size(c).cast("long").alias(f"n_{c}") for c in base],
        *digest(base, every),
        scores.alias("scores"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.shuffle_into_shards(docs).select(
        F.col("record.doc_id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    n_hit = F.aggregate("hits", F.lit(0), lambda acc, h: acc + h["end_word"] - h["first_word"])
    return found.select(
        F.col("record.doc_id").alias("doc_id"),
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.default_model())


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), every=199)


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_repeats": op2_repeats,
    "op3_quality": op3_quality,
    "op4_secret_scan": op4_secret_scan,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_pii": op7_pii,
    "op8_decontamination": op8_decontamination,
    "op9_html_text": op9_html_text,
    "op10_token_counts": op10_token_counts,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_search": op12_vector_search,
    "op13_spelling": op13_spelling,
}

__all__ = ["ORACLES", "QUERIES"]
