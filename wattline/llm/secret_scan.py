"""Secret scans with corpus-wide ownership frequency.

Patterns propose candidates in each text. Copies of a text count as one, of its smallest
owner and repository, and hashes of the values are counted over the distinct owners and
repositories of the distinct texts: what spreads over several is a copied example, what
doesn't and looks random is likely a live credential.
DataFrame operations only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import match_spans
from wattline.session import cut

ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 6
#: A live value has this many characters, and this many different ones, with a digit and a letter.
LIVE_CHARS = 12
LIVE_DISTINCT = 7
#: A value in distinct texts of more owners, or of more repositories, than this is a copied example.
SPREAD_OWNERS = 2
SPREAD_REPOSITORIES = 3


class Kind(NamedTuple):
    name: str
    pattern: str


# Shorter runs of the same characters would only be found to be dropped, so the patterns ask for the length.
BASE = [
    Kind("assign", ASSIGN),
    Kind("access", r"AKIA[A-Z0-9]{16,}+"),
    Kind("hex", r"[0-9a-f]{24,}+"),
]
ADDED = [
    Kind("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Kind("signed_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Kind("prefixed", r"(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+)"),
]
LIVE = "live"

SPAN = "array<struct<start:int,place:int,end:int,kind:string,value:string,value_start:int>>"


def candidates(text: Column, kind: Kind, place: int) -> Column:
    def span(m: Column) -> Column:
        value = F.regexp_extract(m["value"], ASSIGN, 1) if kind.name == "assign" else m["value"]
        return F.struct(
            m["start"].alias("start"),
            F.lit(place).alias("place"),
            m["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            value.alias("value"),
            (m["end"] - F.length(value)).alias("value_start"),
        )

    spans = F.transform(match_spans(text, kind.pattern), span)
    if kind.name == "assign":
        spans = F.filter(spans, lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    return spans.cast(SPAN)


def looks_random(value: Column) -> Column:
    signs = F.array_distinct(F.split(value, ""))
    return (
        (F.length(value) >= LIVE_CHARS)
        & (F.size(signs) >= LIVE_DISTINCT)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
    )


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repositories of every candidate value, over distinct texts.

    Copies of a text fall together before the first shuffle and stand for one owner and
    repository, and repeats within a repository before each later one, so a value that a
    third of all rows hold costs no task more than its distinct texts or owners.
    """
    return (
        found.groupBy("hash", "text_key")
        .agg(F.min(F.struct("owner", "repository")).alias("home"))
        .groupBy("hash", F.col("home.owner").alias("owner"), F.col("home.repository").alias("repository"))
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("hash")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )


def scan_secrets(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id and an array of spans for each kind, one row per input row.

    ``assign``, ``access``, ``hex`` and the added formats are candidates; ``live`` lists
    the values that look random and that no more than SPREAD_OWNERS owners and
    SPREAD_REPOSITORIES repositories have in texts that differ. ``candidates`` and ``copied``
    count the candidates and those with a wider spread; ``spread`` gives the ``owners`` and
    ``repositories`` of each candidate, by place. Equal texts count once. Offsets count
    code points, ends are exclusive. A null text is an empty one, a null owner or
    repository is one of its own; null and repeated ids are ordinary rows; extra columns
    are left out; an empty table gives an empty result.
    """
    kinds = BASE + ADDED
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), owner.alias("owner"), repository.alias("repository"), text.alias("text")
    ).select(
        "doc_id",
        "owner",
        "repository",
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key"),
        *[candidates(F.col("text"), k, i).alias(k.name) for i, k in enumerate(kinds)],
    )
    # Row numbers of the written table: they name rows without relying on the ids.
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = (
        rows.select("row", "owner", "repository", "text_key", F.explode(F.concat(*[k.name for k in kinds])).alias("span"))
        .withColumn("hash", F.xxhash64("span.value"))
    )
    frequency = ownership(each.select("hash", "text_key", "owner", "repository"))
    span = F.struct(
        F.col("span.value_start").alias("start"),
        F.lit(len(kinds)).alias("place"),
        F.col("span.end").alias("end"),
        F.lit(LIVE).alias("kind"),
    )
    copied = (F.col("owners") > SPREAD_OWNERS) | (F.col("repositories") > SPREAD_REPOSITORIES)
    own = ~copied & looks_random(F.col("span.value"))
    counted = F.struct("span.start", "span.place", "span.end", "span.kind", "owners", "repositories")
    by_row = (
        each.join(frequency, "hash")
        .groupBy("row")
        .agg(
            F.collect_set(F.when(own, span)).alias(LIVE),
            F.count("*").alias("candidates"),
            F.count(F.when(copied, 1)).alias("copied"),
            F.sort_array(F.collect_list(counted)).alias("spread"),
        )
    )
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    no_counts = F.array().cast(
        "array<struct<start:int,place:int,end:int,kind:string,owners:bigint,repositories:bigint>>"
    )
    return rows.join(by_row, "row", "left").select(
        "doc_id",
        *[k.name for k in kinds],
        F.coalesce(LIVE, none).alias(LIVE),
        F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.coalesce("copied", F.lit(0)).alias("copied"),
        F.coalesce("spread", no_counts).alias("spread"),
    )
