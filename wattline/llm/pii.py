"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

DataFrame operations only; each text is handled in its own row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import bind, match_spans, text_rows

#: Characters on either side in which context words count.
CONTEXT = 40
CONTEXT_GAIN = 0.2
CONTEXT_LOSS = 0.3


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def n_digits(value: Column, least: int, most: int) -> Column:
    return F.length(digits(value)).between(least, most)


def luhn(value: Column) -> Column:
    """Every second digit from the right counts twice, with 9 taken off above 9; the sum ends in 0."""
    backwards = F.regexp_extract_all(F.reverse(value), F.lit("[0-9]"), F.lit(0))
    counted = F.transform(
        backwards,
        lambda d, i: bind(d.cast("int") * (1 + i % 2), lambda x: x - F.when(x > 9, 9).otherwise(0)),
    )
    return F.aggregate(counted, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def mod_97(value: Column) -> Column:
    """The first four characters go last, letters count 10 to 35; the remainder by 97 is 1."""
    compact = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substring(compact, 5, 1000), F.substring(compact, 1, 4))
    signs = F.regexp_extract_all(moved, F.lit("[0-9A-Z]"), F.lit(0))
    rest = F.aggregate(
        signs,
        F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise(
            (acc * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return rest == 1


def always(value: Column) -> Column:
    return F.lit(True)


class Kind(NamedTuple):
    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    supports: str
    weakens: str = "(?!)"
    #: A proposal below this score is dropped; base kinds are never dropped for their score.
    least: float = 0.0


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"

# A run starts where no character of its class stands before it, or where the last match
# ended: the same matches as without that condition, in linear time.
BASE = [
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
        always,
        0.8,
        "mail|contact|write to|adres|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
        lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        0.6,
        "ip|addr|host|server|login",
        "version|release|section",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![0-9])(?![\x20-][0-9])",
        luhn,
        0.7,
        "card|visa|master|credit|karte|carte|tarjeta|pay",
        "order|tracking|isbn|serial",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda v: n_digits(v, 10, 15),
        0.6,
        "phone|tel|call|mobile|fax|whatsapp",
        "total|sum|score",
    ),
]
ADDED = [
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
        mod_97,
        0.8,
        "iban|bank|account|konto|compte|cuenta",
        least=0.5,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        always,
        0.4,
        "ssn|social|security",
        "order|part|serial|model",
        least=0.5,
    ),
]

SPAN = "array<struct<start:int,place:int,end:int,kind:string,score:double>>"


def proposals(text: Column, kind: Kind, place: int) -> Column:
    """Confirmed spans of one kind with their scores."""

    def scored(m: Column) -> Column:
        near = F.lower(F.concat_ws(" ", F.right(m["before"], F.lit(CONTEXT)), F.left(m["after"], F.lit(CONTEXT))))
        gain = F.when(near.rlike(rf"\b(?:{kind.supports})"), CONTEXT_GAIN).otherwise(0.0)
        loss = F.when(near.rlike(rf"\b(?:{kind.weakens})\b"), CONTEXT_LOSS).otherwise(0.0)
        return F.struct(
            m["start"].alias("start"),
            F.lit(place).alias("place"),
            m["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            (F.lit(kind.score) + gain - loss).alias("score"),
        )

    confirmed = F.filter(match_spans(text, kind.pattern), lambda m: kind.confirm(m["value"]))
    spans = F.transform(confirmed, scored)
    return F.filter(spans, lambda s: s["score"] >= kind.least - 1e-9) if kind.least else spans


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``<kind>``, an array of spans with scores, for each base and added kind.

    One row per input row. Offsets count code points, ends are exclusive. A null text is
    an empty one; null and repeated ids are ordinary rows; extra columns are left out;
    an empty table gives an empty result. Matches of one kind never overlap, those of
    different kinds may.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select(
        "doc_id", *[proposals(F.col("text"), k, i).cast(SPAN).alias(k.name) for i, k in enumerate(BASE + ADDED)]
    )


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(
        F.transform(
            F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
