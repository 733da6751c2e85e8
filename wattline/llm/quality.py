"""Quality rules whose thresholds are certified on labelled documents.

Each rule rejects a text whose statistic exceeds a cutoff. For every stratum, rule and
candidate cutoff the labelled good texts give an exact binomial test of "it rejects more
than alpha of the good texts". A rule's cutoffs are tested from the mildest on, so only the
rules and strata are many tests; those are corrected for by Holm's steps. Of the
cutoffs that pass, the one that catches most labelled bad texts is taken.
DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import WORD, bind
from wattline.session import cut

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SPAN_WORDS = 5

#: Good texts that all rules together may reject, in each stratum, and the chance to be wrong about any.
ALPHA = 0.05
DELTA = 0.1
#: A good text lost weighs as much as this many bad texts caught.
GOOD_WEIGHT = 20

#: Statistic of each rule and its candidate cutoffs.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / nullif(n_words, 0)", (0.1, 0.2, 0.3, 0.5)),
    "capitals": ("n_capitals / nullif(word_chars, 0)", (0.3, 0.4, 0.5, 0.7)),
    "long_words": ("word_chars / nullif(n_words, 0)", (6.5, 7.0, 8.0, 10.0)),
    "dup_lines": ("n_dup_lines / nullif(n_lines, 0)", (0.2, 0.3, 0.5, 0.7)),
}


def repeated_words(hashes: Column) -> Column:
    """Words in windows found twice or more, each word once.

    Windows are compared by their 64-bit hashes: equal ones stand side by side after sorting,
    and the gaps between their places say how many words they cover.
    """

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-SPAN_WORDS).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            places,
            start,
            lambda acc, p: F.struct(
                p.alias("last"), (acc["n"] + F.least(F.lit(SPAN_WORDS), p - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def again(ordered: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(ordered, i - 1)["h"] == x["h"]).otherwise(F.lit(False))
            after = F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False))
            return before | after

        return covered(F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["at"])))

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        bind(F.sort_array(placed), again)
    )


def text_statistics(docs: DataFrame, keys: dict[str, Column], text: Column) -> DataFrame:
    """Counts of words, characters, symbols, lines and repeats; a null text has none of them."""
    text = F.coalesce(text, F.lit(""))
    rows = docs.select(*[c.alias(n) for n, c in keys.items()], text.alias("text"))
    words = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).withColumn(
        "lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    )
    hashed = words.withColumn(
        "hashes",
        F.when(
            F.size("words") >= SPAN_WORDS,
            bind(
                F.col("words"),
                lambda w: F.transform(
                    F.sequence(F.lit(0), F.size(w) - SPAN_WORDS),
                    lambda i: F.xxhash64(*[w[i + k] for k in range(SPAN_WORDS)]),
                ),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return hashed.select(
        *keys,
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)).alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("hashes")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_tail(rejected: Column, good: Column, rate: float) -> Column:
    """P(X <= rejected) for X ~ Binomial(good, rate), exactly, term by term in logarithms."""
    odds = math.log(rate / (1 - rate))
    first = good * math.log1p(-rate)
    start = F.struct(first.alias("term"), F.exp(first).alias("sum"))
    tail = F.aggregate(
        F.when(rejected > 0, F.sequence(F.lit(1).cast("long"), rejected)).otherwise(F.array().cast("array<bigint>")),
        start,
        lambda acc, i: bind(
            acc["term"] + F.ln((good - i + 1) / i) + odds,
            lambda t: F.struct(t.alias("term"), (acc["sum"] + F.exp(t)).alias("sum")),
        ),
        lambda acc: acc["sum"],
    )
    # At or above the expected count the test can't pass, however many terms it has.
    return F.when(rejected >= good * rate, F.lit(1.0)).otherwise(tail)


def certified_cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cutoff for each rule, null where none is certified.

    ``labelled`` has ``stratum``, ``good`` and the statistics. ``alpha`` is shared by the
    rules. The cutoffs of one rule in one stratum are a family that is tested from the
    mildest on at one level: a milder cutoff rejects no more, so only the first wrong one can
    err. ``delta`` is shared by the families that are left: one all of whose
    cutoffs pass hands its share on (Holm). So with probability 1 - delta no stratum loses
    more than alpha of its good texts. Counts are plain aggregates with map-side sums; the
    rest has a row per stratum and rule.
    """
    counts = [F.count(F.when(F.col("good"), 1)).alias("good")]
    tests = [(r, c) for r, (_, cutoffs) in RULES.items() for c in cutoffs]
    for i, (rule, cutoff) in enumerate(tests):
        over = F.expr(RULES[rule][0]) > cutoff
        counts.append(F.count(F.when(over & F.col("good"), 1)).alias(f"lost_{i}"))
        counts.append(F.count(F.when(over & ~F.col("good"), 1)).alias(f"caught_{i}"))
    by_stratum = labelled.groupBy("stratum").agg(*counts)
    rate = alpha / len(RULES)

    def options(rule: str) -> Column:
        return F.array(
            *[
                F.struct(
                    (F.col(f"caught_{i}") - GOOD_WEIGHT * F.col(f"lost_{i}")).alias("gain"),
                    F.lit(cutoff).alias("cutoff"),
                    binomial_tail(F.col(f"lost_{i}"), F.col("good"), rate).alias("p"),
                )
                for i, (r, cutoff) in enumerate(tests)
                if r == rule
            ]
        )

    rows = [F.struct(F.lit(r).alias("rule"), options(r).alias("options")) for r in RULES]
    families = by_stratum.select("stratum", F.inline(F.array(*rows)))
    families = families.withColumn("worst", F.array_max(F.transform("options", lambda o: o["p"])))
    everything = Window.partitionBy()
    order = everything.orderBy("worst", "stratum", "rule")
    many = F.count("*").over(everything)
    families = families.withColumns({"many": many, "step": F.row_number().over(order)})
    holds = F.col("worst") <= F.lit(delta) / (F.col("many") - F.col("step") + 1)
    families = families.withColumn("failed", F.min(F.when(~holds, F.col("step"))).over(everything))
    left = F.col("many") - F.coalesce(F.col("failed") - 1, F.col("many"))
    level = F.lit(delta) / F.greatest(left, F.lit(1))
    usable = F.filter("options", lambda o: (o["p"] <= F.col("level")) & (o["gain"] > 0))
    # Of equal gains the mildest cutoff.
    best = F.get(F.sort_array(usable, asc=False), 0)["cutoff"]
    chosen = families.withColumn("level", level).withColumn("best", best)
    return chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("best"))).alias(f"cut_{r}") for r in RULES])


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    alpha: float = ALPHA,
    delta: float = DELTA,
    carry: list[str] | None = None,
) -> DataFrame:
    """Statistics and verdict of every row: base_failed, the rules it breaks, kept.

    With ``carry`` those columns come along in the struct ``record``.

    ``labels`` says which ids are good (1) or bad (0); labels that are null or name no
    document are ignored, an id with several labels counts as bad if any is 0. Without
    enough labels no cutoff can be certified and only the base rule rejects. A null
    stratum is one of its own; a null or empty text has no words and fails the base rule;
    null and repeated ids are ordinary rows; extra columns are left out; an empty table
    gives an empty result.
    """
    keys = {"doc_id": F.col(f"`{id_col}`"), "stratum": F.col(f"`{stratum_col}`")}
    if carry:
        keys["record"] = F.struct(*[F.col(f"`{c}`") for c in carry])
    rows = text_statistics(docs, keys, F.col(f"`{text_col}`")).withColumn("base_failed", base_failed())
    rows = cut(rows, "quality")
    known = (
        labels.select(F.col(f"`{label_id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
        .where("label IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.min("label") > 0).alias("good"))
    )
    labelled = rows.drop("record").where(~F.col("base_failed")).join(known, "doc_id")
    cutoffs = cut(certified_cutoffs(labelled, alpha, delta), "cutoffs").withColumnRenamed("stratum", "of")
    broken = F.filter(
        F.array(
            *[
                F.when(F.expr(f"{statistic} > cut_{rule}"), F.lit(rule))
                for rule, (statistic, _) in RULES.items()
            ]
        ),
        lambda r: r.isNotNull(),
    )
    return (
        rows.join(cutoffs, F.col("stratum").eqNullSafe(F.col("of")), "left")
        .withColumn("broken", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(broken))
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
        .drop("of", *[f"cut_{r}" for r in RULES])
    )
