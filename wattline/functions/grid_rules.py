"""Column rules of the grid files: which columns to type, drop or back-fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.operators.frames import ref

NUMERIC_SHARE = 0.8
MIN_GAP, MAX_GAP = 0.35, 0.65
SIDE_FULL, SIDE_EMPTY = 0.9, 0.1
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?[iI]nf(inity)?$"


def alternating(c: str, pos: str = "pos") -> Column:
    """Aggregate: is the column missing on every other row of the file."""
    gap = ref(c).isNull().cast("double")
    share = F.avg(gap)
    even = F.avg(F.when(F.col(pos) % 2 == 0, gap))
    odd = F.avg(F.when(F.col(pos) % 2 == 1, gap))
    one_sided = ((even >= SIDE_FULL) & (odd <= SIDE_EMPTY)) | ((odd >= SIDE_FULL) & (even <= SIDE_EMPTY))
    return (F.count(F.lit(1)) >= 4) & share.between(MIN_GAP, MAX_GAP) & one_sided


def half_missing(c: str) -> Column:
    """Aggregate: may the column be ``alternating``? Its share of gaps allows it; no order is asked for."""
    return F.avg(ref(c).isNull().cast("double")).between(MIN_GAP, MAX_GAP)


def alternating_columns(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per file with a flag per column; all columns in one aggregate."""
    return df.groupBy(*keys).agg(*[alternating(c).alias(c) for c in columns])


def parsed(c: Column) -> Column:
    """Number from text with a decimal comma, null when it is not one."""
    text = F.trim(F.replace(c, F.lit(","), F.lit(".")))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def numeric_enough(c: str) -> Column:
    """Aggregate: at least 80 % of the non-null cells parse as numbers."""
    return F.try_divide(F.count(parsed(ref(c))), F.count(ref(c))) >= NUMERIC_SHARE


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns that are null on every row: one counting job, then a projection."""
    counts = df.agg(*[F.count(ref(c)).alias(c) for c in df.columns]).first()
    return df.select(*[ref(c) for c in df.columns if c in keep or counts[c] > 0])


def drop_empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=[f"`{c}`" for c in columns])


def typing_plan(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that are mostly numeric; one statistics job for all of them."""
    flags = df.agg(*[numeric_enough(c).alias(c) for c in columns]).first()
    return [c for c in columns if flags[c]]


def coerce_mostly_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn mostly-numeric text columns into doubles, failures into nulls."""
    return df.withColumns({c: parsed(ref(c)) for c in typing_plan(df, columns)})


def column_facts(df: DataFrame, columns: Sequence[str], file: str) -> DataFrame:
    """Per file and column: does it hold a value, is it mostly numeric, and is it ``half_missing`` once typed; one pass."""
    numeric = {c: F.coalesce(numeric_enough(c), F.lit(False)) for c in columns}
    rows = F.count(F.lit(1))

    def half(c: str) -> Column:
        values = F.when(numeric[c], F.count(parsed(ref(c)))).otherwise(F.count(ref(c)))
        return ((rows - values) / rows).between(MIN_GAP, MAX_GAP)

    facts = [(F.count(ref(c)) > 0).alias(f"__has_{c}") for c in columns]
    facts += [numeric[c].alias(f"__num_{c}") for c in columns]
    return df.groupBy(file).agg(*facts, *[half(c).alias(f"__half_{c}") for c in columns])


def coerce_per_file(df: DataFrame, facts: DataFrame, columns: Sequence[str], file: str) -> DataFrame:
    """Drop the columns no file fills and apply the typing rule decided file by file.

    A column that is numeric in one file and text in another becomes a struct of both, of
    which a row fills one, or none where it has no value; ``as_variants`` makes it one value.
    """
    has, num = (lambda c: ref(f"__has_{c}")), (lambda c: ref(f"__num_{c}"))
    found = facts.agg(
        *[F.bool_or(has(c)).alias(f"any_{c}") for c in columns],
        *[F.bool_or(num(c)).alias(f"some_{c}") for c in columns],
        *[F.bool_and(num(c) | ~has(c)).alias(f"every_{c}") for c in columns],
    ).first()
    kept = [c for c in columns if found[f"any_{c}"]]
    typed = {c: parsed(ref(c)) for c in kept if found[f"every_{c}"]}
    mixed = [c for c in kept if found[f"some_{c}"] and c not in typed]
    out = df.drop(*[c for c in columns if c not in kept]).withColumns(typed)
    if not mixed:
        return out
    joined = out.join(facts.select(file, *[num(c) for c in mixed]), file)

    def either(c: str) -> Column:
        number, text = F.when(num(c), parsed(ref(c))), F.when(~num(c), ref(c))
        both = F.struct(number.alias("number"), text.alias("text"))
        return F.when(number.isNotNull() | text.isNotNull(), both)

    return joined.withColumns({c: either(c) for c in mixed}).drop(*[f"__num_{c}" for c in mixed])


def as_variants(df: DataFrame) -> DataFrame:
    """Columns of a number or a text as VARIANT: numbers stay numbers, row by row.

    Variants can't be compared, so this comes after whatever drops or orders rows.
    """
    kind = "struct<number:double,text:string>"
    mixed = [c for c, t in df.dtypes if t == kind]

    def value(c: str) -> Column:
        return F.coalesce(ref(c)["number"].cast("variant"), ref(c)["text"].cast("variant"))

    return df.withColumns({c: value(c) for c in mixed}) if mixed else df
