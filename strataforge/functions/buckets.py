"""Bands, remaps and other conditional projections."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bands(value: Column, limits: list[tuple[int, str]], rest: str) -> Column:
    """First label whose limit the value does not exceed; ``rest`` otherwise, also for null."""
    out = F.lit(rest)
    for limit, label in reversed(limits):
        out = F.when(value <= limit, F.lit(label)).otherwise(out)
    return out


# Age bands of the source tables.
FOUR_BANDS = [(29, "18-29"), (49, "30-49"), (66, "50-66")]
TWELVE_BANDS = [(19, "16-19"), (24, "20-24"), (29, "25-29"), (34, "30-34"), (39, "35-39"), (44, "40-44"), (49, "45-49"), (54, "50-54"), (59, "55-59"), (64, "60-64"), (66, "65-66")]


def age_band(age: Column) -> Column:
    """Four bands; the last is open."""
    return bands(age, FOUR_BANDS, "67+")


def age_key_band(key: Column) -> Column:
    """Four bands of a textual age key; a top-coded key such as ``71-`` is no number and falls into the open band."""
    return age_band(key.try_cast("int"))


def source_band(age: Column) -> Column:
    """Twelve bands; everything below 20 is the first, the last is open."""
    return bands(age, TWELVE_BANDS, "67-")


def top_coded(age: Column, top: int = 71) -> Column:
    """Textual key of an age: itself, or ``top-`` from ``top`` on."""
    return F.when(age >= top, F.lit(f"{top}-")).otherwise(age.cast("string"))


def top_code_value(key: Column, top: int = 71) -> Column:
    """Inverse of ``top_coded``: the lower limit of a top-coded key; null for other text."""
    return F.when(key == f"{top}-", F.lit(top)).otherwise(key.try_cast("int"))


def right_closed_bin(value: Column, edges: list[float], labels: list[str], low: float, high: float) -> Column:
    """Value clipped to [low, high], then binned; a value equal to an edge belongs above it."""
    clipped = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels, strict=False))):
        out = F.when(clipped < edge, F.lit(label)).otherwise(out)
    return F.when(value.isNotNull(), out)


def code_pool(code: Column, prefix: str, ranges: list[tuple[int, int, str]]) -> Column:
    """Pools codes of ``prefix`` and a number by number ranges; null for codes of another form."""
    number = F.regexp_extract(code, f"^{prefix}(\\d+)$", 1).try_cast("int")
    out = F.lit(None).cast("string")
    for a, b, label in reversed(ranges):
        out = F.when(number.between(a, b), F.lit(label)).otherwise(out)
    return out


def band_floor(label: Column) -> Column:
    """Leading number of a band label, or null."""
    return F.regexp_extract(label, r"^(\d+)", 1).try_cast("int")


def _lookup(mapping: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(sorted(mapping.items()))))


def lenient_remap(value: Column, mapping: dict[str, str]) -> Column:
    """Mapped value, null where the mapping has none."""
    return F.element_at(_lookup(mapping), value) if mapping else F.lit(None).cast("string")


def strict_remap(value: Column, mapping: dict[str, str], what: str = "value") -> Column:
    """Mapped value; a value, null included, without a mapping stops the query with its name."""
    found = lenient_remap(value, mapping)
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit(f"no mapping for {what} "), F.coalesce(value, F.lit("<null>")))).cast("string"))


def remap_table(mapping: DataFrame, label_col: str, codes_col: str) -> DataFrame:
    """(code, label) from (label, codes); a code under two labels stops the query."""
    flat = mapping.select(F.explode(codes_col).alias("code"), F.col(label_col).alias("label"))
    one = flat.groupBy("code").agg(F.min("label").alias("label"), F.countDistinct("label").alias("n"))
    return one.select("code", F.when(F.col("n") == 1, F.col("label")).otherwise(F.raise_error(F.concat(F.lit("code under two labels: "), F.col("code"))).cast("string")).alias("label"))


def eligible(count: str | Column = "count", suppressed: str | Column = "suppressed") -> Column:
    """Positive and not suppressed; null counts as neither."""
    c, s = (F.col(x) if isinstance(x, str) else x for x in (count, suppressed))
    return F.coalesce((c > 0) & ~s, F.lit(False))


def paired(condition: Column, *fields: Column) -> Column:
    """True where either the condition holds and all fields are there, or neither does and all are null."""
    there, none = F.lit(True), F.lit(True)
    for f in fields:
        there, none = there & f.isNotNull(), none & f.isNull()
    holds = F.coalesce(condition, F.lit(False))
    return (holds & there) | (~holds & none)


def half_up(x: Column) -> Column:
    """Nearest integer of a value that is not negative, halves up."""
    return F.floor(x + 0.5)


def integral(text: Column) -> Column:
    """True for text that is a finite whole number."""
    number = text.try_cast("decimal(38,10)")
    return F.coalesce(number % 1 == 0, F.lit(False))


def phrases(labels: dict[str, Column], table: dict[str, dict[str, list[str]]], neutral: str = "average") -> Column:
    """Allowed phrases for trait labels; the neutral label admits those of both ends. First occurrences, in order."""
    parts = []
    for trait, label in labels.items():
        sets = table[trait]
        whole = [p for k in sets for p in sets[k]]
        out = F.array().cast("array<string>")
        for k, ps in sets.items():
            out = F.when(label == k, F.array(*map(F.lit, ps))).otherwise(out)
        parts.append(F.when(label == neutral, F.array(*map(F.lit, whole))).otherwise(out))
    return F.array_distinct(F.flatten(F.array(*parts)))


def fraction_bucket(x: Column) -> Column:
    """small below 0.05, medium below 0.15, else large."""
    return F.when(x < 0.05, "small").when(x < 0.15, "medium").otherwise("large")
