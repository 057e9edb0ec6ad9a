"""Text and array functions: review flags, bounded patches, list clean-up, redaction.

All are built-in expressions but ``apply_patches``, whose span logic (overlapping occurrences,
word borders, order of checks) runs in a vectorised Python function over Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_word(x: Column) -> Column:
    """Text before the first space."""
    return F.substring_index(x, " ", 1)


def stripped(x: Column) -> Column:
    """Without white space at the ends (tabs and line feeds too)."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def blank(x: Column) -> Column:
    """Null or white space alone."""
    return x.isNull() | x.rlike(r"^\s*$")


def without_code(x: Column) -> Column:
    """Removes a leading code of one to three digits, with its separator."""
    return F.regexp_replace(x, r"^\s*\d{1,3}(?:\s*[-:]\s*|\s+)", "")


def lexical_identity(x: Column) -> Column:
    """Lower case, trailing signs removed, white space runs as one space."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}_]+$", ""), r"\s+", " ")


def flags(checks: dict[str, Column]) -> Column:
    """Names of the checks that hold, in the order given; a null check does not hold."""
    found = F.array(*(F.when(c, F.lit(k)) for k, c in checks.items()))
    return F.filter(found, lambda x: x.isNotNull())


def length_outside(x: Column, least: int, most: int) -> Column:
    return ~F.length(x).between(least, most)


def numbers_before(x: Column, word: str) -> Column:
    """All whole numbers that stand directly before a word."""
    return F.regexp_extract_all(x, F.lit(rf"(\d+)\s+{word}"), 1)


def other_number_before(x: Column, word: str, value: Column) -> Column:
    """True if some number before the word is not the value."""
    return F.exists(numbers_before(x, word), lambda n: n.try_cast("long") != value)


def mentions_any(x: Column, terms: list[str]) -> Column:
    """True if one of the terms occurs as whole words, whatever the case."""
    body = "|".join(re.escape(t) for t in terms)
    return x.rlike(rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{body})(?![\p{{L}}\p{{N}}_])")


def unnegated(x: Column, terms: list[str], negations: list[str]) -> Column:
    """True if a term occurs with none of the negations as the word before it."""
    body, no = "|".join(re.escape(t) for t in terms), "|".join(re.escape(t) for t in negations)
    return F.regexp_replace(x, rf"(?i)\b(?:{no})\s+(?:{body})", " ").rlike(rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{body})(?![\p{{L}}\p{{N}}_])")


def grounded(quote: Column, text: Column, value: Column) -> Column:
    """A quote is evidence if the text holds it and it holds the value, whatever the case; blank quotes never are."""
    return ~blank(quote) & text.contains(quote) & F.lower(quote).contains(F.lower(value))


def replaced_once(x: Column, old: str, new: str) -> tuple[Column, Column]:
    """(text, reason): the clause replaced if it occurs exactly once, else the text as it was and why."""
    n = F.regexp_count(x, F.lit(re.escape(old)))
    reason = F.when(x.isNull(), "no text").when(n == 0, "clause absent").when(n > 1, "clause repeated")
    return F.when(reason.isNull(), F.replace(x, F.lit(old), F.lit(new))).otherwise(x), reason


def occurrences(x: Column, part: Column) -> Column:
    """Non-overlapping occurrences of a part that is not empty."""
    return F.when(F.length(part) > 0, ((F.length(x) - F.length(F.replace(x, part, F.lit("")))) / F.length(part)).cast("long"))


def redacted(x: Column, secret: Column, mark: str = "[id]") -> Column:
    """Every occurrence of an id replaced; null or empty ids change nothing."""
    return F.when(F.coalesce(F.length(secret), F.lit(0)) > 0, F.replace(x, secret, F.lit(mark))).otherwise(x)


def wrapped(x: Column, width: int = 90) -> Column:
    """A line break mark after every ``width`` characters."""
    return F.regexp_replace(x, f"(?s)(.{{{width}}})(?=.)", "$1<br>")


def html_escaped(x: Column) -> Column:
    out = x
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def script_safe_json(x: Column) -> Column:
    """JSON whose angle brackets and ampersands are escaped, for embedding in a page."""
    out = x
    for c in "<>&":
        out = F.replace(out, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    return out


def canonical_json(columns: list[str]) -> Column:
    """JSON object of the columns in order of their names, nulls kept."""
    return F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"})


def json_safe(columns: dict[str, str]) -> Column:
    """JSON object of (name: type) columns; what is no scalar becomes text."""
    plain = ("string", "int", "bigint", "smallint", "double", "float", "boolean")
    return F.to_json(F.struct(*(F.col(c) if t in plain else F.to_json(F.col(c)).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string").alias(c) for c, t in sorted(columns.items()))), {"ignoreNullFields": "false"})


# --- arrays


def deduped(items: Column) -> Column:
    """Items that are not blank, stripped; of those equal but for case the first. Sorts twice, so long lists stay cheap."""
    clean = F.filter(F.transform(items, stripped), lambda x: ~blank(x))
    ranked = F.sort_array(F.transform(clean, lambda x, i: F.struct(F.lower(x).alias("f"), i.alias("i"), x.alias("x"))))
    # as the one item of an outer array the sorted list is computed once, not once for each of its items
    first = F.transform(F.array(ranked), lambda r: F.filter(r, lambda e, k: (k == 0) | (F.get(r, k - 1)["f"] != e["f"])))
    kept = F.sort_array(F.transform(F.get(first, 0), lambda e: F.struct(e["i"].alias("i"), e["x"].alias("x"))))
    return F.transform(kept, lambda e: e["x"])


def normalised_set(items: Column) -> Column:
    """Sorted distinct folded items, for comparison; null if one is blank or there is none."""
    out = F.array_sort(F.array_distinct(F.transform(items, lambda x: F.lower(stripped(x)))))
    return F.when((F.size(items) > 0) & ~F.exists(items, lambda x: F.coalesce(blank(x), F.lit(True))), out)


def list_findings(items: Column, least: int = 3, most: int = 6) -> Column:
    """Names of what is wrong with a list."""
    folded = F.transform(items, lambda x: F.lower(x))
    return flags({"missing": items.isNull(), "too_few": F.size(items) < least, "too_many": F.size(items) > most, "blank_item": F.exists(items, blank), "repeated_item": F.size(F.array_distinct(folded)) < F.size(folded)})


def completed(items: Column, bank: list[str], seed: Column, size: Column) -> Column:
    """Fills a list up to ``size`` with bank words that it lacks, in an order drawn from the seed."""
    words = F.array(*map(F.lit, bank))
    ranked = F.transform(F.array_sort(F.transform(words, lambda w: F.struct(F.sha2(F.concat_ws("|", seed, w), 256).alias("h"), w.alias("w")))), lambda x: x["w"])
    have = F.transform(items, F.lower)
    spare = F.filter(ranked, lambda w: ~F.array_contains(have, F.lower(w)))
    return F.concat(items, F.slice(spare, 1, F.greatest(size - F.size(items), F.lit(0))))


def title_match(title: Column, allowed: Column) -> tuple[Column, Column]:
    """(verdict, repaired): exact, case_only, not_allowed or missing, and the allowed spelling if there is one."""
    near = F.get(F.filter(allowed, lambda x: F.lower(x) == F.lower(title)), 0)
    verdict = F.when(blank(title), "missing").when(F.array_contains(allowed, title), "exact").when(near.isNotNull(), "case_only").otherwise("not_allowed")
    return verdict, F.when(F.array_contains(allowed, title), title).otherwise(near)


# --- patches

def _letter(c: str) -> bool:
    """Letters and numbers of any script, and the underscore."""
    return c == "_" or unicodedata.category(c)[0] in "LN"


def _empties_paragraph(text: str, a: int, b: int) -> bool:
    """Whether nothing but white space is left around text[a:b] up to the nearest blank lines (two line feeds)."""
    before, after = text[:a].rpartition("\n\n")[2], text[b:].partition("\n\n")[0]
    return not before.strip() and not after.strip()


def patch_text(text: str | None, patches: list[tuple[str, str]], least: int = 300, most: int = 900, most_chars: int = 120, most_share: float = 0.2) -> tuple[str | None, str | None]:
    """(new text, None), or (None, the first reason against it).

    Each old excerpt must occur exactly once, overlaps counted, on word borders, and may not be given
    twice or leave nothing of the paragraphs that it touches (these end at blank lines); excerpts may not
    overlap; all changes together are bounded, and so is the result.
    """
    if text is None:
        return None, "no text"
    spans, seen = [], set()
    for old, new in patches:
        if not old or old == new:
            return None, "empty patch"
        if old in seen:
            return None, "excerpt given twice"
        seen.add(old)
        at, places = text.find(old), []
        while at >= 0:
            places.append(at)
            at = text.find(old, at + 1)
        if len(places) != 1:
            return None, "excerpt absent" if not places else "excerpt repeated"
        a, b = places[0], places[0] + len(old)
        if (a and _letter(old[0]) and _letter(text[a - 1])) or (b < len(text) and _letter(old[-1]) and _letter(text[b])):
            return None, "inside a word"
        if _empties_paragraph(text, a, b):
            return None, "whole paragraph"
        spans.append((a, b, new))
    spans.sort()
    if any(x[1] > y[0] for x, y in zip(spans, spans[1:], strict=False)):
        return None, "overlap"
    size = sum(max(b - a, len(new)) for a, b, new in spans)
    if size > most_chars or size > most_share * len(text):
        return None, "too much changed"
    out, at = [], 0
    for a, b, new in spans:
        out += [text[at:a], new]
        at = b
    done = "".join([*out, text[at:]])
    return (done, None) if least <= len(done) <= most else (None, "length out of range")


def apply_patches(df: DataFrame, text_col: str, patches_col: str, **limits) -> DataFrame:
    """Adds ``patched`` and ``reason``; ``patches_col`` is array<struct<old, new>>, null counting as none."""
    schema = T.StructType([*df.schema.fields, T.StructField("patched", T.StringType()), T.StructField("reason", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [patch_text(t, [(p["old"], p["new"]) for p in ps or []], **limits) for t, ps in zip(batch.column(text_col).to_pylist(), batch.column(patches_col).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
