"""Quality rules (operator 4): a threshold table compiled into one chain of projections.

Every measure is a built-in expression over the whole text; nothing is shuffled and no user
function runs. Words that stand in a repeated three-word window are found in n log n steps: the
window hashes are sorted with their places, equal neighbours mark their places, and the marked
places, sorted again, are summed by how far the next one lies.

Defined results: null and empty text have no words, and all measures are 0; such a text fails the
base rule on length. Rows are judged one by one, so repeated rows get equal results; an empty table
gives an empty table; other columns pass through, and internal columns are held in one struct whose
name may not occur in the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.llm.shared import WHITE_PATTERN, WORD_PATTERN

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for as was with be on by at this are from or an "
    "der die das und in zu den von mit ist im für ein eine auf dem nicht des als auch "
    "le la les de des et un une du en est que qui dans pour au il sur par pas plus "
    "el los las y del se por con una su para es al lo como más o pero sus"
).split()

HELD = "__quality"


@dataclass(frozen=True)
class Rule:
    """A document fails when ``measure`` lies outside [least, most]."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The production table. Ratios are per word or per line; see ``measures``.
RULES = (
    Rule("word_length", "mean_word_length", least=1.5, most=25.0),
    Rule("symbols", "symbols_per_word", most=0.25),
    Rule("exclamations", "exclamations_per_word", most=0.5),
    Rule("stop_words", "stop_word_ratio", least=0.02),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
    Rule("bullet_lines", "bullet_line_ratio", most=0.9),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _repeated_window_words(words: Column, n: Column, width: int = 3) -> list[tuple[str, callable]]:
    """Steps (name, expression of the struct's fields) towards n_repeat_words."""
    h = lambda name: F.col(f"{HELD}.{name}")

    def windows() -> Column:
        w = h("words")
        first = F.slice(w, 1, F.greatest(F.size(w) - (width - 1), F.lit(0)))
        return F.sort_array(F.transform(first, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    def places() -> Column:
        s = h("windows")
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        # index -1 is outside, as is the size: get() gives null for both
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    def covered() -> Column:
        p = h("places")
        steps = F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return [("windows", windows), ("places", places), ("n_repeat_words", covered)]


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the struct ``__quality`` with counts and ratios of each whole text."""
    if HELD in docs.columns:
        raise ValueError(f"the input already has a column {HELD}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = lambda name: F.col(f"{HELD}.{name}")

    def held(df: DataFrame, *fields: Column) -> DataFrame:
        return df.withColumn(HELD, F.struct(*fields))

    bare = F.regexp_replace(text, f"^{WHITE_PATTERN}|{WHITE_PATTERN}$", "")
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_PATTERN))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_PATTERN))
    df = held(docs, words.alias("words"), lines.alias("lines"))
    df = held(
        df,
        h("words").alias("words"),
        F.size(h("words")).cast("long").alias("n_words"),
        F.length(F.array_join(h("words"), "")).cast("long").alias("word_chars"),
        F.size(h("lines")).cast("long").alias("n_lines"),
        (F.size(h("lines")) - F.size(F.array_distinct(h("lines")))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(h("lines"), lambda x: x.rlike(r"^[\x20\x09]*[-*•|]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(h("words"), lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
    )
    for name, step in _repeated_window_words(h("words"), h("n_words")):
        keep = [f for f in df.schema[HELD].dataType.names if not (name == "n_repeat_words" and f in ("windows", "places", "words")) and not (name == "places" and f == "words")]
        df = held(df, *(h(f).alias(f) for f in keep), step().alias(name))
    ratios = {
        "mean_word_length": _ratio(h("word_chars"), h("n_words")),
        "symbols_per_word": _ratio(h("n_symbols"), h("n_words")),
        "exclamations_per_word": _ratio(h("n_exclamations"), h("n_words")),
        "stop_word_ratio": _ratio(h("n_stop_words"), h("n_words")),
        "dup_line_ratio": _ratio(h("n_dup_lines"), h("n_lines")),
        "bullet_line_ratio": _ratio(h("n_bullet_lines"), h("n_lines")),
    }
    return held(df, *(h(f).alias(f) for f in df.schema[HELD].dataType.names), *(c.alias(k) for k, c in ratios.items()))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """``measures`` with ``base_failed``, ``failed`` (names of failing rules) and ``kept`` in the struct."""
    df = measures(docs, text_col)
    h = lambda name: F.col(f"{HELD}.{name}")
    base = (h("n_words") < min_words) | (100 * h("n_repeat_words") > repeat_percent * h("n_words"))
    failing = []
    for r in rules:
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (h(r.measure) < r.least)
        if r.most is not None:
            bad = bad | (h(r.measure) > r.most)
        failing.append(F.when(bad, F.lit(r.name)))
    failed = F.filter(F.array(*failing), lambda x: x.isNotNull()) if failing else F.array().cast("array<string>")
    names = df.schema[HELD].dataType.names
    df = df.withColumn(HELD, F.struct(*(h(f).alias(f) for f in names), base.alias("base_failed"), failed.alias("failed")))
    kept = (~h("base_failed") & (F.size(h("failed")) == 0)).alias("kept")
    # A field that is not deterministic keeps the optimizer from pushing a later filter below the
    # measures, where each use of a measure would be computed anew.
    return df.withColumn(HELD, F.struct(*(h(f).alias(f) for f in (*names, "base_failed", "failed")), kept, F.monotonically_increasing_id().alias("mark")))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Rows that pass all rules, with the input's columns."""
    return judged(docs, rules, text_col).filter(F.col(f"{HELD}.kept")).select(*docs.columns)
