"""Toxicity (operator 7): a weighted lexicon, matched by Aho-Corasick.

Folding maps every code point to a letter or a space: case, homoglyphs of other scripts and
digits or signs that stand for letters become plain letters. Lexicon entries are word beginnings
of ``SHORTEST`` to ``LONGEST`` folded letters, and shorter words as a whole, weighted by their
log-odds between toxic and other training documents (``TRAIN_DOCS`` of each class at most, the one
bound of the lexicon); whole words that the other documents use although an entry begins them are
exception phrases, as are phrases that the caller passes. Each word counts with its heaviest
entry, unless an exception covers it. A logistic curve over the total and the total by length,
fitted on the other half of the sample, gives the score.

Defined results: null and empty texts have no hits and get the score of a clean text; without
labels, or with one class only, every score is the share of label 1 (0.5 without labels, and then
``predicted`` is 1 by the rule score >= 0.5). Rows are scored one by one; an empty table gives no
rows; other columns pass through ``keep_clean`` and are ignored elsewhere.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.bpe import code_points
from strataforge.llm.shared import arrow_bytes, doc_runs, stored
from strataforge.llm.training import held_out, sample

TRAIN_DOCS = 4_000  # of each class
SHORTEST, LONGEST = 4, 12
LEAST_DOCS = 4  # toxic documents that an entry must be in: fewer say nothing
FEATURES = 2

# Letters of other scripts that look like Latin ones, and what stands for a letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѐ": "e", "ё": "e", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "ⅰ": "i", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}

_FOLD: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """The folded code point of each code point; 32 for what is no letter and stands for none."""
    global _FOLD
    if _FOLD is None:
        table = np.full(0x110000, 32, np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        for wide in range(0xFF21, 0xFF5B):  # full-width forms
            if chr(wide).isalpha():
                table[wide] = ord(chr(wide - 0xFEE0).lower())
        for c, plain in HOMOGLYPHS.items():
            table[ord(c)] = ord(plain)
            if len(c.upper()) == 1:
                table[ord(c.upper())] = ord(plain)
        for c, plain in SUBSTITUTES.items():
            table[ord(c)] = ord(plain)
        _FOLD = table
    return _FOLD


def folded(raw: np.ndarray, off: np.ndarray) -> list[str]:
    """Folded text of each document, with a space before and behind."""
    cps, lead = code_points(raw)
    data = fold_table()[cps].astype("<u4")
    cut = np.searchsorted(lead, off).tolist()
    return [" " + data[a:b].tobytes().decode("utf-32-le", "replace") + " " for a, b in zip(cut, cut[1:], strict=False)]


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    bias: float = 0.0

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for entry, weight in self.lexicon.items():
            out.add_word(" " + entry, (len(entry), weight))
        for phrase in self.exceptions:
            text = " " + " ".join(phrase.split()) + " "
            out.add_word(text, (len(text) - 2, None))
        if len(out):
            out.make_automaton()
        return out


def totals(texts: list[str], automaton) -> np.ndarray:
    """Per text: summed weight of its words, and the number of words."""
    out = np.zeros((len(texts), 2))
    for k, text in enumerate(texts):
        words = text.split()
        text, out[k, 1] = f" {' '.join(words)} ", len(words)
        if not len(automaton):
            continue
        best: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (size, weight) in automaton.iter(text):
            if weight is None:
                covered.append((end - size, end))
            else:
                start = end - size + 1
                if weight > best.get(start, 0.0):
                    best[start] = weight
        if covered:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in covered)} if len(covered) * len(best) < 10_000 else _outside(best, covered)
        out[k, 0] = sum(best.values())
    return out


def _outside(best: dict[int, float], covered: list[tuple[int, int]]) -> dict[int, float]:
    """Hits that no exception covers, by a sweep over both in order."""
    starts = np.array(sorted(best))
    edge = np.zeros(len(starts) + 1, np.int64)
    spans = np.array(covered)
    np.add.at(edge, np.searchsorted(starts, spans[:, 0]), 1)
    np.add.at(edge, np.searchsorted(starts, spans[:, 1]), -1)
    return {int(s): best[int(s)] for s in starts[np.cumsum(edge[:-1]) == 0]}


def features(hits: np.ndarray) -> np.ndarray:
    """Total weight, and total weight by length, both damped."""
    total, n = hits[:, 0], hits[:, 1]
    return np.stack([np.log1p(total), np.log1p(100 * total / (n + 20))], axis=1)


def _beginnings(text: str) -> set[str]:
    """Lexicon candidates of a folded text; a whole word ends in a space."""
    found = set()
    for word in set(text.split()):
        found.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
        if len(word) <= 40:
            found.add(word + " ")
    return found


def _counts(rows: DataFrame) -> DataFrame:
    """(entry, pos, neg): documents of each class with the entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("entry", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])
        counts = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = sorted(set(counts[0]) | set(counts[1]))
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[1][k] for k in names], pa.int64()), pa.array([counts[0][k] for k in names], pa.int64())], schema=schema)
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in batches:
            raw, off = arrow_bytes(batch.column(0))
            y = batch.column(1).to_pylist()
            for a, b in doc_runs(off):
                for label, text in zip(y[a:b], folded(raw[off[a] : off[b]], off[a : b + 1] - off[a]), strict=True):
                    counts[label].update(_beginnings(text))
                if len(counts[0]) + len(counts[1]) > 100_000:
                    yield flush()
        yield flush()

    return rows.select("text", "y").mapInArrow(run, "entry string, pos long, neg long").groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS, phrases: tuple[str, ...] = ()) -> Model:
    """Learns from at most ``most`` training documents of each class. ``phrases`` are further exceptions, as plain text."""
    rows, share = sample(docs, labels, label, most, id_col, text_col)
    rows = stored(rows, "toxicity")
    sizes = {(r["half"], r["y"]): r["n"] for r in rows.groupBy("half", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = math.log(min(max(share, 1e-4), 1 - 1e-4) / (1 - min(max(share, 1e-4), 1 - 1e-4)))
    model = Model(bias=prior)
    if not all(any(sizes.get((h, y)) for h in (0, 1)) for y in (0, 1)):
        return model
    apart = min(sizes.get((h, y), 0) for h in (0, 1) for y in (0, 1)) >= 20  # else one half learns both
    learn = rows.filter("half = 0") if apart else rows
    n_pos, n_neg = (sum(sizes.get((h, y), 0) for h in ((0,) if apart else (0, 1))) for y in (1, 0))
    counts = stored(_counts(learn), "lexicon")
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    sure = odds - F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    usable = ~F.col("entry").endswith(" ") | (F.length("entry") <= SHORTEST)  # a short word ends in a space, and so matches as a whole
    kept = counts.filter(usable & (F.col("pos") >= LEAST_DOCS)).withColumn("weight", sure).filter("weight > 1.5").select("entry", "weight")
    model.lexicon = {r["entry"]: min(r["weight"], 6.0) for r in sorted(kept.collect())}
    words = counts.filter(F.col("entry").endswith(" ") & (F.col("neg") >= 3) & (F.col("neg") * (n_pos + 1) >= F.col("pos") * (n_neg + 1)))
    begun = words.withColumn("part", F.explode(F.transform(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)), lambda k: F.substring(F.rtrim("entry"), F.lit(1), k)))).join(F.broadcast(kept.select(F.col("entry").alias("part"))), "part", "left_semi")
    model.exceptions = sorted(r["entry"].strip() for r in begun.select("entry").distinct().collect())
    for p in phrases:
        raw = np.frombuffer(p.encode(), np.uint8)
        model.exceptions.append(folded(raw, np.array([0, len(raw)]))[0].strip())
    check = _hits(rows.filter("half = 1") if apart else rows, model, "y").collect()
    x = features(np.array([(r["total"], r["words"]) for r in check], float).reshape(-1, 2))
    y = np.array([r["id"] for r in check], float)
    model.weights, model.bias = _logistic(x, y, share)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[list[float], float]:
    """Weights by Newton steps with a small ridge; classes weighted to their share among all labels."""
    w = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    xs, beta = np.column_stack([np.ones(len(y)), x]), np.zeros(x.shape[1] + 1)
    ridge = np.diag([1e-6] + [0.5] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(xs @ beta, -30, 30)))
        step = np.linalg.solve(xs.T @ (xs * (w * p * (1 - p))[:, None]) + ridge, xs.T @ (w * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta[1:].tolist(), float(beta[0])


def _hits(rows: DataFrame, model: Model, key: str, text_col: str | None = "text") -> DataFrame:
    """(id, total, words) of each row, with ``key`` as id. Without ``text_col`` the key is a struct that holds the text as ``text``."""
    schema = T.StructType([T.StructField("id", rows.schema[key].dataType), T.StructField("total", T.DoubleType()), T.StructField("words", T.DoubleType())])
    place = None if text_col else rows.schema[key].dataType.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            raw, off = arrow_bytes(batch.column(1) if place is None else batch.column(0).field(place))
            found = [totals(folded(raw[off[a] : off[b]], off[a : b + 1] - off[a]), automaton) for a, b in doc_runs(off)]
            hits = np.concatenate(found) if found else np.zeros((0, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.ascontiguousarray(hits[:, 0])), pa.array(np.ascontiguousarray(hits[:, 1]))], names=schema.names)

    return rows.select(F.col(key), *([F.col(text_col)] if text_col else [])).mapInArrow(run, schema)


def _score(model: Model) -> F.Column:
    total, n = F.col("total"), F.col("words")
    a, b = model.weights
    line = F.lit(model.bias) + F.lit(a) * F.log1p(total) + F.lit(b) * F.log1p(100 * total / (n + 20))
    return 1 / (1 + F.exp(-line))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted, total (weight of the hits) and words."""
    hits = _hits(docs, model, id_col, text_col).withColumn("score", _score(model))
    return hits.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "total", "words")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows whose score lies below the threshold, with the input's columns."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(F.col(text_col).alias("text"), F.struct(*(F.col(c) for c in others)).alias("rest")).alias("row"))
    hits = _hits(rows, model, "row", None).filter(_score(model) < threshold)
    return hits.select(*(F.col("id.text").alias(c) if c == text_col else F.col("id.rest")[c].alias(c) for c in docs.columns))
