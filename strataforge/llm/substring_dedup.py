"""Substring deduplication (operator 5).

Every window of ``width`` consecutive words gets a Rabin-Karp hash modulo the prime 2^61 - 1, with
a base drawn for each run, and Spark counts all of them by value (``repeats``) in two steps. First
the hashes' leading bits (eight more than the number of windows needs), which tell nearly all
windows that occur once; then, for the windows that are left, the whole hash and a second one with
another base and other word hashes: 122 bits. Windows that both steps find again, in the same
document or another, are merged into maximal removal intervals, and the words inside go.

Among n different windows about n^2 / 2^123 pairs share both hashes, whatever the texts are: none
expected even at 10^15 windows.

Defined results: a null or empty text has no words; a text of fewer words than ``width`` keeps
all; repeated rows are copies of one another, so all their windows repeat; an empty table gives
no rows; other columns pass through ``remove_repeats`` and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.repeats import REPORT, Counter, classes_of, counted, filter_bits, in_blocks, member, repeated_in
from strataforge.llm.shared import Words, arrow_bytes, distinct, doc_runs, fresh_seeds, window_hashes

BITS = 61


class _Windows:
    """All windows of a block's documents, run by run, with their hashes."""

    def __init__(self, table: pa.Table, width: int, seeds: list[int]) -> None:
        raw, off = arrow_bytes(table.column("text"))
        self.width, self.seeds, self.runs, found = width, seeds, [], [np.zeros(0, np.uint64)]
        for a, b in doc_runs(off):
            words = Words(raw[off[a] : off[b]], off[a : b + 1] - off[a])
            values, starts = window_hashes(words.hashes(seeds[0]), words.first, width, seeds[1])
            self.runs.append((words, starts))
            found.append(values)
        self.values = np.concatenate(found)
        self.cut = np.concatenate(([0], np.cumsum([len(x) for _, x in self.runs]))).astype(np.int64)

    def leading(self, bits: int) -> np.ndarray:
        return self.values >> np.uint64(BITS - bits)

    def suspects(self, classes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose leading bits another block has too, and those whose leading bits occur twice in this block."""
        short = self.leading(bits)
        known = distinct(short)
        elsewhere = classes[np.searchsorted(known, short)] > 0 if len(known) else np.zeros(0, bool)
        return elsewhere, member(short, repeated_in(short))

    def second(self, pick: np.ndarray) -> np.ndarray:
        """Second hash of the picked windows, in order."""
        out = [np.zeros(0, np.uint64)]
        for (words, _), a, b in zip(self.runs, self.cut[:-1], self.cut[1:], strict=True):
            if pick[a:b].any():
                out.append(window_hashes(words.hashes(self.seeds[2]), words.first, self.width, self.seeds[3])[0][pick[a:b]])
        return np.concatenate(out)


def _pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, the place of each given pair among them, and how often each occurs."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return a[fresh], b[fresh], place, np.bincount(place, minlength=int(fresh.sum()))


def _covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _kept_bytes(words: Words, gone: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words of all documents, a space behind each, and where each document starts."""
    left = ~gone
    sizes = np.where(left, words.end - words.begin + 1, 0)
    off = np.concatenate(([0], np.cumsum(sizes)))
    at = np.repeat(words.begin - off[:-1], sizes) + np.arange(off[-1])
    padded = np.append(words.raw, np.uint8(32))
    out = padded[np.minimum(at, len(words.raw))]
    out[off[1:][left] - 1] = 32
    return out.tobytes(), off[words.first]


OUT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
        T.StructField("kept_sha256", T.StringType()),
    ]
)
_INTERVALS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def repeated_spans(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row a document: id, n_words, n_removed, removed (intervals of word positions), kept_sha256.

    ``with_text`` adds the text itself and ``kept`` (the kept words joined by one space).
    """
    blocks, n_blocks, total = in_blocks(docs, id_col, text_col)
    guess = max(1, total // 6)  # windows, about
    bits, seeds = filter_bits(guess), fresh_seeds(4)
    coarse, fine = Counter(n_blocks, guess, bits), Counter(n_blocks, guess, BITS)
    step = lambda df, k: df.withColumn("step", F.lit(k))
    first = step(counted(blocks, coarse, lambda t: distinct(_Windows(t, width, seeds).leading(bits))), 0)

    def report(table: pa.Table, returned: pa.Table) -> pa.Table:
        block = _Windows(table, width, seeds)
        elsewhere, _ = block.suspects(classes_of(returned), bits)
        a, b, _, _ = _pairs(block.values[elsewhere], block.second(elsewhere))
        return fine.report(table.column("block")[0].as_py(), a, b)

    second = step(fine.totals(blocks.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(report, REPORT)), 1)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *OUT.fields, *([T.StructField(text_col, T.StringType()), T.StructField("kept", T.StringType())] if with_text else [])])

    def mark(table: pa.Table, returned: pa.Table) -> pa.Table:
        at = returned.column("step").to_numpy()
        block = _Windows(table, width, seeds)
        elsewhere, here = block.suspects(classes_of(returned.filter(pa.array(at == 0))), bits)
        either = elsewhere | here
        _, _, place, times = _pairs(block.values[either], block.second(either))
        # the pairs that were reported: those of windows that are elsewhere
        told = np.zeros(len(times), bool)
        told[place[elsewhere[either]]] = True
        again = times > 1
        again[told] |= classes_of(returned.filter(pa.array(at == 1))) > 0
        twice = np.zeros(len(either), bool)
        twice[either] = again[place]
        n_words, n_gone, spans, shas, kept = [], [], [], [], []
        for (words, starts), x, y in zip(block.runs, block.cut[:-1], block.cut[1:], strict=True):
            gone = _covered(len(words.begin), starts[twice[x:y]], width)
            data, doc_at = _kept_bytes(words, gone)
            n_words.append(np.diff(words.first))
            total_gone = np.concatenate(([0], np.cumsum(gone)))
            n_gone.append(np.diff(total_gone[words.first]))
            # an interval starts where a word goes and the one before stays or belongs to another document
            head = np.zeros(len(gone) + 1, bool)
            head[words.first] = True
            prior = np.concatenate(([False], gone[:-1])) if len(gone) else gone
            begin = np.flatnonzero(gone & (~prior | head[:-1]))
            follows = np.append(gone[1:], False) if len(gone) else gone
            stop = np.flatnonzero(gone & (~follows | head[1:])) + 1
            of = np.searchsorted(begin, words.first)
            for d, (u, v) in enumerate(zip(doc_at.tolist(), doc_at.tolist()[1:], strict=False)):
                text = data[u : max(u, v - 1)]
                shas.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    kept.append(text.decode())
                base = int(words.first[d])
                spans.append([{"start": int(p) - base, "stop": int(q) - base} for p, q in zip(begin[of[d] : of[d + 1]], stop[of[d] : of[d + 1]], strict=True)])
        flat = lambda xs: pa.array(np.concatenate(xs) if xs else np.zeros(0, np.int64), pa.int64())
        columns = [table.column("id"), flat(n_words), flat(n_gone), pa.array(spans, _INTERVALS), pa.array(shas, pa.string())]
        if with_text:
            columns += [table.column("text"), pa.array(kept, pa.string())]
        return pa.table(columns, names=schema.names)

    return blocks.groupBy("block").cogroup(first.unionByName(second).groupBy("block")).applyInArrow(mark, schema)


def remove_repeats(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with repeated windows cut out: such a text becomes its kept words joined by one space.

    A text without repeated windows stays as it is, and no row is dropped. ``length_col``, if the
    table has it, becomes the new text's length in characters where the text changed.
    """
    spans = repeated_spans(docs.select(F.struct(*(F.col(c) for c in docs.columns if c != text_col)).alias("row"), F.col(text_col).alias("text")), width, "row", "text", with_text=True)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(text.alias(c))
        elif c == length_col:
            columns.append(F.when(changed, F.length("kept").cast(docs.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c))
        else:
            columns.append(F.col("row")[c].alias(c))
    return spans.select(*columns)
