"""Quality classifier (operator 9): attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded: the mean of learned
embeddings of its words (lower-cased and hashed to ``BUCKETS``) and a learned map of counts over its
bytes and words, through tanh. Gated attention, tanh times sigmoid, weighs the passages of a bag;
the weighted mean of their encodings is scored by a logistic output. Only document labels are
learned from. All passages of all documents are encoded and scored; training reads a bounded
sample of labelled documents (``TRAIN_DOCS`` of each class, of ``training.LONGEST`` bytes at most),
all passages of each, in mini-batches.

Defined results: a null or empty text, or one without words, is one empty passage; without labels,
or with one class only, every score is the share of label 1 (0.5 without labels). Rows are scored
one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.shared import Words, arrow_bytes, doc_runs
from strataforge.llm.training import held_out, sample

TRAIN_DOCS = 2_000  # of each class
PASSAGE = 48
BUCKETS = 4096
HIDDEN, ATTENTION = 16, 8
EPOCHS, BATCH, RATE = 12, 128, 0.01
WORD_SEED = 1  # of the words' hashes: the same in training and scoring

_CLASSES = 8


def _class_table() -> np.ndarray:
    """Class of each byte: upper, lower, digit, bracketing signs, exclamation, other signs, beyond ASCII, line feed."""
    t = np.full(256, 5, np.uint8)
    t[65:91], t[97:123], t[48:58] = 0, 1, 2
    for c in "#*$%&|<>":
        t[ord(c)] = 3
    t[ord("!")], t[128:], t[10] = 4, 6, 7
    t[[9, 11, 12, 13, 32]] = 8
    return t


_CLASS = _class_table()
N_FEATURES = _CLASSES + 10


@dataclass
class Bags:
    """Passages of some documents: features, the first passage of each document (one more than documents), and the words' buckets with their passages."""

    x: np.ndarray
    first: np.ndarray
    words: np.ndarray
    place: np.ndarray

    def means(self, table: np.ndarray) -> np.ndarray:
        """Mean of the rows of ``table`` that each passage's words name; zero without words."""
        out = np.zeros((len(self.x), table.shape[1]), table.dtype)
        if len(self.words):
            heads = np.flatnonzero(np.diff(self.place, prepend=-1))
            counts = np.diff(np.append(heads, len(self.words)))
            out[self.place[heads]] = np.add.reduceat(table[self.words], heads, axis=0) / counts[:, None].astype(table.dtype)
        return out

    def spread(self, grads: np.ndarray, rows: int) -> np.ndarray:
        """The gradient of ``means``: each passage's gradient, shared among its words, summed for each bucket."""
        out = np.zeros((rows, grads.shape[1]))
        if len(self.words):
            share = grads / np.maximum(np.bincount(self.place, minlength=len(grads)), 1)[:, None]
            order = np.argsort(self.words, kind="stable")
            heads = np.flatnonzero(np.diff(self.words[order].astype(np.int64), prepend=-1))
            out[self.words[order][heads]] = np.add.reduceat(share[self.place[order]], heads, axis=0)
        return out


def passages(raw: np.ndarray, off: np.ndarray) -> Bags:
    """All passages of the documents whose bytes are off[d]..off[d + 1]."""
    words = Words(raw, off, lower=False)
    counts = np.diff(words.first)
    bags = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate(([0], np.cumsum(bags)))
    n = int(first[-1])
    out = np.zeros((n, N_FEATURES), np.float32)
    if not len(words.begin):
        return Bags(out, first, np.zeros(0, np.uint16), np.zeros(0, np.int64))
    doc = np.repeat(np.arange(len(counts)), counts)
    place = first[doc] + (np.arange(len(doc)) - words.first[doc]) // PASSAGE  # passage of each word
    per = np.bincount(place, minlength=n).astype(np.float64)
    # bytes from a passage's first word to the next passage's, or the document's end
    full = np.flatnonzero(per)
    head = np.flatnonzero(np.diff(place, prepend=-1))
    begin = words.begin[head]
    stop = np.minimum(np.append(begin[1:], len(raw)), off[1:][doc[head]])
    sums = np.zeros((n, _CLASSES))
    kinds = _CLASS[raw]
    for k in range(_CLASSES):
        total = np.concatenate(([0], np.cumsum(kinds == k)))
        sums[full, k] = total[stop] - total[begin]
    size = np.zeros(n)
    size[full] = stop - begin
    length = (words.end - words.begin).astype(np.float64)
    hashes = Words(raw, off, lower=True).hashes(WORD_SEED)
    mean = np.bincount(place, length, n) / np.maximum(per, 1)
    square = np.bincount(place, length**2, n) / np.maximum(per, 1)
    order = np.lexsort((hashes, place))
    hp, hh = place[order], hashes[order]
    fresh = np.concatenate(([True], (hp[1:] != hp[:-1]) | (hh[1:] != hh[:-1])))
    distinct = np.bincount(hp[fresh], minlength=n)
    runs = np.flatnonzero(fresh)
    most = np.zeros(n)
    np.maximum.at(most, hp[runs], np.diff(np.append(runs, len(hp))))
    same = np.zeros(len(place), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (place[1:] == place[:-1])
    echo = np.bincount(place[same], minlength=n)
    tail = _CLASS[raw[words.end - 1]]
    out[:, :_CLASSES] = sums / np.maximum(size, 1)[:, None]
    extra = (
        np.log1p(per) / 4, mean / 10, np.sqrt(np.maximum(square - mean**2, 0)) / 10, distinct / np.maximum(per, 1), most / np.maximum(per, 1), echo / np.maximum(per, 1),
        np.bincount(place, length <= 3, n) / np.maximum(per, 1), np.bincount(place, length == 1, n) / np.maximum(per, 1), np.bincount(place, tail == 3, n) / np.maximum(per, 1), np.bincount(place, (tail == 4) | (tail == 5), n) / np.maximum(per, 1),
    )
    for k, v in enumerate(extra):
        out[:, _CLASSES + k] = v
    return Bags(out, first, (hashes % np.uint64(BUCKETS)).astype(np.uint16), place)


@dataclass
class Model:
    """Weights of encoder, gated attention and output; without them the score is ``share``."""

    share: float = 0.5
    weights: dict[str, np.ndarray] | None = None


def forward(w: dict[str, np.ndarray], bags: Bags) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Logit of each bag, and what the gradient needs."""
    x, first = (bags.x - w["mean"]) / w["scale"], bags.first
    h = np.tanh(x @ w["W"] + bags.means(w["E"]) + w["b"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    e = (t * g) @ w["a"]
    heads, bag = first[:-1], np.repeat(np.arange(len(first) - 1), np.diff(first))
    e = e - np.maximum.reduceat(e, heads)[bag]
    e = np.exp(e)
    att = e / np.add.reduceat(e, heads)[bag]
    z = np.add.reduceat(h * att[:, None], heads, axis=0)
    return z @ w["c"] + w["d"], {"x": x, "h": h, "t": t, "g": g, "att": att, "z": z, "bag": bag}


def _gradients(w: dict[str, np.ndarray], k: dict[str, np.ndarray], delta: np.ndarray, bags: Bags) -> dict[str, np.ndarray]:
    """Of the loss whose derivative by the logits is ``delta``."""
    dz = delta[:, None] * w["c"]
    of = dz[k["bag"]]
    dh = k["att"][:, None] * of
    own = (k["h"] * of).sum(1)
    de = k["att"] * (own - np.add.reduceat(k["att"] * own, bags.first[:-1])[k["bag"]])
    dt, dg = de[:, None] * w["a"] * k["g"] * (1 - k["t"] ** 2), de[:, None] * w["a"] * k["t"] * k["g"] * (1 - k["g"])
    dh = dh + dt @ w["V"].T + dg @ w["U"].T
    dp = dh * (1 - k["h"] ** 2)
    return {"c": k["z"].T @ delta, "d": delta.sum(), "a": (k["t"] * k["g"]).T @ de, "V": k["h"].T @ dt, "U": k["h"].T @ dg, "W": k["x"].T @ dp, "b": dp.sum(0), "E": bags.spread(dp, len(w["E"]))}


def _batches(docs: list[Bags], y: np.ndarray, r: np.random.Generator):
    """Mini-batches of documents in a random order."""
    order = r.permutation(len(docs))
    for a in range(0, len(order), BATCH):
        picked = order[a : a + BATCH]
        part = [docs[i] for i in picked]
        sizes = [len(p.x) for p in part]
        first = np.concatenate(([0], np.cumsum(sizes)))
        place = np.concatenate([p.place + f for p, f in zip(part, first[:-1], strict=True)])
        yield Bags(np.concatenate([p.x for p in part]).astype(np.float64), first, np.concatenate([p.words for p in part]), place), picked


def train(docs: list[Bags], y: np.ndarray, share: float, seed: int = 7) -> Model:
    """Adam on the logistic loss over mini-batches, classes weighted to their share among all labels."""
    r = np.random.default_rng(seed)
    x = np.concatenate([d.x for d in docs]).astype(np.float64)
    w = {"mean": x.mean(0), "scale": x.std(0) + 1e-3, "W": r.normal(0, 0.3, (x.shape[1], HIDDEN)), "E": r.normal(0, 0.01, (BUCKETS, HIDDEN)), "b": np.zeros(HIDDEN), "V": r.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": r.normal(0, 0.3, (HIDDEN, ATTENTION)), "a": r.normal(0, 0.3, ATTENTION), "c": r.normal(0, 0.3, HIDDEN), "d": np.float64(0.0)}
    cost = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    learned = [k for k in w if k not in ("mean", "scale")]
    m, v = ({k: np.zeros_like(w[k]) for k in learned} for _ in range(2))
    step, epochs = 0, max(EPOCHS, -(-200 * BATCH // len(docs)))  # few documents are seen more often
    for _ in range(epochs):
        for bags, picked in _batches(docs, y, r):
            step += 1
            logit, kept = forward(w, bags)
            grads = _gradients(w, kept, cost[picked] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[picked]) / len(picked), bags)
            for k in learned:
                g = grads[k] + (1e-4 if k == "E" else 1e-5) * w[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g**2
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(share, w)


def _bags(rows: DataFrame) -> DataFrame:
    """(y, id, x, words, place) of each training document: all its passages."""
    kind = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("id", rows.schema["id"].dataType), *(T.StructField(c, T.BinaryType()) for c in ("x", "words", "place"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = arrow_bytes(batch.column(0))
            for a, b in doc_runs(off):
                docs = [passages(raw[off[k] : off[k + 1]], np.array([0, off[k + 1] - off[k]])) for k in range(a, b)]
                blobs = [[d.x.tobytes() for d in docs], [d.words.tobytes() for d in docs], [d.place.astype(np.int32).tobytes() for d in docs]]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), *(pa.array(x, pa.binary()) for x in blobs)], names=kind.names)

    return rows.select("text", "y", "id").mapInArrow(run, kind)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> Model:
    """Learns from at most ``most`` training documents of each class, which are sent to the driver as features."""
    rows, share = sample(docs, labels, label, most, id_col, text_col)
    got = sorted(_bags(rows).collect(), key=lambda r: r["id"])
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return Model(share)
    found = []
    for r in got:
        x = np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES)
        found.append(Bags(x, np.array([0, len(x)]), np.frombuffer(r["words"], np.uint16), np.frombuffer(r["place"], np.int32).astype(np.int64)))
    return train(found, y, share)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted, n_passages and attention (the largest weight that a passage got)."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("n_passages", T.LongType()), T.StructField("attention", T.DoubleType())])
    weights, share = model.weights, model.share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = {k: np.asarray(v, np.float32) for k, v in weights.items()} if weights else None
        for batch in batches:
            raw, off = arrow_bytes(batch.column(1))
            for a, b in doc_runs(off):
                bags = passages(raw[off[a] : off[b]], off[a : b + 1] - off[a])
                first = bags.first
                if w is None:
                    p, top = np.full(b - a, share), 1 / np.diff(first)
                else:
                    logit, kept = forward(w, bags)
                    p, top = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -500, 500))), np.maximum.reduceat(kept["att"], first[:-1]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(p), pa.array(np.diff(first)), pa.array(top)], names=schema.names)

    found = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
    return found.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages", "attention")
