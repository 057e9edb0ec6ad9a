"""Byte-level BPE encoding and decoding (operator 2).

Pre-tokenisation never runs a regular expression. Every code point becomes one of twelve
classes, every class is a transition function of a small automaton, and the functions are
composed by an associative scan over whole blocks of text: numpy reduces fixed-width columns,
scans the column totals, and applies the prefixes. Boundaries are read from (state, class).
The slices between boundaries are looked up by a keyed 64-bit hash of their bytes and then
compared byte by byte with the slice that the cache holds, so only slices not met before are
merged; the merging itself works on all new slices at once, one lowest-ranked pair of each
slice per step.

Defined results: null and empty text give no ids; unknown or unassigned code points are
ordinary "other" characters; a special token's string in a text is ordinary text; rows may
repeat; other columns pass through ``encode`` untouched unless they are called as its outputs,
which is an error.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.shared import GOLDEN, arrow_bytes, byte_hashes, doc_runs, fresh_seeds

# Classes of code points.
OTHER, LETTER, DIGIT, SPACE, BLANK, QUOTE, ONE, R, V, L, E, EDGE = range(12)
# States: what the last code points were. AFRESH: start of a text, or just behind a contraction.
AFRESH, IN_LETTERS, IN_DIGITS, IN_OTHER, ON_SPACE, ON_BLANK, ON_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(10)
STATES, CLASSES = 10, 12
_LETTERS = (LETTER, ONE, R, V, L, E)


def _step(state: int, kind: int) -> int:
    if kind == EDGE:
        return AFRESH
    if kind in _LETTERS:
        if state == ON_QUOTE and kind == ONE:
            return AFRESH
        if (state in (QUOTE_R, QUOTE_V) and kind == E) or (state == QUOTE_L and kind == L):
            return AFRESH
        if state == ON_QUOTE:
            return {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}.get(kind, IN_LETTERS)
        return IN_LETTERS
    if kind == QUOTE:
        return IN_OTHER if state in (IN_OTHER, ON_QUOTE, ON_SPACE) else ON_QUOTE
    return {DIGIT: IN_DIGITS, OTHER: IN_OTHER, SPACE: ON_SPACE, BLANK: ON_BLANK}[kind]


def _cuts(state: int, kind: int) -> bool:
    """Whether a slice starts at a character of class ``kind``; white space behind white space is settled later."""
    if kind == EDGE:
        return False
    if state == AFRESH:
        return True
    if state in (ON_SPACE, ON_BLANK):
        return state == ON_BLANK and kind not in (SPACE, BLANK)
    if state in (IN_LETTERS, QUOTE_R, QUOTE_V, QUOTE_L):
        return kind not in _LETTERS
    if state == IN_DIGITS:
        return kind != DIGIT
    if state == ON_QUOTE and kind == ONE:
        return False
    return kind not in (OTHER, QUOTE)


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that the classes generate: generator ids, composition table, action on states."""
    ident = tuple(range(STATES))
    gens = [tuple(_step(s, k) for s in range(STATES)) for k in range(CLASSES)]
    seen, order, at = {ident: 0}, [ident], 0
    while at < len(order):
        f = order[at]
        at += 1
        for g in gens:
            h = tuple(g[f[s]] for s in range(STATES))
            if h not in seen:
                seen[h] = len(order)
                order.append(h)
    table = np.array(order, dtype=np.uint8)
    comp = np.zeros((len(order), len(order)), dtype=np.uint16)
    for i, f in enumerate(order):
        for j, g in enumerate(order):
            comp[i, j] = seen[tuple(g[s] for s in f)]
    return np.array([seen[g] for g in gens], np.uint16), comp, table


_GEN, _COMP, _ACT = _monoid()
_CUT = np.array([[_cuts(s, k) for k in range(CLASSES)] for s in range(STATES)])
_SIZE = len(_ACT)


def states_after(kinds: np.ndarray, width: int = 256) -> np.ndarray:
    """State behind each element, by an associative scan of transition functions."""
    n = len(kinds)
    if not n:
        return np.zeros(0, np.uint8)
    rows = -(-n // width)
    f = np.zeros(rows * width, np.uint16)  # 0 is the identity
    f[:n] = _GEN[kinds]
    cols = np.ascontiguousarray(f.reshape(rows, width).T).astype(np.int32)
    flat = _COMP.reshape(-1)
    for j in range(1, width):
        cols[j] = flat[cols[j - 1] * _SIZE + cols[j]]
    total, shift = cols[-1].copy(), 1
    while shift < rows:  # inclusive scan of the row totals by doubling
        total[shift:] = flat[total[:-shift] * _SIZE + total[shift:]]
        shift *= 2
    before = np.full(rows, AFRESH, np.int32)
    before[1:] = _ACT[total[:-1], AFRESH]
    out = _ACT.reshape(-1)[cols * STATES + before[None, :]]
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


_KINDS: np.ndarray | None = None

# Code points with the Unicode property White_Space.
WHITE_SPACE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Letters and numbers that Unicode 16.0 added, which an older Python still calls unassigned.
LATE = {
    "L": (
        (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
        (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
    ),
    "N": ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)),
}


def kinds_table() -> np.ndarray:
    """Class of each code point, from the general categories of the running Python."""
    global _KINDS
    if _KINDS is None:
        table = np.full(0x110000, OTHER, np.uint8)
        for cp in range(0x110000):
            top = unicodedata.category(chr(cp))[0]
            if top == "L":
                table[cp] = LETTER
            elif top == "N":
                table[cp] = DIGIT
        for name, kind in (("L", LETTER), ("N", DIGIT)):
            for a, b in LATE[name]:
                late = np.arange(a, b + 1)
                table[late[table[late] == OTHER]] = kind
        table[list(WHITE_SPACE)] = BLANK
        table[ord(" ")], table[ord("'")] = SPACE, QUOTE
        for c in "stmd":
            table[ord(c)] = ONE
        table[[ord("r"), ord("v"), ord("l"), ord("e")]] = [R, V, L, E]
        _KINDS = table
    return _KINDS


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and the byte at which each starts."""
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    if len(lead) == len(raw):
        return raw, lead
    b = np.concatenate((raw, np.zeros(3, np.uint8))).astype(np.int32)
    first = b[lead]
    out = first.copy()
    for low, keep, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        at = np.flatnonzero(first >= low)
        value = first[at] & keep
        for k in range(1, more + 1):
            value = (value << 6) | (b[lead[at] + k] & 0x3F)
        out[at] = value
    return out, lead


def slice_starts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bytes at which slices start, over documents whose bytes are off[d]..off[d + 1]."""
    cps, lead = code_points(raw)
    kinds = kinds_table()[cps]
    docs = np.searchsorted(lead, off[:-1])
    kinds = np.append(np.insert(kinds, docs, EDGE), EDGE)
    lead = np.append(np.insert(lead, docs, -1), -1)
    after = states_after(kinds)
    before = np.empty_like(after)
    before[0], before[1:] = AFRESH, after[:-1]
    cut = _CUT[before, kinds]
    white = (kinds == SPACE) | (kinds == BLANK)
    ahead = np.zeros(len(kinds), bool)  # behind white space, and with neither white space nor the end next
    ahead[1:-1] = white[1:-1] & white[:-2] & ~white[2:] & (kinds[2:] != EDGE)
    cut |= ahead
    done = np.flatnonzero((after == AFRESH) & (before >= QUOTE_R) & (kinds != EDGE))
    cut[done - 1] = False  # the second letter completes a contraction
    return lead[np.flatnonzero(cut)]


class Vocabulary:
    """Merge table and token bytes of one vocabulary file (``.tiktoken`` ranks or a ``tokenizers`` JSON)."""

    def __init__(self, path: str) -> None:
        pairs: list[tuple[int, int, int, int]] = []
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                model = json.load(f)["model"]
            back = {c: b for b, c in _byte_letters().items()}
            vocab = model["vocab"]
            size = max(vocab.values()) + 1
            self.tokens = [b""] * size
            for word, i in vocab.items():
                self.tokens[i] = bytes(back[c] for c in word)
            for rank, merge in enumerate(model["merges"]):
                a, b = merge.split(" ") if isinstance(merge, str) else merge
                pairs.append((vocab[a], vocab[b], rank, vocab[a + b]))
        else:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}
            self.tokens = [b""] * (max(ranks.values()) + 1)
            for t, i in ranks.items():
                self.tokens[i] = t
                for k in range(1, len(t)):
                    a, b = ranks.get(t[:k]), ranks.get(t[k:])
                    if a is not None and b is not None:
                        pairs.append((a, b, i, i))
        table = np.array(sorted((a << 32 | b, rank, new) for a, b, rank, new in pairs), dtype=np.int64)
        self.keys, self.ranks, self.made = (np.ascontiguousarray(table[:, k]) for k in range(3))
        single = {t: i for i, t in enumerate(self.tokens) if len(t) == 1}
        self.of_byte = np.array([single[bytes([b])] for b in range(256)], np.int64)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.lengths)))
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        # open addressing on the pair key, for lookups without a binary search
        bits = max(4, int(len(self.keys) * 4 - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int64)
        todo = np.arange(len(self.keys))
        where = ((self.keys.astype(np.uint64) * np.uint64(GOLDEN)) >> self.shift).astype(np.int64)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.slots[where[todo]] < 0
            self.slots[where[todo[free]]] = todo[free]
            todo = todo[self.slots[where[todo]] != todo]
            where[todo] = (where[todo] + 1) & (len(self.slots) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in the merge table, or -1."""
        key = (left << 32) | right
        at = ((key.astype(np.uint64) * np.uint64(GOLDEN)) >> self.shift).astype(np.int64)
        found = self.slots[at]
        hit = (found >= 0) & (self.keys[found] == key)
        out = np.where(hit, found, -1)
        todo = np.flatnonzero((found >= 0) & ~hit)
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
            found = self.slots[at[todo]]
            same = (found >= 0) & (self.keys[found] == key[todo])
            out[todo[same]] = found[same]
            todo = todo[(found >= 0) & ~same]
        return out

    def merge(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices one after another, and how many each has."""
        out: list[np.ndarray | None] = [None] * len(slices)
        short = []
        for i, s in enumerate(slices):
            if len(s) > 256:
                out[i] = self._merge_long(s)
            else:
                short.append(i)
        if short:
            sizes = np.array([len(slices[i]) for i in short], np.int64)
            ids = self.of_byte[np.frombuffer(b"".join(slices[i] for i in short), np.uint8)]
            owner = np.repeat(np.arange(len(short)), sizes)
            done_ids, done_owner = [], []
            big = np.int64(1 << 40)
            while len(ids):
                pair = np.full(len(ids), -1, np.int64)
                pair[:-1] = np.where(owner[:-1] == owner[1:], self.find(ids[:-1], ids[1:]), -1)
                rank = np.where(pair >= 0, self.ranks[pair], big)
                heads, counts = np.flatnonzero(np.diff(owner, prepend=-1)), None
                best = np.minimum.reduceat(rank, heads)
                counts = np.diff(np.append(heads, len(ids)))
                low = np.repeat(best, counts)
                going = low < big
                if not going.all():
                    done_ids.append(ids[~going])
                    done_owner.append(owner[~going])
                    ids, owner, rank, low, pair = ids[going], owner[going], rank[going], low[going], pair[going]
                    if not len(ids):
                        break
                hits = np.flatnonzero(rank == low)
                first = hits[np.flatnonzero(np.diff(owner[hits], prepend=-1))]  # leftmost of each slice
                ids = ids.copy()
                ids[first] = self.made[pair[first]]
                keep = np.ones(len(ids), bool)
                keep[first + 1] = False
                ids, owner = ids[keep], owner[keep]
            all_ids, all_owner = np.concatenate(done_ids), np.concatenate(done_owner)
            order = np.argsort(all_owner, kind="stable")
            all_ids = all_ids[order]
            cut = np.searchsorted(all_owner[order], np.arange(len(short) + 1))
            if len(short) == len(slices):
                return all_ids, np.diff(cut)
            for k, i in enumerate(short):
                out[i] = all_ids[cut[k] : cut[k + 1]]
        counts = np.array([len(x) for x in out], np.int64)
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), counts

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One long slice with a heap of candidate pairs, O(n log n)."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        found = self.find(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(self.ranks[f]), i, ids[i], ids[i + 1], int(self.made[f])) for i, f in enumerate(found.tolist()) if f >= 0]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                f = int(self.find(np.array([ids[i]]), np.array([ids[j]]))[0])
                if f >= 0:
                    heapq.heappush(heap, (int(self.ranks[f]), i, ids[i], ids[j], int(self.made[f])))

        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = new, False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the byte offset of each (one more than ids)."""
        sizes = self.lengths[ids]
        off = np.concatenate(([0], np.cumsum(sizes)))
        return self.bytes[spread(self.begins[ids], sizes, off)], off


def spread(begin: np.ndarray, sizes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Indices begin[k], begin[k] + 1, ... for each k, one run after another."""
    return np.repeat(begin - off[:-1], sizes) + np.arange(off[-1])


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Encodes blocks of documents, keeping ids of slices met before. One per Python worker and vocabulary."""

    def __init__(self, path: str, most: int = 200_000) -> None:
        self.vocab, self.most, self.seed = Vocabulary(path), most, fresh_seeds(1)[0]
        self._clear()

    def _clear(self) -> None:
        self.slot_of: dict[int, int] = {}
        self.slots = self.used = self.filled = 0
        self.flat = np.zeros(1 << 16, np.uint16 if len(self.vocab.tokens) <= 1 << 16 else np.int32)
        self.held = np.zeros(1 << 16, np.uint8)
        # of each slot: its ids in ``flat`` and its bytes in ``held``
        self.begin, self.size, self.byte_begin, self.byte_size = (np.zeros(1 << 14, np.int64) for _ in range(4))

    def _add(self, slices: list[bytes]) -> int:
        """Merges the slices and keeps them in new slots; returns the first."""
        ids, counts = self.vocab.merge(slices)
        first, n = self.slots, len(slices)
        self.slots += n
        self.begin, self.size, self.byte_begin, self.byte_size = (_room(x, self.slots) for x in (self.begin, self.size, self.byte_begin, self.byte_size))
        data, lengths = np.frombuffer(b"".join(slices), np.uint8), np.array([len(x) for x in slices], np.int64)
        self.flat, self.held = _room(self.flat, self.used + len(ids)), _room(self.held, self.filled + len(data))
        self.flat[self.used : self.used + len(ids)], self.held[self.filled : self.filled + len(data)] = ids, data
        at = slice(first, self.slots)
        self.begin[at], self.size[at] = self.used + np.cumsum(counts) - counts, counts
        self.byte_begin[at], self.byte_size[at] = self.filled + np.cumsum(lengths) - lengths, lengths
        self.used, self.filled = self.used + len(ids), self.filled + len(data)
        return first

    def _differing(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, each: np.ndarray) -> np.ndarray:
        """Slices whose bytes are not those of their slot. Slices cover all bytes, one after another."""
        own = self.byte_size[each]
        if not (own == sizes).all():
            wrong = own != sizes
            right = np.flatnonzero(~wrong)
            off = np.concatenate(([0], np.cumsum(sizes[right])))
            bad = self.held[spread(self.byte_begin[each[right]], sizes[right], off)] != raw[spread(starts[right], sizes[right], off)]
            wrong[right[np.searchsorted(off, np.flatnonzero(bad), side="right") - 1]] = True
            return np.flatnonzero(wrong)
        off = np.concatenate(([0], np.cumsum(sizes)))
        bad = np.flatnonzero(self.held[spread(self.byte_begin[each], sizes, off)] != raw[starts[0] :])
        return np.unique(np.searchsorted(off, bad, side="right") - 1) if len(bad) else bad

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids over all documents, their count in each document, and the byte at which each slice starts."""
        starts = slice_starts(raw, off)
        if not len(starts):
            return np.zeros(0, self.flat.dtype), np.zeros(len(off) - 1, np.int64), starts
        stops = np.append(starts[1:], len(raw))
        key = byte_hashes(raw, starts, stops, self.seed)
        uniq, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        if self.slots + len(uniq) > self.most or self.filled > 64 << 20:
            self._clear()
        names = uniq.tolist()
        slot = np.fromiter(map(self.slot_of.get, names, [-1] * len(names)), np.int64, len(names))
        new = np.flatnonzero(slot < 0)
        if len(new):
            data, a, b = raw.tobytes(), starts[at[new]].tolist(), stops[at[new]].tolist()
            first = self._add([data[x:y] for x, y in zip(a, b, strict=True)])
            slot[new] = np.arange(first, first + len(new))
            self.slot_of.update(zip(uniq[new].tolist(), range(first, first + len(new)), strict=True))
        each = slot[inverse]
        strange = self._differing(raw, starts, stops - starts, each)
        if len(strange):  # another slice with the same hash: merged on its own and not looked up again
            data = raw.tobytes()
            first = self._add([data[x:y] for x, y in zip(starts[strange].tolist(), stops[strange].tolist(), strict=True)])
            each[strange] = np.arange(first, first + len(strange))
        sizes = self.size[each]
        tok_off = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[spread(self.begin[each], sizes, tok_off)]
        per_doc = np.diff(tok_off[np.searchsorted(starts, off)])
        return ids, per_doc, starts


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if len(a) >= n:
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for this vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """Adds ``ids`` (array<int>) and ``offsets`` (array<int>, byte in the text at which each id's bytes start)."""
    if {"ids", "offsets"} & set(docs.columns):
        raise ValueError("the input already has a column ids or offsets")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("offsets", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            raw, off = arrow_bytes(batch.column(text_col))
            for a, b in doc_runs(off):
                part, part_off = raw[off[a] : off[b]], off[a : b + 1] - off[a]
                ids, counts, _ = enc.encode(part, part_off)
                cut = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = ids.astype(np.int32)
                at = np.cumsum(enc.vocab.lengths[ids]) - enc.vocab.lengths[ids] - np.repeat(part_off[:-1], counts)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (ids, at)]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *lists], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of the ids in order; null ids count as none."""
    if "decoded" in encoded.columns:
        raise ValueError("the input already has a column decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = encoder(vocabulary).vocab
        for batch in batches:
            rows = []
            for ids in batch.column(ids_col):
                flat = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.zeros(0, np.int64)
                rows.append(vocab.decode(flat)[0].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text, decodes the ids, and returns digests of both: id, n_tokens, ids_sha256, decoded_sha256.

    Encoder and decoder are those of ``encode`` and ``decode``; ids stay inside the Python worker.
    """
    key = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, key), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            raw, off = arrow_bytes(batch.column(1))
            n, of_ids, of_bytes = [], [], []
            for a, b in doc_runs(off):
                ids, counts, _ = enc.encode(raw[off[a] : off[b]], off[a : b + 1] - off[a])
                data, at = enc.vocab.decode(ids)
                wide = ids.astype("<u4")
                cut = np.concatenate(([0], np.cumsum(counts))).tolist()
                for x, y in zip(cut, cut[1:], strict=False):
                    of_ids.append(hashlib.sha256(wide[x:y]).hexdigest())
                    of_bytes.append(hashlib.sha256(data[at[x] : at[y]]).hexdigest())
                n.append(counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64)), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
