"""Helpers shared by the training-data operators.

* ``work_folder`` hands out folders below ``spark.checkpoint.dir``, the one place that the
  driver and all executors share; ``Scratch`` deletes those that a run no longer needs.
* The numpy half turns Arrow string columns into word arrays and hashes without ever building
  a Python string per word. All hashes are keyed by seeds drawn for each run (``fresh_seeds``).
"""

from __future__ import annotations

import hashlib
import secrets
import tempfile
import threading
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of code points other than these six.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WHITE_PATTERN = r"[\x20\x09-\x0D]+"

_MASK = (1 << 64) - 1
#: The golden ratio's 64 bits, for multiplicative hashing of table keys.
GOLDEN = 0x9E3779B97F4A7C15
#: Modulus of the polynomial hashes: a Mersenne prime, so that no sequence collides by its form.
PRIME = (1 << 61) - 1


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder URI below the cluster's shared checkpoint folder.

    Only where ``spark.checkpoint.dir`` is unset and the master is local is a folder chosen here,
    and it is then also set as the session's checkpoint folder. On a cluster that is an error, as
    the executors' folders cannot be seen from the driver.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _context_folder(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strataforge-")
        spark.sparkContext.setCheckpointDir(base)
    if "://" not in base and base.startswith("/"):
        base = "file://" + base
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _context_folder(spark: SparkSession) -> str | None:
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    return found.get() if found.isDefined() else None


#: Spark's switch to delete a query's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _USERS = threading.Lock(), {"n": 0, "before": None}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files behind. Threads share the switch: the last one out sets it back."""
    with _LOCK:
        if not _USERS["n"]:
            _USERS["before"] = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _USERS["n"] += 1
    try:
        yield
    finally:
        with _LOCK:
            _USERS["n"] -= 1
            if not _USERS["n"]:
                spark.conf.set(SHUFFLE_CLEANUP, _USERS["before"])


def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as Parquet to a shared folder and reads it again: cuts lineage, survives executors.

    The shuffle files behind it are of no use afterwards and are deleted at once.
    """
    return _written(df, work_folder(df.sparkSession, label))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark reads; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Tables of one run in the shared folder. ``drop`` deletes some early; leaving the context deletes the rest.

    What the run returns is written by ``stored`` instead and stays.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.held: list[tuple[DataFrame, str, str | None]] = []  # table, folder, name in the catalogue

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*(x[0] for x in self.held))

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        """As the function ``stored``, for this run only."""
        path = work_folder(self.spark, label)
        out = _written(df, path)
        self.held.append((out, path, None))
        return out

    def bucketed(self, df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
        """As ``stored``, one row a ``key``, bucketed and sorted by it: joins on it leave this table where it is."""
        path, name = work_folder(self.spark, label), f"{label}_{uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            df.repartition(buckets, key).dropDuplicates([key]).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
        out = self.spark.table(name)
        self.held.append((out, path, name))
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for entry in [x for x in self.held if any(x[0] is t for t in tables)]:
            self.held.remove(entry)
            _, path, name = entry
            if name:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_folder(self.spark, path)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes over all rows, for choosing block counts."""
    row = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()
    return int(row[0] or 0)


def fresh_seeds(n: int) -> list[int]:
    """Seeds for one run, from the system's random source; drawn on the driver, so that retried tasks use the same."""
    return [secrets.randbits(60) | 1 for _ in range(n)]


# --------------------------------------------------------------------------- numpy


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo ``PRIME``, for values below it."""
    low = np.uint64(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> np.uint64(32), a & low, b >> np.uint64(32), b & low
    out = a1 * b1 << np.uint64(3)  # 2^64 is 8
    mid = a1 * b0
    mid += a0 * b1
    out += mid >> np.uint64(29)
    mid &= np.uint64((1 << 29) - 1)
    mid <<= np.uint64(32)
    out += mid
    tail = a0 * b0
    out += tail >> np.uint64(61)
    tail &= np.uint64(PRIME)
    out += tail
    return _reduced(out)


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any unsigned 64-bit values modulo ``PRIME``."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    x -= np.uint64(PRIME) * (x >= np.uint64(PRIME))
    return x


class _PowerTable:
    """Powers of a base and of its inverse modulo ``PRIME``, grown by doubling."""

    def __init__(self, base: int) -> None:
        self.base = (base % PRIME) or 3
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            have = len(self.up)
            inverse = pow(self.base, -1, PRIME)
            step, back = (np.full(have, pow(b, have, PRIME), np.uint64) for b in (self.base, inverse))
            self.up, self.down = np.concatenate((self.up, mulmod(self.up, step))), np.concatenate((self.down, mulmod(self.down, back)))
        return self.up, self.down


_TABLES: dict[int, _PowerTable] = {}


def _table(seed: int) -> _PowerTable:
    if seed not in _TABLES:
        if len(_TABLES) > 4:
            _TABLES.clear()
        _TABLES[seed] = _PowerTable(seed)
    return _TABLES[seed]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that high and low bits are usable alike."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (one more than rows) of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


class Words:
    """Word positions of a run of documents. Word w of document d has index first[d] <= w < first[d + 1]."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, lower: bool = False) -> None:
        self.raw = _LOWER[raw] if lower else raw
        self.off = off
        n = len(raw)
        white = np.ones(n + 2, dtype=bool)
        white[1:-1] = _IS_WHITE[raw]
        begins = ~white[1:-1] & white[:-2]
        ends = ~white[1:-1] & white[2:]
        inner = off[1:-1]
        at = inner[(inner > 0) & (inner < n)]  # documents meet without white space between them
        begins[at] |= ~white[1:-1][at]
        ends[at - 1] |= ~white[1:-1][at - 1]
        self.begin, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begin, off)

    def hashes(self, seed: int) -> np.ndarray:
        """64 bits for each word, from its bytes and its length."""
        return byte_hashes(self.raw, self.begin, self.end, seed)


def byte_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64 bits for each slice of bytes. Slices of up to eight bytes and equal length never collide; long ones are hashed by BLAKE2."""
    size = end - begin
    if not len(size):
        return np.zeros(0, np.uint64)
    key = np.uint64(seed)
    h = mix64(size.astype(np.uint64) * np.uint64(GOLDEN) ^ key)
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    loads = np.ndarray((len(raw) + 1,), "<u8", padded, 0, (1,))
    keep = np.array([(1 << 8 * k) - 1 for k in range(8)] + [_MASK], np.uint64)
    at, own = np.arange(len(size)), np.minimum(size, 64)
    for step in range(0, 64, 8):
        if step:
            live = own[at] > step
            if not live.any():
                break
            at = at[live]
        part = loads[begin[at] + step] & keep[np.minimum(own[at] - step, 8)]
        h[at] = mix64((h[at] ^ part) * np.uint64(GOLDEN) + key)
    for k in np.flatnonzero(size > 64).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(raw[begin[k] : end[k]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little")
    return h


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Indices of the words at which a window of ``width`` words of one document starts."""
    fits = np.maximum(np.diff(first) - width + 1, 0)
    off = np.concatenate(([0], np.cumsum(fits)))
    return np.repeat(first[:-1] - off[:-1], fits) + np.arange(off[-1])


def window_hashes(words: np.ndarray, first: np.ndarray, width: int, seed: int, piece: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash modulo ``PRIME`` of each window of ``width`` words that lies in one document, and its first word's index.

    Prefix sums run over pieces of that many words, so that memory beyond the words and windows is bounded.
    """
    starts = window_starts(first, width)
    out = np.empty(len(starts), np.uint64)
    up, down = _table(seed).upto(min(piece, len(words)) + width)
    for base in range(0, len(words), piece):
        a, b = np.searchsorted(starts, (base, base + piece))
        if a == b:
            continue
        part = _reduced(words[base : base + piece + width])
        terms = mulmod(part, up[: len(part)])
        low, high = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64))) for x in (terms & np.uint64(0xFFFFFFFF), terms >> np.uint64(32)))
        here = starts[a:b] - base
        top, tail = high[here + width] - high[here], low[here + width] - low[here]  # top is below 2^29 times the width
        total = ((top & np.uint64((1 << 29) - 1)) << np.uint64(32)) + (top >> np.uint64(29)) + _reduced(tail)
        out[a:b] = mulmod(_reduced(total), down[here])
    return out, starts


def chain_hashes(words: np.ndarray, starts: np.ndarray, width: int, seed: int) -> np.ndarray:
    """64 bits for the ``width`` words from each start, mixed one after another."""
    h = np.full(len(starts), seed ^ width, np.uint64)
    for k in range(width):
        h = mix64((h ^ words[starts + k]) * np.uint64(GOLDEN) + np.uint64(seed))
    return h


def doc_runs(off: np.ndarray, most: int = 500_000) -> list[tuple[int, int]]:
    """Cuts rows into runs of about ``most`` bytes at row boundaries; a longer row stands alone."""
    runs, at, n = [], 0, len(off) - 1
    while at < n:
        to = int(np.searchsorted(off, off[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        runs.append((at, to))
        at = to
    return runs


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by a plain sort: numpy's own ``unique`` hashes, which is far slower on random 64-bit values."""
    values = np.sort(values)
    if not len(values):
        return values
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned 64-bit values as differences of as few bytes as the largest needs.

    The differences' highest bytes, which are mostly small, are deflated; the others are as good as random.
    """
    if not len(values):
        return b""
    gaps = np.diff(values).astype("<u8")
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T)
    top = zlib.compress(planes[-1].tobytes(), 1)
    return bytes([width]) + values[:1].astype("<u8").tobytes() + len(top).to_bytes(4, "little") + top + planes[:-1].tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    width, size = blob[0], int.from_bytes(blob[9:13], "little")
    top = np.frombuffer(zlib.decompress(blob[13 : 13 + size]), np.uint8)
    gaps = np.zeros((len(top) + 1, 8), np.uint8)
    gaps[0] = np.frombuffer(blob, dtype=np.uint8, offset=1, count=8)
    gaps[1:, width - 1] = top
    if width > 1:
        gaps[1:, : width - 1] = np.frombuffer(blob, dtype=np.uint8, offset=13 + size).reshape(width - 1, -1).T
    return np.cumsum(gaps.reshape(-1).view("<u8"), dtype=np.uint64)


def runs_of(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run of equal values, and its length."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return starts, np.diff(np.append(starts, len(sorted_values)))
