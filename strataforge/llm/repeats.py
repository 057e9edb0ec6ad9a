"""In how many blocks of documents each hash occurs.

Documents are dealt to blocks of a few megabytes. Each block reports its distinct hashes, cut by
value range into buckets and packed as sorted differences (about two bytes a hash instead of a
row each). One task a bucket adds up how many blocks reported each value and sends every block
one byte a value, in the order of its report; as most are zero, they deflate to little.

Beyond ``FAN`` blocks the same is done level by level: the reports of ``FAN`` blocks are merged
into one of a super-block, which is cut into finer buckets and reported upwards, and the answers
come back the same way. So a task reads at most ``FAN`` reports, a report stays hundreds of
values long, the number of reports grows in proportion to the input, and a hash that every block
holds is at most ``FAN`` entries in any task.

The blocks' text is shuffled once: all passes over it read the same exchange.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.shared import pack_sorted, text_bytes, unpack_sorted

BLOCK_BYTES = 4 << 20
BUCKET_VALUES = 2_000_000
FAN = 8192
REPORT = "bucket int, block int, found binary, extra binary, counts binary"
RETURN = "block int, bucket int, classes binary"


def in_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int, int]:
    """(id, text, block), the number of blocks, and the text's bytes.

    The input partition is part of the key, so that a row repeated any number of times is spread.
    """
    total = text_bytes(docs, text_col)
    blocks = max(-(-total // block_bytes), 2 * docs.sparkSession.sparkContext.defaultParallelism)
    block = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.spark_partition_id()), F.lit(blocks)).cast("int")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), block.alias("block")), blocks, total


def filter_bits(values: int) -> int:
    """Bits of a hash that leave about one in 256 of so many values with a stranger's hash."""
    return min(56, max(1, values).bit_length() + 8)


class Counter:
    """Counts the blocks of each value below 2 ** ``width``, for about ``values`` values in ``blocks`` blocks."""

    def __init__(self, blocks: int, values: int, width: int) -> None:
        self.width, self.levels = width, []
        while True:
            below = FAN ** (len(self.levels) + 1)
            share = -(-values * below // blocks) if below < blocks else values
            self.levels.append(max(2, int(share // BUCKET_VALUES).bit_length()))
            if below >= blocks:
                break

    def report(self, block: int, values: np.ndarray, extra: np.ndarray | None = None, counts: np.ndarray | None = None, level: int = 0) -> pa.Table:
        """Cells of sorted distinct values. ``extra`` holds 64 further bits of each: values differ where those do."""
        bits = self.levels[level]
        cut = np.searchsorted(values >> np.uint64(self.width - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(cut)).tolist()
        spans = [(int(cut[k]), int(cut[k + 1])) for k in full]
        return pa.table(
            {
                "bucket": pa.array(full, pa.int32()),
                "block": pa.array([block] * len(full), pa.int32()),
                "found": pa.array([pack_sorted(values[x:y]) for x, y in spans], pa.binary()),
                "extra": pa.array([None if extra is None else extra[x:y].tobytes() for x, y in spans], pa.binary()),
                "counts": pa.array([None if counts is None else zlib.compress(counts[x:y].astype("<u4").tobytes(), 1) for x, y in spans], pa.binary()),
            }
        )

    def totals(self, cells: DataFrame, level: int = 0) -> DataFrame:
        """(block, bucket, classes): a class for each reported value, in order.

        The class is eight times the binary logarithm of the number of blocks that reported the
        value, 255 at most, and so 0 for a value of one block.
        """
        if level + 1 == len(self.levels):
            return cells.groupBy("bucket").applyInArrow(_counted, RETURN)
        above = F.expr(f"block div {FAN}").cast("int")
        lift = self.levels[level + 1] - self.levels[level]

        def merge(table: pa.Table) -> pa.Table:
            m = _Merged(table)
            return self.report(table.column("block")[0].as_py() // FAN, m.values, m.extra, m.counts, level + 1)

        def back(table: pa.Table, found: pa.Table) -> pa.Table:
            m = _Merged(table)
            return m.answers(classes_of(found))

        cells = cells.withColumn("above", above)
        upper = self.totals(cells.groupBy("bucket", "above").applyInArrow(lambda t: merge(t.drop(["above"])), REPORT), level + 1)
        upper = upper.withColumn("low", F.shiftright("bucket", lift))
        return cells.groupBy("bucket", "above").cogroup(upper.groupBy("low", "block")).applyInArrow(back, RETURN)


class _Merged:
    """The cells of one bucket as distinct values with the number of blocks of each."""

    def __init__(self, table: pa.Table) -> None:
        self.blocks, self.buckets = table.column("block").to_pylist(), table.column("bucket").to_pylist()
        parts = [unpack_sorted(x) for x in table.column("found").to_pylist()]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        values = np.concatenate(parts)
        extra = table.column("extra")
        extra = None if extra.null_count else np.frombuffer(b"".join(extra.to_pylist()), "<u8")
        counts = [np.frombuffer(zlib.decompress(x), "<u4") if x else np.ones(n, np.uint32) for x, n in zip(table.column("counts").to_pylist(), self.sizes.tolist(), strict=True)]
        self.order = np.argsort(values, kind="stable") if extra is None else np.lexsort((extra, values))
        values = values[self.order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = values[1:] != values[:-1]
        if extra is not None:
            extra = extra[self.order]
            fresh[1:] |= extra[1:] != extra[:-1]
        self.run = np.cumsum(fresh) - 1
        self.values, self.extra = values[fresh], None if extra is None else extra[fresh]
        self.counts = np.add.reduceat(np.concatenate(counts)[self.order].astype(np.int64), np.flatnonzero(fresh))

    def answers(self, classes: np.ndarray) -> pa.Table:
        """RETURN rows from the class of each distinct value."""
        each = np.empty(len(self.order), np.uint8)
        each[self.order] = classes[self.run]
        cut = np.concatenate(([0], np.cumsum(self.sizes))).tolist()
        blobs = [zlib.compress(each[x:y].tobytes(), 1) for x, y in zip(cut, cut[1:], strict=False)]
        return pa.table({"block": pa.array(self.blocks, pa.int32()), "bucket": pa.array(self.buckets, pa.int32()), "classes": pa.array(blobs, pa.binary())})


def _counted(table: pa.Table) -> pa.Table:
    m = _Merged(table)
    return m.answers(np.minimum(255, np.floor(8 * np.log2(m.counts))).astype(np.uint8))


def classes_of(returned: pa.Table) -> np.ndarray:
    """The classes of all reported values, in the order of their values."""
    if not returned.num_rows:
        return np.zeros(0, np.uint8)
    order = np.argsort(returned.column("bucket").to_numpy(), kind="stable").tolist()
    blobs = returned.column("classes").to_pylist()
    return np.frombuffer(b"".join(zlib.decompress(blobs[k]) for k in order), np.uint8)


def counted(blocks: DataFrame, counter: Counter, values_of: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """RETURN rows for the sorted distinct values that ``values_of`` finds in each block's rows."""
    cells = blocks.groupBy("block").applyInArrow(lambda t: counter.report(t.column("block")[0].as_py(), values_of(t)), REPORT)
    return counter.totals(cells)


def repeated_in(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values that occur twice or more."""
    every = np.sort(values)
    twice = every[1:][every[1:] == every[:-1]]
    if not len(twice):
        return twice
    fresh = np.ones(len(twice), bool)
    fresh[1:] = twice[1:] != twice[:-1]
    return twice[fresh]


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which values are in the sorted set."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    return sorted_set[np.minimum(at, len(sorted_set) - 1)] == values
