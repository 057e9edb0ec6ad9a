"""Packing by concatenating and cutting (operator 6).

Pass one encodes each document, puts the separator behind it and writes the ids with the
running offset inside the partition to a table in the shared folder. Partition totals (one row
a partition) become global offsets by a prefix sum. Pass two reads the table, cuts every
document at multiples of the sequence length and emits one boundary record a piece. Nothing is
shuffled and only the last sequence can be short.

Defined results: a null or empty text is a document of the separator alone; repeated rows are
packed as often as they occur; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.bpe import encoder
from strataforge.llm.shared import arrow_bytes, doc_runs, stored


def tokenized(docs: DataFrame, vocabulary: str, separator: int, id_col: str, text_col: str) -> DataFrame:
    """Pass one: (id, part, local, n, ids) with ``local`` the ids before the row in its partition."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, local = encoder(vocabulary), TaskContext.get().partitionId(), 0
        kind = "<u2" if len(enc.vocab.tokens) <= 1 << 16 and separator < 1 << 16 else "<u4"
        for batch in batches:
            raw, off = arrow_bytes(batch.column(1))
            for a, b in doc_runs(off):
                ids, counts, _ = enc.encode(raw[off[a] : off[b]], off[a : b + 1] - off[a])
                ids = np.insert(ids, np.cumsum(counts), separator).astype(kind)
                n = counts + 1
                cut = np.concatenate(([0], np.cumsum(n)))
                held, step = ids.tobytes(), np.dtype(kind).itemsize
                blobs = [held[x * step : y * step] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(local + cut[:-1]), pa.array(n), pa.array(blobs, pa.binary())], names=schema.names)
                local += int(cut[-1])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str, length: int = 1024, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in one piece; a sequence's pieces are gapless from offset 0.
    The table of pass one is written when this is called.
    """
    table = stored(tokenized(docs, vocabulary, separator, id_col, text_col), "packing")
    totals = sorted((r["part"], r["total"]) for r in table.groupBy("part").agg(F.sum("n").alias("total")).collect())
    base = np.zeros(totals[-1][0] + 2 if totals else 1, np.int64)
    for part, total in totals:
        base[part + 1] = total
    base = np.cumsum(base)  # base[p]: ids in partitions before p
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField(id_col, table.schema["id"].dataType)] + [T.StructField(c, T.LongType()) for c in names[1:]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, local, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            at = base[part] + local
            first, last = at // length, (at + n - 1) // length
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            seq = np.repeat(first - np.concatenate(([0], np.cumsum(pieces)))[:-1], pieces) + np.arange(pieces.sum())
            begin = np.maximum(at[row], seq * length)
            stop = np.minimum(at[row] + n[row], (seq + 1) * length)
            crc, seen, wide = np.zeros(len(row), np.int64), -1, None
            column = batch.column(4)
            for k, (r, x, y) in enumerate(zip(row.tolist(), (begin - at[row]).tolist(), (stop - at[row]).tolist(), strict=True)):
                if r != seen:
                    blob, seen = column[r].as_py(), r
                    wide = np.frombuffer(blob, "<u2" if len(blob) == 2 * n[r] else "<u4").astype("<u4")
                crc[k] = zlib.crc32(wide[x:y])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *(pa.array(v.astype(np.int64)) for v in (begin - at[row], stop - begin, crc, n[row], seq, begin - seq * length))], names=names)

    return table.mapInArrow(cut, schema)
