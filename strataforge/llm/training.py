"""Labelled rows for the text classifiers: which rows may train, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sampled document has at most so many bytes; longer ones are scored, but not learned from.
LONGEST = 256 << 10


def held_out(id_col: Column) -> Column:
    """True for ids whose CRC-32, of the id as text, is divisible by five: their labels are never read."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> tuple[DataFrame, float]:
    """(id, text, y, half) of at most ``most`` training documents of each class, by a hash of the id, and the share of label 1.

    The ids of the sample (two times ``most`` at the most) are broadcast to the documents. A
    document labelled twice counts with its larger label; null labels and ids are ignored. An id
    gives one row, that with the smallest text, however often it is repeated; texts of more than
    ``longest`` bytes are left out. So the sample has at most 2 * ``most`` rows of ``longest`` bytes.
    """
    known = labels.filter(~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    share = known.agg(F.avg(F.col("y").cast("double"))).first()[0]
    order = (F.xxhash64("id"), F.col("id"))
    chosen = known.filter("y = 1").orderBy(*order).limit(most).unionByName(known.filter("y = 0").orderBy(*order).limit(most))
    chosen = chosen.withColumn("half", F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter(F.octet_length("text") <= longest)
    one = rows.join(F.broadcast(chosen), "id").groupBy("id", "y", "half").agg(F.min("text").alias("text"))
    return one.select("id", "text", "y", "half"), float(share) if share is not None else 0.5
