"""Keys that hold much of a table: at most ``HEAVY`` of them, so that what is known of each may be broadcast.

The heavy keys of a table are the ``HEAVY`` most frequent of those with ``LEAST`` rows or more. As
every key with a thousandth of all rows is among them, no other key can hold up a task for long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY = 1000
LEAST = 1000


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of the heavy keys, as a local table of at most ``HEAVY`` rows."""
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST).orderBy(F.desc("n"), key).limit(HEAVY).collect()
    kind = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("n", T.LongType())])
    return rows.sparkSession.createDataFrame(found, kind)


def attached(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Inner or left join of ``left`` with ``right``, which has one row a key. Heavy keys' rows of ``right`` are broadcast."""
    heavy = heavy_keys(left, key).select(key)
    if heavy.isEmpty():
        return left.join(right, key, how)
    few = F.broadcast(right.join(F.broadcast(heavy), key, "left_semi"))
    light = left.join(F.broadcast(heavy), key, "left_anti").join(right, key, how)
    return light.unionByName(left.join(F.broadcast(heavy), key, "left_semi").join(few, key, how))


def chunk(node: Column, size: Column, rows: int, salt: int = 0) -> Column:
    """The part of a group of ``size`` rows (null: a light one) that holds the row, by a hash of its node."""
    return F.pmod(F.xxhash64(node, F.lit(salt)), parts(size, rows)).cast("int")


def parts(size: Column, rows: int) -> Column:
    """How many parts of about ``rows`` rows a group is cut into."""
    return F.coalesce(F.ceil(size / rows), F.lit(1)).cast("int")
