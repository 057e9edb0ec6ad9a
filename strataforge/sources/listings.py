"""Hierarchical listings: rows in order, each with a level; parents are the last row of the level above."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """(seq, level, code, title) from semicolon CSV with quoted line feeds."""
    schema = T.StructType([T.StructField("seq", T.IntegerType()), T.StructField("level", T.IntegerType()), T.StructField("code", T.StringType()), T.StructField("title", T.StringType())])
    return spark.read.options(sep=";", header=True, multiLine=True, quote='"', escape='"').schema(schema).csv(path)


def running_parent(df: DataFrame, seq: str, is_parent: F.Column, value: F.Column, name: str, by: list[str] | None = None) -> DataFrame:
    """Adds the value of the last parent row up to here, inside each ``by``."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(F.when(is_parent, value), ignorenulls=True).over(w))


def hierarchy(listing: DataFrame) -> DataFrame:
    """(code, title, middle, middle_title, top, top_title) of the third level.

    A new top row ends the middle one before it. A third-level row before both its parents, or a code
    twice, stops the query. A listing is a classification of bounded size, so one window task is fine.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = listing.withColumn("run", F.count_if(F.col("level") == 1).over(w))
    for level, name in ((1, "top"), (2, "middle")):
        inner = w if level == 1 else Window.partitionBy("run").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        mark = F.col("level") == level
        df = df.withColumn(name, F.last(F.when(mark, F.col("code")), True).over(inner)).withColumn(f"{name}_title", F.last(F.when(mark, F.col("title")), True).over(inner))
    leaves = df.filter("level = 3").withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("code")))
    bad = F.when(F.col("top").isNull() | F.col("middle").isNull(), "a row stands before its parents: ").when(F.col("times") > 1, "a code repeats: ")
    leaves = leaves.filter(F.when(bad.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(bad, F.col("code"))).cast("boolean")))
    return leaves.select("code", "title", "middle", "middle_title", "top", "top_title")
