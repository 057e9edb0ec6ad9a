"""Joins as the audits and samplers use them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def lookup(df: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """m:1 lookup. A key twice in the dimension, or a row without a match, stops the query.

    Spark chooses the strategy: a dimension that fits the broadcast threshold is broadcast.
    """
    one = dim.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *(F.min(c).alias(c) for c in columns))
    out = df.join(one, key, "left")
    ok = F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{key} is missing or repeated in the dimension: "), F.coalesce(F.col(key).cast("string"), F.lit("<null>")))).cast("boolean"))
    return out.filter(ok).drop("__n")


def lookup_report(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """One row: rows, unmatched, and keys repeated in the dimension."""
    one = dim.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    out = df.join(one, key, "left").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("__n").isNull().cast("long")), F.lit(0)).alias("unmatched"))
    return out.crossJoin(one.agg(F.coalesce(F.sum((F.col("__n") > 1).cast("long")), F.lit(0)).alias("repeated")))  # one row each


def ratio(left: DataFrame, right: DataFrame, keys: list[str], numerator: str, denominator: str) -> DataFrame:
    """Inner equi-join of two aggregates; 0 / 0 and x / 0 are null."""
    return left.join(right, keys).select(*keys, F.try_divide(F.col(numerator), F.col(denominator)).alias("ratio"))


def attach(df: DataFrame, factor: DataFrame, keys: list[str], column: str, default) -> DataFrame:
    """Left equi-join of a factor, ``default`` where there is none."""
    return df.join(factor.select(*keys, column), keys, "left").withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def full_counts(left: DataFrame, right: DataFrame, keys: list[str], names: tuple[str, str], value: str = "n") -> DataFrame:
    """Full outer join with 0 for missing counts. Not null-safe: a null key of either side stays a row of its own."""
    a, b = left.select(*keys, F.col(value).alias(names[0])), right.select(*keys, F.col(value).alias(names[1]))
    return a.join(b, keys, "full").fillna(0, list(names))


def not_in(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe anti-join: rows of ``df`` whose key combination ``known`` lacks."""
    return df.join(known.select(*keys).distinct(), _same(df, known, keys), "left_anti") if df is not known else df.limit(0)


def is_in(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe semi-join."""
    return df.join(known.select(*keys).distinct(), _same(df, known, keys), "left_semi")


def outside(sample: DataFrame, upstream: DataFrame, multiplicity: bool = False) -> DataFrame:
    """Rows of ``sample`` that ``upstream`` lacks, all columns compared null-safely; with ``multiplicity`` as multisets."""
    return sample.exceptAll(upstream.select(*sample.columns)) if multiplicity else sample.join(upstream.withColumnsRenamed({c: f"__{c}" for c in upstream.columns}), reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in sample.columns)), "left_anti")


def existence(df: DataFrame, known: DataFrame, keys: list[str], flag: str = "exists") -> DataFrame:
    """Adds a flag: whether ``known`` has the key combination. Null keys exist nowhere."""
    marks = known.select(*keys).distinct().withColumn(flag, F.lit(True))
    return df.join(marks, keys, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def attach_one(df: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """1:1 left join; a key twice on either side stops the query."""
    def single(d: DataFrame, side: str) -> DataFrame:
        n = F.count(F.lit(1)).over(Window.partitionBy(key))
        return d.withColumn("__n", n).filter(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit(f"{key} repeats on the {side}")).cast("boolean"))).drop("__n")

    return single(df, "left").join(single(extra, "right"), key, "left")


def numbered(df: DataFrame, order: list[str | Column], by: list[str] | None = None, name: str = "row_idx", spread: bool = False) -> DataFrame:
    """Adds a row number from 0; with ``by`` it restarts in each group.

    Without groups, and with ``spread``, rows are dealt over range partitions, so that no task sees all
    rows or all of a hot group; groups alone are numbered by a window, a task for each.
    """
    if not by:
        return ranged_index(df, order, name)
    if not spread:
        return df.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))
    index = ranged_index(df, [*by, *order], "__row")
    starts = index.groupBy(*by).agg(F.min("__row").alias("__start")).withColumnsRenamed({c: f"__{c}" for c in by})
    match = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by))
    return index.join(starts, match).withColumn(name, F.col("__row") - F.col("__start")).drop("__row", "__start", *(f"__{c}" for c in by))


def ranged_index(df: DataFrame, order: list[str | Column], name: str = "row_idx") -> DataFrame:
    """Global row number from 0 in the given order, without a single-task window.

    One range shuffle; its partitions are numbered, and the totals of those before (one row a
    partition) are joined back. The shuffled rows are held, so that both uses see one dealing.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33)).persist()
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return dealt.join(F.broadcast(before), "__part").withColumn(name, F.col("__at") + F.col("__before")).drop("__part", "__at", "__before")


def zipped(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str], by: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Positional zip inside each group, or of the whole tables."""
    a, b = numbered(left, left_order, by, "__i"), numbered(right, right_order, by, "__i")
    return a.join(b, [*(by or []), "__i"], how).drop("__i")


def updated(df: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Replaces columns by the changes' values where these are not null."""
    new = changes.select(key, *(F.col(c).alias(f"__new_{c}") for c in columns))
    out = df.join(new, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"__new_{c}", c))
    return out.drop(*(f"__new_{c}" for c in columns))


def hashed_in(df: DataFrame, id_col: str, hashes: DataFrame, hash_col: str) -> DataFrame:
    """Rows whose id's SHA-256 is in a list of hashes."""
    return df.join(hashes.select(hash_col).distinct(), F.sha2(F.col(id_col).cast("string"), 256) == F.col(hash_col), "left_semi")
