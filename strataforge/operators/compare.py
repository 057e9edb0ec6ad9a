"""Comparison of distributions: total variation, tolerances, drift and the rows of a metric report."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.operators.joins import full_counts, not_in
from strataforge.operators.weights import with_total


def _counts(df: DataFrame, keys: list[str], weight: str | None) -> DataFrame:
    return df.groupBy(*keys).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).cast("double").alias("n"))


def cells(actual: DataFrame, target: DataFrame, keys: list[str], actual_weight: str | None = None, target_weight: str | None = None, absolute: float = 0.005, errors: float = 3.0, least_expected: float = 5.0) -> DataFrame:
    """One row a cell: n, q (actual share), p (target share), gap, tolerance, expected, violated.

    A cell violates when it is expected at least ``least_expected`` times and its gap exceeds
    max(absolute, errors * sqrt(p (1 - p) / N)). Null keys of the two sides stay apart.
    """
    both = full_counts(_counts(actual, keys, actual_weight), _counts(target, keys, target_weight), keys, ("n", "m"))
    both = with_total(both, {"total": "n", "target_total": "m"})
    both = both.withColumn("q", F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0))).withColumn("p", F.coalesce(F.try_divide(F.col("m"), F.col("target_total")), F.lit(0.0)))
    both = both.withColumn("gap", F.abs(F.col("q") - F.col("p"))).withColumn("tolerance", F.greatest(F.lit(absolute), errors * F.sqrt(F.coalesce(F.try_divide(F.col("p") * (1 - F.col("p")), F.col("total")), F.lit(0.0)))))
    both = both.withColumn("expected", F.col("p") * F.col("total"))
    return both.withColumn("violated", (F.col("expected") >= least_expected) & (F.col("gap") > F.col("tolerance"))).drop("m", "total", "target_total")


def total_variation(actual: DataFrame, target: DataFrame, keys: list[str], actual_weight: str | None = None, target_weight: str | None = None) -> DataFrame:
    """One row: half the summed absolute difference of the two distributions."""
    return cells(actual, target, keys, actual_weight, target_weight).agg((F.sum("gap") / 2).alias("total_variation"))


def unexpected(actual: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key combination the target lacks, nulls compared as values."""
    return not_in(actual, target, keys)


def marginal_drift(a: DataFrame, b: DataFrame, fields: list[str]) -> DataFrame:
    """(field, total_variation) of each field between two tables."""
    out = None
    for f in fields:
        one = total_variation(a.select(F.col(f).cast("string").alias("v")), b.select(F.col(f).cast("string").alias("v")), ["v"]).select(F.lit(f).alias("field"), "total_variation")
        out = one if out is None else out.unionByName(one)
    return out


def max_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, correlation) of each pair, in one pass."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*(F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)))).alias("x")).select("x.*")


def out_of_bounds(df: DataFrame, columns: list[str], low: float, high: float) -> DataFrame:
    """One row: values outside [low, high] over all columns; nulls count as outside."""
    bad = sum((F.coalesce(~F.col(c).between(low, high), F.lit(True)).cast("long") for c in columns), F.lit(0).cast("long"))
    return df.agg(F.coalesce(F.sum(bad), F.lit(0)).alias("out_of_bounds"))


def metric(name: str, value: DataFrame, column: str, limit: float, at_most: bool = True) -> DataFrame:
    """A report row (name, value, threshold, passed) of a one-row table."""
    v = F.col(column).cast("double")
    return value.select(F.lit(name).alias("name"), v.alias("value"), F.lit(float(limit)).alias("threshold"), F.coalesce(v <= limit if at_most else v >= limit, F.lit(False)).alias("passed"))


def distribution_metrics(actual: DataFrame, target: DataFrame, fields: list[list[str]], tv_limit: float, target_weight: str | None = None, joint: list[str] | None = None, joint_limit: float = 0.1, rows_for_joint: int = 100_000, heldout: bool = False) -> DataFrame:
    """Report rows of each marginal: total variation, violated cells and unexpected rows; held-out marginals keep the first only.

    The joint's cells are gated only from ``rows_for_joint`` rows on, decided by the whole table's size.
    """
    out, n = [], actual.count() if joint else 0
    for keys in [*fields, *([joint] if joint else [])]:
        name, whole = "/".join(keys), keys is joint
        table = cells(actual, target, keys, None, target_weight)
        one = table.agg((F.sum("gap") / 2).alias("tv"), F.coalesce(F.sum(F.col("violated").cast("long")), F.lit(0)).alias("violated"))
        out.append(metric(f"{name}: total variation", one, "tv", joint_limit if whole else tv_limit))
        if not heldout and (not whole or n >= rows_for_joint):
            out.append(metric(f"{name}: violated cells", one, "violated", 0))
        if not heldout:
            out.append(metric(f"{name}: unexpected rows", unexpected(actual, target, keys).agg(F.count(F.lit(1)).alias("rows")), "rows", 0))
    report = out[0]
    for x in out[1:]:
        report = report.unionByName(x)
    return report


def size_dependent(n: Column, large: float, small: float, rows: int = 100_000) -> Column:
    """The statistical threshold from ``rows`` rows on, else the smoke threshold."""
    return F.when(n >= rows, F.lit(large)).otherwise(F.lit(small))
