"""Weighted tables: cubes, thresholds, pooling, shares, marginals and distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataforge.functions.buckets import eligible


def with_total(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds sums over the whole table, {new name: column}: one aggregate row, broadcast, so no task sees all categories.

    Both sides read the same shuffle where the table is an aggregate.
    """
    return df.crossJoin(F.broadcast(df.agg(*(F.sum(c).alias(n) for n, c in columns.items()))))


def cube(df: DataFrame, keys: list[str], count: str = "count", suppressed: str = "suppressed") -> DataFrame:
    """Sum of counts and whether any cell was suppressed, by key. Null keys are a group."""
    return df.groupBy(*keys).agg(F.sum(count).alias(count), F.bool_or(suppressed).alias(suppressed))


def release_threshold(df: DataFrame, count: str, least: int, expected: int, rows: int) -> int:
    """max(least, ceil(expected * total / rows)), in integers; one aggregate row reaches the driver."""
    total = df.agg(F.sum(count)).first()[0] or 0
    return max(least, -(-expected * int(total) // rows))


def thresholded(df: DataFrame, keys: list[str], count: str, limit: int | Column) -> DataFrame:
    """Groups whose sum reaches the limit."""
    return df.groupBy(*keys).agg(F.sum(count).alias(count)).filter(F.col(count) >= limit)


def pooled(df: DataFrame, keys: list[str], pool: Column, pool_name: str, count: str = "count", places: int = 6) -> DataFrame:
    """Sums by key and pooled category, rounded; rows whose category has no pool are left out."""
    return df.withColumn(pool_name, pool).filter(F.col(pool_name).isNotNull()).groupBy(*keys, pool_name).agg(F.round(F.sum(F.col(count).cast("double")), places).alias(count))


def pooling_coverage(before: DataFrame, after: DataFrame, count: str = "count", floor: float | None = 0.99) -> DataFrame:
    """(total, kept, coverage) of a pooling; below ``floor`` the query stops. An empty table is covered."""
    b, a = before.agg(F.sum(F.col(count).cast("double")).alias("total")), after.agg(F.sum(F.col(count).cast("double")).alias("kept"))
    out = b.crossJoin(a).select(F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("kept", F.lit(0.0)).alias("kept"))  # one row each
    out = out.withColumn("coverage", F.when(F.col("total") > 0, F.col("kept") / F.col("total")).otherwise(F.lit(1.0)))
    if floor is None:
        return out
    return out.withColumn("coverage", F.when(F.col("coverage") >= floor, F.col("coverage")).otherwise(F.raise_error(F.lit("pooling lost too much of the total")).cast("double")))


def share_adjusted(df: DataFrame, keys: list[str], part: Column, share_of: DataFrame, numerator: Column, weight: str, count: str = "count") -> DataFrame:
    """Scales the counts where ``part`` holds by sum(weight where numerator) / sum(weight) of ``share_of`` by key.

    A key without weight has share 0, and so has a key that ``share_of`` lacks.
    """
    shares = share_of.groupBy(*keys).agg((F.sum(F.when(numerator, F.col(weight)).otherwise(0)) / F.nullif(F.sum(weight), F.lit(0))).alias("__share"))
    out = df.join(shares, keys, "left")
    scaled = F.when(part, F.col(count) * F.coalesce("__share", F.lit(0.0))).otherwise(F.col(count).cast("double"))
    return out.withColumn(count, scaled).drop("__share")


def spine_marginal(spine: DataFrame, facts: DataFrame, key: str, least: int, count: str = "count") -> DataFrame:
    """Every key of the spine with its count, 0 where there is none, and whether it reaches ``least``."""
    n = facts.groupBy(key).agg(F.sum(count).alias(count))
    return spine.join(n, key, "left").withColumn(count, F.coalesce(count, F.lit(0))).withColumn("eligible", F.col(count) >= least)


def zero_filled(df: DataFrame, spine: DataFrame, keys: list[str], zeros: dict[str, Column]) -> DataFrame:
    """Adds a row for each key combination of the spine that is missing; columns not named in ``zeros`` are null."""
    missing = spine.select(*keys).distinct().join(df.select(*keys).distinct(), keys, "left_anti")
    return df.unionByName(missing.select(*keys, *(c.alias(k) for k, c in zeros.items())), allowMissingColumns=True)


def normalised(df: DataFrame, keys: list[str], by: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """(keys, n, share): counts, or sums of ``weight``, over their total, inside each ``by``. Null categories are dropped first."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
    out = df.groupBy(*(by or []), *keys).agg(agg.alias("n"))
    out = out.withColumn("__total", F.sum("n").over(Window.partitionBy(*by))) if by else with_total(out, {"__total": "n"})
    return out.withColumn("share", F.when(F.col("__total") != 0, F.col("n") / F.col("__total"))).drop("__total")


def conditioned_mixture(joint: DataFrame, stratum: str, category: str, strata: DataFrame, weight: str = "n") -> DataFrame:
    """(category, share): sum over strata of w(s) * P(category | s). No rows if a weighted stratum has no distribution."""
    p = normalised(joint, [category], [stratum], F.col(weight)).select(stratum, category, F.col("share").alias("p"))
    w = normalised(strata, [stratum], None, F.col(weight)).select(stratum, F.col("share").alias("w"))
    gaps = w.join(p.select(stratum).distinct(), stratum, "left_anti").agg(F.count(F.lit(1)).alias("gaps"))
    out = w.join(p, stratum).groupBy(category).agg(F.sum(F.col("w") * F.col("p")).alias("share"))
    return out.crossJoin(gaps).filter("gaps = 0").drop("gaps")  # one row on the right


def resolution_filtered(target: DataFrame, actual: DataFrame, key: str, n: int | Column) -> DataFrame:
    """(key, target, actual): labels whose target share is below 1/n go, then both series are renormalised."""
    kept = target.filter(F.col("share") * n >= 1).select(key, F.col("share").alias("target"))
    both = kept.join(actual.select(key, F.col("share").alias("actual")), key, "left").withColumn("actual", F.coalesce("actual", F.lit(0.0)))
    both = with_total(both, {"__target": "target", "__actual": "actual"})
    return both.withColumn("target", F.col("target") / F.col("__target")).withColumn("actual", F.coalesce(F.try_divide(F.col("actual"), F.nullif("__actual", F.lit(0.0))), F.lit(0.0))).drop("__target", "__actual")


def top_and_other(df: DataFrame, key: str, k: int, other: str = "Other") -> DataFrame:
    """(key, n): the k most frequent values, ties by value, and the rest as one."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    top = n.orderBy(F.desc("n"), key).limit(k).select(F.col(key).alias("__top"))
    named = n.join(F.broadcast(top), F.col(key).eqNullSafe(F.col("__top")), "left").withColumn("__key", F.when(F.col("__top").isNotNull(), F.col(key).cast("string")).otherwise(F.lit(other)))
    return named.groupBy(F.col("__key").alias(key)).agg(F.sum("n").alias("n"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, n) of equal width between minimum and maximum; the last bin is closed. Empty bins are left out, nulls ignored."""
    ends = df.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    at = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(F.least(F.floor((F.col(value) - F.col("__lo")) / ((F.col("__hi") - F.col("__lo")) / F.lit(float(bins)))), F.lit(bins - 1)))
    return df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # one row on the right


def quartiles(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Exact box-plot figures by group."""
    q = F.percentile(value, F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    return df.groupBy(*by).agg(F.min(value).alias("low"), q.alias("q"), F.max(value).alias("high")).select(*by, "low", *(F.col("q")[i].alias(f"q{i + 1}") for i in range(3)), "high")


def ordered_counts(df: DataFrame, key: str, order: str = "count") -> DataFrame:
    """(key, n, place): by count (descending, then label), by number, or by leading number of a band."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    by = {"count": (F.desc("n"), F.asc(key)), "number": (F.col(key).try_cast("double").asc_nulls_last(), F.asc(key)), "band": (F.regexp_extract(F.col(key).cast("string"), r"^(\d+)", 1).try_cast("int").asc_nulls_last(), F.asc(key))}[order]
    return n.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*by)).cast("long"))  # over categories


def cards(df: DataFrame, means: list[str], distincts: list[str]) -> DataFrame:
    """One row: rows, means, and exact numbers of distinct values, null being a value."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.avg(c).alias(f"mean_{c}") for c in means), *((F.countDistinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(f"distinct_{c}") for c in distincts))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, nulls), in one pass."""
    one = df.agg(*(F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).alias("nulls")) for c in columns))).alias("x")).select("x.*")


def blank_profile(df: DataFrame, texts: list[str], arrays: list[str] = ()) -> DataFrame:
    """(column_name, blanks): null, white space alone, or an empty array."""
    blank = {c: F.col(c).isNull() | F.col(c).rlike(r"^\s*$") for c in texts} | {c: F.col(c).isNull() | (F.size(c) == 0) for c in arrays}
    one = df.agg(*(F.coalesce(F.sum(b.cast("long")), F.lit(0)).alias(c) for c, b in blank.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("blanks")) for c in blank))).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def collisions(df: DataFrame, value: str) -> DataFrame:
    """One row: values that several rows share, and rows that share one. Arrays compare as wholes; nulls are no value."""
    n = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return n.agg(F.count(F.lit(1)).alias("shared_values"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_sharing"))


def inconsistent_mappings(df: DataFrame, key: str, label: str) -> DataFrame:
    """Keys with more than one label, null being a label."""
    return df.select(key, label).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("labels")).filter("labels > 1")


def coverage_sets(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, members): distinct values in order. For value domains of bounded size."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias("members"))


def table_metrics(tables: dict[str, DataFrame], count: str = "count", suppressed: str = "suppressed") -> DataFrame:
    """(table_name, rows, total, suppressed_cells, passed) of each table; it passes with rows and a positive total."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col(count).cast("double")), F.lit(0.0)).alias("total"), F.coalesce(F.sum(F.col(suppressed).cast("long")), F.lit(0)).alias("suppressed_cells"))
        one = one.select(F.lit(name).alias("table_name"), "*", ((F.col("rows") > 0) & (F.col("total") > 0)).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out


def stratum_report(parts: dict[str, DataFrame], key: str, value: str = "n") -> DataFrame:
    """One row for each key of any part, with each part's value or 0."""
    out = None
    for name, df in parts.items():
        one = df.select(key, F.col(value).alias(name))
        out = one if out is None else out.join(one, key, "full")
    return out.fillna(0, list(parts))


def ledger_summary(df: DataFrame, kind: str, tokens: dict[str, str], price_per_million: dict[str, str]) -> DataFrame:
    """By record type: rows, token sums, and cost in exact decimals."""
    cost = sum((F.sum(F.col(c).cast("decimal(20,0)")) * F.lit(price_per_million[name]).cast("decimal(12,6)") / F.lit(1_000_000).cast("decimal(7,0)") for name, c in tokens.items()), F.lit(0).cast("decimal(38,12)"))
    return df.groupBy(kind).agg(F.count(F.lit(1)).alias("records"), *(F.sum(c).alias(name) for name, c in tokens.items()), cost.cast("decimal(38,6)").alias("cost"))


def pair_counts(df: DataFrame, mine: Column, other: Column) -> DataFrame:
    """(pair, n): unordered pairs of labels; a missing side gives ``none``."""
    pair = F.when(mine.isNull() | other.isNull(), F.lit("none")).otherwise(F.concat_ws("+", F.least(mine, other), F.greatest(mine, other)))
    return df.groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("n"))


def supported(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct key combinations with an eligible cell."""
    return df.filter(eligible()).select(*keys).distinct()
