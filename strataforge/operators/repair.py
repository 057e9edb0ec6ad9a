"""Repairs that change as few rows as possible: towards quotas, target shares, or valid values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataforge.functions.hashing import bernoulli, payload
from strataforge.operators.joins import numbered
from strataforge.operators.quota import expanded, hash_ranked, largest_remainder, water_filled


def repaired_to_quota(df: DataFrame, source: DataFrame, strata: list[str], category: str, weight: str, order: list[str], spread: bool = False) -> DataFrame:
    """``df`` with ``category`` changed in as few rows as meet the source's quotas inside each stratum.

    Quotas are the largest remainder of the stratum's rows by source weight. Rows keep their category
    up to its quota, in order; surplus rows take what is short, both in order. Adds
    ``repaired``; strata that the source lacks stay as they are. ``spread`` numbers rows over range
    partitions, for strata or categories too large for a task.
    """
    rows_in = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__slots"))
    weights = source.groupBy(*strata, category).agg(F.sum(weight).alias("__w")).filter("__w > 0")
    quota = largest_remainder(weights.join(rows_in, strata), [category], "__w", F.col("__slots"), strata).select(*strata, category, "quota")
    have = df.groupBy(*strata, category).agg(F.count(F.lit(1)).alias("__have"))
    served = quota.select(*strata).distinct().withColumn("__served", F.lit(True))
    # what is short, one row a slot, numbered inside the stratum
    short = quota.join(have, [*strata, category], "left").withColumn("__need", F.greatest(F.col("quota") - F.coalesce("__have", F.lit(0)), F.lit(0)))
    slots = expanded(short, "__need", "__copy").select(*strata, F.col(category).alias("__new"), (F.row_number().over(Window.partitionBy(*strata).orderBy(category, "__copy"))).alias("__turn"))
    ranked = df.join(quota, [*strata, category], "left").join(served, strata, "left")
    ranked = numbered(ranked, order, [*strata, category], "__i", spread)
    over = F.coalesce(F.col("__served"), F.lit(False)) & (F.col("__i") >= F.coalesce("quota", F.lit(0)))
    ranked = numbered(ranked.withColumn("__over", over), order, [*strata, "__over"], "__n", spread).withColumn("__turn", F.when(F.col("__over"), F.col("__n") + 1))
    out = ranked.join(slots, [*strata, "__turn"], "left")
    return out.withColumn(category, F.coalesce("__new", category)).withColumn("repaired", F.col("__new").isNotNull()).select(*df.columns, "repaired")


def staged(df: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]]) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Applies (name, repair, infeasible) stages in turn; the first with infeasible rows rolls everything back.

    ``infeasible`` returns the strata that the stage cannot serve. Frames are immutable, so rolling
    back is returning the one that came in; only the number of infeasible strata reaches the driver.
    """
    current, log = df, []
    for name, repair, infeasible in stages:
        bad = infeasible(current).count()
        log.append((name, bad))
        if bad:
            return df, log
        current = repair(current)
    return current, log


def hash_filled(df: DataFrame, column: str, known: list[str], forced: tuple[Column, str], labels: tuple[str, str], id_col: str, seed: str, p: str = "0.5") -> DataFrame:
    """Fills what is not a known value: where ``forced`` holds with its label, else one of two labels by hash. Adds ``filled``."""
    fine = F.coalesce(F.col(column).isin(known), F.lit(False))
    draw = F.when(bernoulli(payload(seed, F.col(id_col)), p), F.lit(labels[0])).otherwise(F.lit(labels[1]))
    value = F.when(fine, F.col(column)).when(F.coalesce(forced[0], F.lit(False)), F.lit(forced[1])).otherwise(draw)
    return df.withColumn("filled", ~fine).withColumn(column, value)


def fill_ledger(before: DataFrame, after: DataFrame, id_col: str, column: str) -> DataFrame:
    """(id, old, new) of each filled row; null and empty old values are told apart by name."""
    old = F.when(F.col("__old").isNull(), "<null>").when(F.col("__old") == "", "<empty>").otherwise(F.col("__old"))
    return after.filter("filled").select(id_col, F.col(column).alias("new")).join(before.select(id_col, F.col(column).alias("__old")), id_col).select(id_col, old.alias("old"), "new")


def allocated_missing(df: DataFrame, strata: list[str], stratum_name: str, eligible: Column, column: str, value: str, weights: DataFrame, weight: str, share: float, id_col: str, seed: str, rounds: int = 8) -> DataFrame:
    """Sets ``column`` to ``value`` in so many eligible rows that it has the target share of all rows.

    What is missing towards the target is apportioned over strata by source weight, capped by the
    eligible rows of each, and the rows are chosen by hash. ``stratum_name`` names the one column
    that identifies a stratum (several are joined by ``|``). Adds ``allocated``. Fewer eligible rows in
    strata with weight than are missing is an error. ``rounds`` is kept for its callers and bounds nothing.
    """
    key = F.concat_ws("|", *(F.col(c).cast("string") for c in strata))
    df = df.withColumn(stratum_name, key)
    n, have = df.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col(column) == value).cast("long")), F.lit(0))).first()
    slots = max(0, int(share * n + 0.5) - int(have))
    room = df.filter(eligible & ~F.coalesce(F.col(column) == value, F.lit(False))).groupBy(stratum_name).agg(F.count(F.lit(1)).alias("room"))
    rooms = room.join(weights.withColumn(stratum_name, key).groupBy(stratum_name).agg(F.sum(weight).alias("w")), stratum_name)
    able = rooms.filter("w > 0").agg(F.coalesce(F.sum("room"), F.lit(0))).first()[0]
    if able < slots:
        raise ValueError(f"{slots} rows are to be allocated, but strata with weight have {able} eligible ones")
    quotas = water_filled(rooms, stratum_name, "w", "room", slots, rounds).select(stratum_name, "quota")
    chosen = hash_ranked(df.filter(eligible & ~F.coalesce(F.col(column) == value, F.lit(False))), [stratum_name], id_col, quotas, seed).select(id_col).withColumn("__take", F.lit(True))
    out = df.join(chosen, id_col, "left").withColumn("allocated", F.coalesce("__take", F.lit(False)))
    return out.withColumn(column, F.when(F.col("allocated"), F.lit(value)).otherwise(F.col(column))).drop("__take", stratum_name)


def pair_exchanged(df: DataFrame, left: Column, right: Column, match: list[str], fields: list[str], id_col: str) -> DataFrame:
    """Swaps a group of fields between matched rows: the i-th row of ``left`` and of ``right`` inside each ``match`` group.

    The fields' joint distribution inside a group does not change. Adds ``exchanged``.
    """
    side = F.when(left, F.lit(0)).when(right, F.lit(1))
    marked = df.withColumn("__side", side)
    turn = F.row_number().over(Window.partitionBy(*match, "__side").orderBy(id_col))
    numbered = marked.filter("__side is not null").withColumn("__turn", turn)
    give = numbered.select(*match, "__turn", (1 - F.col("__side")).alias("__side"), *(F.col(f).alias(f"__{f}") for f in fields), F.lit(True).alias("__hit"))
    swapped = numbered.join(give, [*match, "__turn", "__side"], "left").select(id_col, "__hit", *(f"__{f}" for f in fields))
    out = marked.drop("__side").join(swapped, id_col, "left").withColumn("exchanged", F.coalesce("__hit", F.lit(False)))
    for f in fields:
        out = out.withColumn(f, F.when(F.col("exchanged"), F.col(f"__{f}")).otherwise(F.col(f)))
    return out.drop("__hit", *(f"__{f}" for f in fields))


def attribute_repairs(df: DataFrame, rules: dict[str, tuple[str, Column, Column]]) -> DataFrame:
    """Applies (column, condition, new value) rules in order; adds ``repairs``, the names of those that changed a value."""
    done = []
    for name, (column, condition, value) in rules.items():
        applies = F.coalesce(condition, F.lit(False))
        df = df.withColumn(f"__{name}", applies & ~F.col(column).eqNullSafe(value)).withColumn(column, F.when(applies, value).otherwise(F.col(column)))
        done.append(F.when(F.col(f"__{name}"), F.lit(name)))
    return df.withColumn("repairs", F.filter(F.array(*done), lambda x: x.isNotNull())).drop(*(f"__{n}" for n in rules))


def best_donor(needs: DataFrame, donors: DataFrame, match: list[str], order: list[str], id_col: str) -> DataFrame:
    """(match, id): the first donor of each group in a composite order."""
    first = F.min(F.struct(*order, F.col(id_col).alias("__id"))).getField("__id").alias(id_col)
    return needs.select(*match).distinct().join(donors.groupBy(*match).agg(first), match)
