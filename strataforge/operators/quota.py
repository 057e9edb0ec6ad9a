"""Quotas: largest remainder, expansion, weighted draws, stratified heads and round robins.

Allocation runs on aggregated categories; only the last step, which picks rows, touches the data.
All remainders are integers and ties go to the smaller key.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataforge.functions.hashing import below, payload, u64_hex
from strataforge.operators.joins import numbered


def largest_remainder(weights: DataFrame, key: list[str], weight: str, slots: int | Column, by: list[str] | None = None) -> DataFrame:
    """Adds ``quota``: slots by integer weight, remainders to the largest, ties to the smaller key.

    ``by`` apportions inside each group, with ``slots`` a column of it. A group without weight gets none.
    """
    group = by or [F.lit(0)]  # without groups the window holds the categories alone
    total = F.sum(weight).over(Window.partitionBy(*group))
    slots = (F.lit(slots) if isinstance(slots, int) else slots).cast("long")
    out = weights.withColumn("__total", total).withColumn("__slots", slots)
    product = F.col(weight).cast("decimal(19,0)") * F.col("__slots").cast("decimal(18,0)")
    size = F.col("__total").cast("decimal(38,0)")
    rest = product % size
    out = out.withColumn("__rest", F.when(F.col("__total") > 0, rest)).withColumn("__floor", F.when(F.col("__total") > 0, ((product - F.col("__rest")) / F.col("__total").cast("decimal(19,0)")).cast("long")).otherwise(F.lit(0).cast("long")))
    out = out.withColumn("__left", F.when(F.col("__total") > 0, F.col("__slots") - F.sum("__floor").over(Window.partitionBy(*group))).otherwise(F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("__rest"), *key))
    out = out.withColumn("quota", F.col("__floor") + (place <= F.col("__left")).cast("long"))
    return out.drop("__total", "__slots", "__rest", "__floor", "__left")


RUN = 1 << 16


def expanded(quotas: DataFrame, quota: str = "quota", name: str = "copy") -> DataFrame:
    """One row for each slot, numbered from 0 inside its category; a quota of 0 or null gives none.

    Slots are made in runs of ``RUN``, so that no array grows with a quota; a number beyond 2^31 is an error.
    """
    n = F.col(quota).cast("long")
    runs = quotas.filter(n > 0).withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / RUN))))
    return runs.withColumn(name, F.explode(F.sequence(F.col("__run") * RUN, F.least(n, (F.col("__run") + 1) * RUN) - 1))).withColumn(name, F.col(name).cast("int")).drop("__run")


def shuffled_slots(quotas: DataFrame, key: list[str], seed: str, by: list[str] | None = None, quota: str = "quota") -> DataFrame:
    """``expanded`` with ``slot``: a place from 0 in hash order, by its own domain ``seed``."""
    slots = expanded(quotas, quota).withColumn("__h", u64_hex(payload(seed, *(F.col(k) for k in [*(by or []), *key]), F.col("copy"))))
    return numbered(slots, ["__h", *key, "copy"], by, "slot").drop("__h")


def cdf(weights: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """(by, cdf, total): cumulative integer weights in order of the value, as an array; zero weights are left out.

    For categories of bounded number: a group's array is one value.
    """
    run = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow) if by else Window.partitionBy(F.lit(0)).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = weights.filter(F.col(weight) > 0).withColumn("upto", F.sum(weight).over(run).cast("long"))
    return steps.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("upto", F.col(value).alias("value")))).alias("cdf"), F.max("upto").alias("total"))


def drawn(cdf_col: str | Column, at: Column) -> Column:
    """The value whose weight range holds ``at``: one row in, one row out, no range join."""
    c = F.col(cdf_col) if isinstance(cdf_col, str) else cdf_col
    return F.get(F.filter(c, lambda x: x["upto"] > at), 0)["value"]


def weighted_draw(df: DataFrame, table: DataFrame, by: list[str], value: str, weight: str, data: Column, name: str) -> DataFrame:
    """Adds a value drawn by weight among the table's rows of the same key; null without such rows."""
    dist = cdf(table, by, value, weight)
    out = df.join(dist, by, "left") if by else df.crossJoin(F.broadcast(dist))  # one row
    return out.withColumn(name, drawn("cdf", below(data, F.col("total")))).drop("cdf", "total")


def group_quota_draw(groups: DataFrame, key: str, weight: str, slots: int, inside: DataFrame, value: str, inside_weight: str, seed: str) -> DataFrame:
    """Quota for each group, then a weighted draw with replacement inside it for each slot: (key, copy, value)."""
    quota = largest_remainder(groups, [key], weight, slots)
    rows = expanded(quota.select(key, "quota")).select(key, "copy")
    return weighted_draw(rows, inside, [key], value, inside_weight, payload(seed, F.col(key), F.col("copy")), value)


SALTS = 16


def first_rows(df: DataFrame, strata: list[str], order: list[str | Column], quotas: DataFrame, quota: str = "quota") -> DataFrame:
    """The first rows of each stratum in a total order, as many as its quota.

    Ranked twice: inside parts of a stratum dealt by hash, where no more than the quota stay, then
    among those. A stratum with a third of all rows is sorted by ``SALTS`` tasks instead of one.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    out = df.join(quotas.select(*strata, F.col(quota).alias("__quota")), strata).filter("__quota > 0").withColumn("__part", part)
    for by in ([*strata, "__part"], strata):
        out = out.withColumn("__i", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__i") <= F.col("__quota"))
    return out.select(*df.columns)


def stratified_head(df: DataFrame, strata: list[str], order: list[str], slots: int) -> DataFrame:
    """The first rows of each stratum, as many as its proportional quota."""
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n"))
    quota = largest_remainder(sizes, strata, "__n", slots).select(*strata, "quota")
    return first_rows(df, strata, order, quota)


def round_robin(df: DataFrame, strata: list[str], order: list[str], slots: int) -> DataFrame:
    """One row of each stratum in turn, strata in order, until there are enough; ``depth`` from 1."""
    part = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    for by, name in (([*strata, "__part"], "__depth"), (strata, "depth")):  # no stratum gives more than ``slots`` rows
        part = part.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= slots)
    return part.drop("__part", "__depth").orderBy("depth", *strata).limit(slots)


def hash_ranked(df: DataFrame, strata: list[str], id_col: str, quotas: DataFrame, seed: str, quota: str = "quota") -> DataFrame:
    """The rows of each stratum with the smallest hashes, as many as its quota."""
    return first_rows(df, strata, [F.sha2(payload(seed, F.col(id_col)), 256), F.col(id_col)], quotas, quota)


def hash_top(df: DataFrame, id_col: str, k: int, seed: str) -> DataFrame:
    """A pseudo-random sample of k rows that any order of the input gives alike."""
    return df.orderBy(F.sha2(payload(seed, F.col(id_col)), 256), id_col).limit(k)


def attach_by_quota(df: DataFrame, eligible: Column, sex: str, marginal: DataFrame, value: str, weight: str, id_col: str, seed: str) -> DataFrame:
    """Gives eligible rows a value so that each group of ``sex`` meets its quota exactly; other rows get null."""
    n = df.filter(eligible).groupBy(sex).agg(F.count(F.lit(1)).alias("__slots"))
    quota = largest_remainder(marginal.join(n, sex), [value], weight, F.col("__slots"), [sex]).select(sex, value, "quota")
    slots = shuffled_slots(quota, [value], seed, [sex]).select(sex, value, F.col("slot").alias("__i"))
    rows = numbered(df.filter(eligible), [id_col], [sex], "__i", spread=True)
    given = rows.join(slots, [sex, "__i"], "left").select(id_col, value)
    return df.join(given, id_col, "left")


def audited_marginal(table: DataFrame, key: str, count: str, total: int | None, flag: str = "eligible") -> DataFrame:
    """Checks a marginal before it is filtered, then keeps its eligible rows: unique keys, no negative count, the expected total."""
    n = table.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.sum(count).alias(count), F.bool_and(flag).alias(flag))
    n = n.withColumn("__whole", F.sum(count).over(Window.partitionBy(F.lit(0))))
    bad = F.when(F.col("__n") != 1, "a key repeats").when(F.col(count) < 0, "a count is negative").when(F.lit(total is not None) & (F.col("__whole") != F.lit(total or 0)), "the total differs")
    return n.filter(F.when(bad.isNull(), F.lit(True)).otherwise(F.raise_error(bad).cast("boolean"))).filter(flag).select(key, count)


def water_filled(rooms: DataFrame, key: str, weight: str, room: str, slots: int, rounds: int = 0) -> DataFrame:
    """Adds ``quota``: largest remainder capped at ``room``; what is cut off is dealt anew among those with room left.

    Dealing goes on until no slot is left or every room is full, in at most one round more than there are categories;
    slots that only categories without weight have room for are an error. Null counts as 0. All categories
    are dealt to in one task. ``rounds`` is kept for its callers and bounds nothing.
    """
    names = rooms.columns
    schema = T.StructType([*rooms.schema.fields, T.StructField("quota", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        weights, room_of = ([int(v or 0) for v in table.column(c).to_pylist()] for c in (weight, room))
        order = sorted(range(table.num_rows), key=lambda i, k=table.column(key).to_pylist(): (k[i] is not None, k[i]))
        got, left = [0] * table.num_rows, slots
        active = [i for i in order if room_of[i] > 0 and weights[i] > 0]
        while left > 0 and active:
            total = sum(weights[i] for i in active)
            step = {i: left * weights[i] // total for i in active}
            by_rest = sorted(active, key=lambda i: -(left * weights[i] % total))  # noqa: B023
            for i in by_rest[: left - sum(step.values())]:
                step[i] += 1
            for i, n in step.items():
                n = min(n, room_of[i] - got[i])
                got[i] += n
                left -= n
            active = [i for i in active if got[i] < room_of[i]]
        if left > 0 and any(n < r for n, r in zip(got, room_of, strict=True)):
            raise ValueError(f"{left} slots remain, and only categories without weight have room")
        return table.select(names).append_column("quota", pa.array(got, pa.int64()))

    return rooms.groupBy().applyInArrow(run, schema)
