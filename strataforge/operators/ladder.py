"""Back-off ladders: conditional distributions at several levels, and draws from the first that has any."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataforge.functions.buckets import eligible
from strataforge.functions.hashing import below
from strataforge.operators.quota import cdf, drawn
from strataforge.operators.weights import normalised


@dataclass(frozen=True)
class Level:
    """One level: its name and the columns that it conditions on (none for the last resort)."""

    name: str
    keys: tuple[str, ...]


def level_index(table: DataFrame, level: Level, value: str, count: str = "count", smoothing: int = 0, suppressed: str | None = "suppressed") -> DataFrame:
    """(keys, value, weight): eligible cells summed once, plus smoothing. A cell without eligible count stays out."""
    cells = table.filter(eligible(count, suppressed) if suppressed else F.col(count) > 0)
    return cells.groupBy(*level.keys, value).agg(F.sum(count).alias("weight")).withColumn("weight", F.col("weight") + smoothing)


def probabilities(table: DataFrame, level: Level, value: str, count: str = "count", smoothing: int = 0, suppressed: str | None = "suppressed") -> DataFrame:
    """``level_index`` with ``p``, normalised inside the level's keys."""
    index = level_index(table, level, value, count, smoothing, suppressed)
    return index.withColumn("p", F.col("weight") / F.sum("weight").over(Window.partitionBy(*(level.keys or [F.lit(0)]))))


def ladder_lookup(df: DataFrame, levels: list[tuple[Level, DataFrame]], value: str) -> DataFrame:
    """Adds ``value`` and ``level`` of the first level with a row for the keys; null where none has."""
    out, found, name = df, [], []
    for i, (level, table) in enumerate(levels):
        side = table.select(*level.keys, F.col(value).alias(f"__v{i}"))
        out = out.join(side, list(level.keys), "left") if level.keys else out.crossJoin(F.broadcast(side))  # one row
        found.append(F.col(f"__v{i}"))
        name.append(F.when(F.col(f"__v{i}").isNotNull(), F.lit(level.name)))
    return out.withColumn(value, F.coalesce(*found)).withColumn("level", F.coalesce(*name)).drop(*(f"__v{i}" for i in range(len(levels))))


def ladder_draw(df: DataFrame, table: DataFrame, levels: list[Level], value: str, data: Column, count: str = "count", smoothing: int = 0, suppressed: str | None = "suppressed", strict: bool = True) -> DataFrame:
    """Adds ``value``, drawn at the first populated level, and ``value_level``.

    Exactly one draw is used for a row, whatever the level, so a change of one level moves no other
    field. With ``strict``, a row that no level serves stops the query.
    """
    out, n = df, len(levels)
    for i, level in enumerate(levels):
        dist = cdf(level_index(table, level, value, count, smoothing, suppressed), list(level.keys), value, "weight").withColumnsRenamed({"cdf": f"__c{i}", "total": f"__t{i}"})
        out = out.join(dist, list(level.keys), "left") if level.keys else out.join(F.broadcast(dist), F.lit(True), "left")  # one row
    picks = [F.when(F.col(f"__c{i}").isNotNull(), drawn(f"__c{i}", below(data, F.col(f"__t{i}")))) for i in range(n)]
    names = [F.when(F.col(f"__c{i}").isNotNull(), F.lit(level.name)) for i, level in enumerate(levels)]
    chosen = F.coalesce(*names)
    if strict:
        chosen = F.coalesce(chosen, F.raise_error(F.lit(f"no level of {value} is populated")).cast("string"))
    return out.withColumn(value, F.coalesce(*picks)).withColumn(f"{value}_level", chosen).drop(*(f"__{x}{i}" for i in range(n) for x in "ct"))


def backoff_rates(df: DataFrame, column: str, first: str) -> DataFrame:
    """(level, n, share, backed_off): how often each level was used, and whether it lies below the first."""
    return normalised(df, [column]).withColumn("backed_off", F.col(column) != first).withColumnRenamed(column, "level")
