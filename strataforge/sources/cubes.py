"""Count cubes from semicolon CSV: dimensions by position, codes and labels split, counts checked."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cell texts that mean a suppressed cell.
SUPPRESSED = ("", ".", "..")


def read_cube(spark: SparkSession, path: str, dimensions: list[str]) -> DataFrame:
    """Each dimension's code (text before the first space) and ``<dim>__label`` (whole text), and ``raw``.

    The first line is a header and may start with a byte order mark; a line with another number of
    columns than dimensions + 1 stops the query.
    """
    names = [*dimensions, "raw", "__beyond"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "__bad"]])
    df = spark.read.options(sep=";", header=True, enforceSchema=True, encoding="UTF-8", mode="PERMISSIVE", columnNameOfCorruptRecord="__bad").schema(schema).csv(path)
    header = F.coalesce(F.col("raw"), F.lit(""))
    ok = F.when(F.col("__beyond").isNull() & F.col(dimensions[-1]).isNotNull(), F.lit(True)).otherwise(F.raise_error(F.lit("a line has another number of columns")).cast("boolean"))
    # the corrupt record column must not be the only one read; short lines of one missing count are suppressed cells
    df = df.filter(ok)
    return df.select(*(F.substring_index(d, " ", 1).alias(d) for d in dimensions), *(F.col(d).alias(f"{d}__label") for d in dimensions), header.alias("raw"))


def with_counts(cube: DataFrame, strict: bool = True) -> DataFrame:
    """Adds ``count`` (bigint), ``suppressed`` and ``problem`` (malformed, non-integral, negative or null) from ``raw``.

    A suppressed cell counts 0. With ``strict`` a problem stops the query and the column is dropped.
    """
    text = F.trim("raw")
    gone = text.isin(*SUPPRESSED)
    number = text.try_cast("decimal(38,10)")
    problem = F.when(gone, F.lit(None).cast("string")).when(number.isNull(), "malformed").when(number % 1 != 0, "non-integral").when(number < 0, "negative")
    out = cube.withColumn("suppressed", gone).withColumn("problem", problem).withColumn("count", F.when(gone | problem.isNotNull(), F.lit(0).cast("long")).otherwise(number.try_cast("long")))
    if not strict:
        return out
    return out.filter(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.col("problem"), F.lit(" count: "), F.col("raw"))).cast("boolean"))).drop("problem", "raw")


def reject_negative(df: DataFrame, count: str = "count") -> DataFrame:
    """``df``; a negative count stops the query when it is read."""
    return df.filter(F.when(F.col(count) < 0, F.raise_error(F.lit("negative count")).cast("boolean")).otherwise(F.lit(True)))


@dataclass(frozen=True)
class Selection:
    """A dimension and which of its values a query takes."""

    variable: str
    selector: str


#: Selectors of metadata values, as predicates on (id, text).
SELECTORS = {
    "all": lambda i, x: F.lit(True),
    "non_total": lambda i, x: ~F.upper(i).isin("TOT", "IALT", "0"),
    "municipalities": lambda i, x: i.rlike(r"^\d{3}$") & ~i.startswith("0"),
    "regions": lambda i, x: i.rlike(r"^08[1-5]$"),
    "adult_exact_ages": lambda i, x: i.try_cast("int") >= 18,
    "age_16_plus": lambda i, x: F.regexp_extract(i, r"^(\d+)", 1).try_cast("int") >= 16,
    "adult_ras_ages": lambda i, x: F.regexp_extract(i, r"^(\d+)", 1).try_cast("int") >= 18,
}


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(variable, place, id, text) of a metadata document: variables with their values, in order."""
    value = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])
    schema = T.StructType([T.StructField("variables", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("values", T.ArrayType(value))])))])
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.select(F.explode("variables").alias("v")).select(F.col("v.id").alias("variable"), F.posexplode("v.values").alias("place", "x")).select("variable", "place", "x.id", "x.text")


def selected_values(metadata: DataFrame, selections: list[Selection]) -> DataFrame:
    """Values that the selections take; an unknown selector or a variable without a value stops the query."""
    out = None
    for s in selections:
        if s.selector not in SELECTORS:
            raise ValueError(f"unknown selector {s.selector}")
        one = metadata.filter((F.col("variable") == s.variable) & F.coalesce(SELECTORS[s.selector](F.col("id"), F.col("text")), F.lit(False)))
        out = one if out is None else out.unionByName(one)
    empty = [s.variable for s in selections if s.variable not in {r[0] for r in out.select("variable").distinct().collect()}]
    if empty:
        raise ValueError(f"no values selected for {empty}")
    return out


def unknown_values(metadata: DataFrame, wanted: DataFrame) -> DataFrame:
    """(variable, id) that are wanted but that the metadata lacks."""
    return wanted.select("variable", "id").distinct().join(metadata.select("variable", "id").distinct(), ["variable", "id"], "left_anti")


def estimated_cells(selected: DataFrame, most: int | None = 1_000_000) -> int:
    """Product of the numbers of values times (dimensions + 1); beyond ``most`` an error, unless None."""
    sizes = [r["count"] for r in selected.groupBy("variable").count().collect()]
    cells = len(sizes) + 1
    for n in sizes:
        cells *= n
    if most is not None and cells > most:
        raise ValueError(f"the query asks for {cells} cells, more than {most}")
    return cells
