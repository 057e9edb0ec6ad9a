"""Audits: row validity, mappings, partitions of cubes, source support, release reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.buckets import eligible
from strataforge.functions.text import flags
from strataforge.operators.compare import marginal_drift
from strataforge.operators.diff import differing_columns, identity_report
from strataforge.operators.joins import existence, not_in
from strataforge.operators.weights import blank_profile, collisions


def invalid_rows(df: DataFrame, valid: Column) -> DataFrame:
    """One row: rows and how many are not valid; a null verdict is not valid."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum((~F.coalesce(valid, F.lit(False))).cast("long")), F.lit(0)).alias("invalid"))


def structure(df: DataFrame, id_col: str, expected_rows: int) -> DataFrame:
    """One row: rows, unique ids, and whether both are as expected."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(id_col).alias("ids")).withColumn("passed", (F.col("rows") == expected_rows) & (F.col("ids") == expected_rows))


def schema_differences(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """What a table's columns lack or have beyond an exact contract of names and types."""
    have = dict(df.dtypes)
    return sorted([f"missing {c}" for c in expected.keys() - have.keys()] + [f"extra {c}" for c in have.keys() - expected.keys()] + [f"{c} is {have[c]}, not {t}" for c, t in expected.items() if c in have and have[c] != t])


def mapping_differences(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, problem): keys of one mapping only, keys that repeat, and keys on whose value the two disagree."""
    side = lambda d, n: d.groupBy(key).agg(F.count(F.lit(1)).alias(f"__n{n}"), F.min(value).alias(f"__v{n}"))
    both = side(a, 0).join(side(b, 1), key, "full")
    problem = F.when(F.col("__n0").isNull(), "extra").when(F.col("__n1").isNull(), "missing").when((F.col("__n0") > 1) | (F.col("__n1") > 1), "duplicate").when(~F.col("__v0").eqNullSafe(F.col("__v1")), "disagree")
    return both.withColumn("problem", problem).filter("problem is not null").select(key, "problem")


def partition_findings(cube: DataFrame, codes: DataFrame, code: str, groups: list[str], group: str, count: str = "count", suppressed: str = "suppressed") -> DataFrame:
    """(code, group, problem): cells of the full codes x groups cover that are absent, repeated, suppressed or not positive, and foreign cells.

    The cover is the code list, exploded by the fixed groups.
    """
    cover = codes.select(code).distinct().withColumn(group, F.explode(F.array(*map(F.lit, groups)))).withColumn("__due", F.lit(True))
    have = cube.groupBy(code, group).agg(F.count(F.lit(1)).alias("__n"), F.min(count).alias("__low"), F.bool_or(suppressed).alias("__sup"))
    both = cover.join(have, [code, group], "full")
    problem = F.when(F.col("__due").isNull(), "foreign").when(F.col("__n").isNull(), "absent").when(F.col("__n") > 1, "repeated").when(F.col("__sup"), "suppressed").when(~(F.col("__low") > 0), "not positive")
    return both.withColumn("problem", problem).filter("problem is not null").select(code, group, "problem")


def pair_audit(df: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows whose combination of columns the contract lacks, nulls compared as values."""
    return not_in(df, known, columns).agg(F.count(F.lit(1)).alias("rows"))


def source_support(df: DataFrame, sources: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(source, supported, unsupported): rows for whose key combination a source has an eligible cell.

    ``df`` has each source's key columns; a null key is unsupported.
    """
    out = df
    for name, (cells, keys) in sources.items():
        out = existence(out, cells.filter(eligible()), keys, f"__{name}")
    one = out.agg(*(F.coalesce(F.sum(F.col(f"__{n}").cast("long")), F.lit(0)).alias(n) for n in sources), F.count(F.lit(1)).alias("__rows"))
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("source"), F.col(n).alias("supported"), (F.col("__rows") - F.col(n)).alias("unsupported")) for n in sources))).alias("x")).select("x.*")


def field_findings(df: DataFrame, id_col: str, hard: dict[str, Column], advisory: dict[str, Column]) -> DataFrame:
    """(id, failures, advice): names of the checks that hold for each row."""
    return df.select(id_col, flags(hard).alias("failures"), flags(advisory).alias("advice"))


def prose_changes(before: DataFrame, after: DataFrame, id_col: str, text: str, vetted: DataFrame) -> DataFrame:
    """One row: changed texts, and those whose id's hash is not on the vetted list (``id_sha256``)."""
    both = before.select(id_col, F.col(text).alias("__a")).join(after.select(id_col, F.col(text).alias("__b")), id_col).filter(~F.col("__a").eqNullSafe(F.col("__b")))
    known = vetted.select("id_sha256").distinct().withColumn("__known", F.lit(True))
    marked = both.join(known, F.sha2(F.col(id_col).cast("string"), 256) == F.col("id_sha256"), "left")
    return marked.agg(F.count(F.lit(1)).alias("changed"), F.coalesce(F.sum(F.col("__known").isNull().cast("long")), F.lit(0)).alias("unvetted"))


def release_report(baseline: DataFrame, candidate: DataFrame, id_col: str, text: str, fields: list[str], frozen: list[str], hard: dict[str, Column], vetted: DataFrame, texts: list[str]) -> DataFrame:
    """(section, name, value): identity, unvetted prose, frozen columns, failures, drift, collisions and blanks of a candidate."""
    def long(df: DataFrame, section: str, columns: list[str]) -> DataFrame:
        return df.select(F.explode(F.array(*(F.struct(F.lit(section).alias("section"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns))).alias("x")).select("x.*")

    parts = [
        long(identity_report(baseline, candidate, id_col), "identity", ["missing", "added", "repeated"]),
        long(prose_changes(baseline, candidate, id_col, text, vetted), "prose", ["changed", "unvetted"]),
        differing_columns(baseline, candidate, id_col, frozen).select(F.lit("frozen").alias("section"), F.col("column_name").alias("name"), F.col("rows").cast("double").alias("value")),
        field_findings(candidate, id_col, hard, {}).select(F.explode("failures").alias("name")).groupBy("name").agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("failure").alias("section"), "name", "value"),
        marginal_drift(candidate, baseline, fields).select(F.lit("drift").alias("section"), F.col("field").alias("name"), F.col("total_variation").alias("value")),
        long(collisions(candidate, text), "collision", ["shared_values", "rows_sharing"]),
        blank_profile(candidate, texts).select(F.lit("blank").alias("section"), F.col("column_name").alias("name"), F.col("blanks").cast("double").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Findings that stop a release when they are not zero.
HARD = {("identity", "missing"), ("identity", "added"), ("identity", "repeated"), ("prose", "unvetted")}


def hard_failures(report: DataFrame) -> DataFrame:
    """The report's rows that stop a release: hard findings, frozen columns that differ, failures and blanks, where not zero."""
    named = F.concat_ws("/", "section", "name").isin([f"{a}/{b}" for a, b in sorted(HARD)])
    return report.filter((F.col("value") > 0) & (named | F.col("section").isin("frozen", "failure", "blank")))


def reservation_invariants(df: DataFrame, account: str, kind: str, amount: str, cap: float) -> DataFrame:
    """(account, reserved, settled, within_cap, settled_within_reserved): a ledger's invariants by account."""
    of = lambda k: F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(amount))), F.lit(0.0))
    one = df.groupBy(account).agg(of("reserve").alias("reserved"), of("settle").alias("settled"))
    return one.withColumn("within_cap", F.col("reserved") + F.col("settled") <= cap).withColumn("settled_within_reserved", F.col("settled") <= F.col("reserved"))
