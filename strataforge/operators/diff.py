"""Diffs of two versions of a table, ledgers, layered merges and content hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.functions.text import canonical_json, flags, lexical_identity, normalised_set
from strataforge.operators.joins import ranged_index


def _paired(before: DataFrame, after: DataFrame, key: str, columns: list[str], how: str = "inner") -> DataFrame:
    old = before.select(key, *(F.col(c).alias(f"__old_{c}") for c in columns))
    new = after.select(key, *(F.col(c).alias(f"__new_{c}") for c in columns))
    return old.join(new, key, how)


def _changed(columns: list[str]) -> dict[str, Column]:
    return {c: ~F.col(f"__old_{c}").eqNullSafe(F.col(f"__new_{c}")) for c in columns}


def frame_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, changed): names of the columns that differ, for ids of both tables with a difference; nulls are values."""
    return _paired(before, after, key, columns).select(key, flags(_changed(columns)).alias("changed")).filter(F.size("changed") > 0)


def changed_facts(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, facts): map from each changed column to its old and new value as text."""
    pairs = F.array(*(F.when(c, F.struct(F.lit(k).alias("key"), F.struct(F.col(f"__old_{k}").cast("string").alias("old"), F.col(f"__new_{k}").cast("string").alias("new")).alias("value"))) for k, c in _changed(columns).items()))
    return _paired(before, after, key, columns).select(key, F.map_from_entries(F.filter(pairs, lambda x: x.isNotNull())).alias("facts")).filter(F.size("facts") > 0)


def identity_report(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: ids only in the one or the other, and ids that repeat in either."""
    a, b = (d.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for d, n in ((before, "__a"), (after, "__b")))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return a.join(b, key, "full").agg(n(F.col("__b").isNull()).alias("missing"), n(F.col("__a").isNull()).alias("added"), n(F.coalesce(F.col("__a") > 1, F.lit(False)) | F.coalesce(F.col("__b") > 1, F.lit(False))).alias("repeated"))


def classified(before: DataFrame, after: DataFrame, key: str, texts: list[str], lists: list[str], frozen: list[str]) -> DataFrame:
    """(key, changed, safe): a change is safe if texts keep their lexical identity, lists their set, and frozen columns all."""
    columns = [*texts, *lists, *frozen]
    ok = F.lit(True)
    for c in texts:
        ok = ok & lexical_identity(F.col(f"__old_{c}")).eqNullSafe(lexical_identity(F.col(f"__new_{c}")))
    for c in lists:
        ok = ok & F.coalesce(normalised_set(F.col(f"__old_{c}")) == normalised_set(F.col(f"__new_{c}")), F.lit(False))
    for c in frozen:
        ok = ok & F.col(f"__old_{c}").eqNullSafe(F.col(f"__new_{c}"))
    return _paired(before, after, key, columns).select(key, flags(_changed(columns)).alias("changed"), ok.alias("safe")).filter(F.size("changed") > 0)


def ledger_mismatches(diff: DataFrame, ledger: DataFrame, key: str, field: str) -> DataFrame:
    """(key, field, problem): changes without an entry, and entries without a change."""
    real = diff.select(key, F.explode("changed").alias(field)).withColumn("__real", F.lit(True))
    told = ledger.select(key, field).distinct().withColumn("__told", F.lit(True))
    both = real.join(told, [key, field], "full")
    return both.withColumn("problem", F.when(F.col("__told").isNull(), "unrecorded").when(F.col("__real").isNull(), "unfounded")).filter("problem is not null").select(key, field, "problem")


def differing_columns(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(column_name, rows): how many rows differ in each column, in one pass."""
    one = _paired(before, after, key, columns).agg(*(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in _changed(columns).items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("rows")) for c in columns))).alias("x")).select("x.*")


def only_differs(before: DataFrame, after: DataFrame, key: str, columns: list[str], allowed: list[str]) -> DataFrame:
    """Columns that differ although they may not; empty if the assertion holds."""
    return differing_columns(before, after, key, columns).filter((F.col("rows") > 0) & ~F.col("column_name").isin(allowed))


def multiset_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_a, n_b) where the numbers of equal rows differ; nulls are values."""
    both = a.select(*keys, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(b.select(*keys, F.lit(0).alias("__a"), F.lit(1).alias("__b")))
    return both.groupBy(*keys).agg(F.sum("__a").alias("n_a"), F.sum("__b").alias("n_b")).filter("n_a <> n_b")


def sets_equal(sets: dict[str, DataFrame], column: str) -> DataFrame:
    """Values that not all of the sets hold, with those that do."""
    union = None
    for name, df in sets.items():
        one = df.select(F.col(column).alias("value"), F.lit(name).alias("set_name")).distinct()
        union = one if union is None else union.unionByName(one)
    return union.groupBy("value").agg(F.sort_array(F.collect_set("set_name")).alias("held_by")).filter(F.size("held_by") < len(sets))


def accepted_text(base: DataFrame, proposals: DataFrame, decisions: DataFrame, key: str, text: str) -> DataFrame:
    """The proposed text where a decision accepts exactly that text (by its hash), else the base text."""
    p = proposals.select(key, F.col("text").alias("__p"), F.sha2("text", 256).alias("__h"))
    d = decisions.filter(F.col("accepted")).select(key, F.col("text_sha256").alias("__d"))
    out = base.join(p, key, "left").join(d, key, "left")
    take = F.coalesce(F.col("__h") == F.col("__d"), F.lit(False))
    return out.withColumn(text, F.when(take, F.col("__p")).otherwise(F.col(text))).withColumn("from_proposal", take).drop("__p", "__h", "__d")


def layered(base: DataFrame, first: DataFrame, second: DataFrame, key: str, column: str) -> DataFrame:
    """(key, column, layer): the second set of overrides wins over the first where both have the id."""
    out = base.join(first.select(key, F.col(column).alias("__1")), key, "left").join(second.select(key, F.col(column).alias("__2")), key, "left")
    layer = F.when(F.col("__2").isNotNull(), "second").when(F.col("__1").isNotNull(), "first").otherwise("base")
    return out.select(key, F.coalesce("__2", "__1", column).alias(column), layer.alias("layer"))


def reason_union(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, reasons): every id of any part, with the sorted reasons for which it is there."""
    out = None
    for reason, df in parts.items():
        one = df.select(key, F.lit(reason).alias("reason"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy(key).agg(F.sort_array(F.collect_set("reason")).alias("reasons"))


def reason_histogram(df: DataFrame, column: str = "reasons") -> DataFrame:
    """(code, n) over the codes of all rows."""
    return df.select(F.explode(column).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def reconciliation(selected: DataFrame, processed: DataFrame, pending: DataFrame, key: str) -> DataFrame:
    """One row: ids of neither part, of both parts, and of a part that were not selected."""
    mark = lambda d, n: d.select(key).distinct().withColumn(n, F.lit(True))
    all_ = mark(selected, "__s").join(mark(processed, "__p"), key, "full").join(mark(pending, "__q"), key, "full")
    s, p, q = (F.coalesce(F.col(c), F.lit(False)) for c in ("__s", "__p", "__q"))
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return all_.agg(n(s).alias("selected"), n(s & ~p & ~q).alias("uncovered"), n(p & q).alias("in_both"), n(~s).alias("unselected"))


def merged_shards(shards: list[DataFrame], expected: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(union by name, report): missing, foreign and repeated ids of the union against the expected ones."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out, identity_report(expected.select(key), out.select(key), key)


def content_hash(df: DataFrame, order: list[str], columns: list[str] | None = None, chunk: int = 10_000) -> DataFrame:
    """One row: hash of all rows in order, as SHA-256 over chunk hashes.

    Each row's canonical JSON is hashed; hashes of ``chunk`` consecutive rows are hashed together,
    and so are the chunks' hashes, level by level, until one is left: no task sees all rows.
    """
    level = ranged_index(df.withColumn("__h", F.sha2(canonical_json(columns or df.columns), 256)), order, "__i").select(F.col("__i").alias("i"), F.col("__h").alias("h"))
    n = df.count()
    while True:
        level = level.groupBy(F.floor(F.col("i") / chunk).alias("i")).agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]), ""), 256).alias("h"))
        n = -(-n // chunk)
        if n <= 1:
            return level.select(F.col("h").alias("content_hash"))


def layer_identity(a_accepted: int, overlap: int, b_accepted: int, changed: int) -> bool:
    """Whether accepted_a - overlap + accepted_b = changed."""
    return a_accepted - overlap + b_accepted == changed
