"""Queries over sources: files are written to a scratch folder from the shared tables, then read as a user's would be."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.operators import compare, quota, repair
from strataforge.plans.registry import query
from strataforge.sources import cubes, listings, tables


@query("""
SELECT s_suppkey::VARCHAR AS code, s_suppkey || ' ' || s_name AS label, CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 5 = 0 THEN 0 ELSE s_nationkey END::BIGINT AS count, s_suppkey % 7 = 0 AS suppressed,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 = 0 AND s_suppkey % 2 = 0 THEN 'malformed' WHEN s_suppkey % 5 = 0 THEN 'non-integral' END AS problem FROM supplier""")
def cube_csv(t):
    k = F.col("s_suppkey")
    raw = F.when(k % 7 == 0, "..").when((k % 5 == 0) & (k % 2 == 0), "n/a").when(k % 5 == 0, "1.5").otherwise(F.col("s_nationkey").cast("string"))
    path = tables.scratch(t.spark, "cube")
    t.supplier.select(F.concat_ws(" ", k.cast("string"), "s_name").alias("SUPP"), raw.alias("INDHOLD")).write.options(sep=";", header=True, emptyValue="").csv(path)
    cube = cubes.with_counts(cubes.read_cube(t.spark, path, ["SUPP"]), strict=False)
    return cube.select(F.col("SUPP").alias("code"), F.col("SUPP__label").alias("label"), "count", "suppressed", "problem")


@query("""
SELECT s_suppkey::VARCHAR AS code, n_name AS middle_title, r_name AS top_title FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def listing_hierarchy(t):
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    leaf = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    place = lambda region, nation, leaf: F.struct(region.cast("int"), nation.cast("int"), leaf.cast("int"))
    rows = t.region.select(place(F.col("r_regionkey"), F.lit(-1), F.lit(-1)).alias("seq"), F.lit(1).alias("level"), F.concat(F.lit("R"), "r_regionkey").alias("code"), F.col("r_name").alias("title"))
    rows = rows.unionByName(nation.select(place(F.col("r_regionkey"), F.col("n_nationkey"), F.lit(-1)).alias("seq"), F.lit(2).alias("level"), F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("title")))
    rows = rows.unionByName(leaf.select(place(F.col("r_regionkey"), F.col("n_nationkey"), F.col("s_suppkey")).alias("seq"), F.lit(3).alias("level"), F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("title")))
    return listings.hierarchy(rows).select("code", "middle_title", "top_title")


@query("SELECT n_nationkey::DOUBLE AS k, n_name AS name, NULL::VARCHAR AS extra FROM nation UNION ALL SELECT s_acctbal, NULL, 'supplier' FROM supplier")
def widened_union(t):
    a = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.lit(None).alias("extra"))
    return tables.widened_union([a, t.supplier.select(F.col("s_acctbal").alias("k"), F.lit("supplier").alias("extra"))])


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 40 ELSE p_size END AS p_size FROM part")
def staged_repair(t):
    rows = t.part.select("p_partkey", "p_size")
    cap = lambda d: d.withColumn("p_size", F.least("p_size", F.lit(40)))
    out, _ = repair.staged(rows, [("cap", cap, lambda d: d.filter("p_size < 0"))])
    return out


@query("SELECT p_partkey, p_size FROM part")
def staged_rollback(t):
    rows = t.part.select("p_partkey", "p_size")
    drop = lambda d: d.withColumn("p_size", F.lit(0))
    out, _ = repair.staged(rows, [("first", drop, lambda d: d.filter("p_size < 0")), ("second", drop, lambda d: d.filter("p_size = 0"))])
    return out


@query("SELECT o_orderpriority, count(*) AS n, CASE WHEN count(*) >= 3000 THEN 0.02 ELSE 0.05 END::DOUBLE AS threshold FROM orders GROUP BY 1")
def size_thresholds(t):
    n = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("threshold", compare.size_dependent(F.col("n"), 0.02, 0.05, 3000))


@query("SELECT c_mktsegment AS value, sum(n) OVER (ORDER BY c_mktsegment)::BIGINT AS upto FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)")
def cumulative_weights(t):
    table = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return quota.cdf(table, [], "c_mktsegment", "n").select(F.explode("cdf").alias("x")).select("x.value", "x.upto")
