"""Queries over joins, set operations, diffs and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.operators import audit, diff, joins
from strataforge.plans.registry import query


@query("""
SELECT count(*) AS rows, count(*) FILTER (n_nationkey IS NULL) AS unmatched, 0::BIGINT AS repeated
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_completeness(t):
    return joins.lookup_report(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, "n_nationkey")


@query("""
SELECT r_name, c_mktsegment, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def geo_lookup_join(t):
    place = joins.lookup(t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), t.region, "r_regionkey", ["r_name"])
    rows = joins.lookup(t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment"), place, "n_nationkey", ["r_name"])
    return rows.groupBy("r_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("""
SELECT l_shipdate_year, round(r / nullif(a, 0), 9) AS ratio FROM (SELECT year(l_shipdate) AS l_shipdate_year, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r, count(*) AS a FROM lineitem GROUP BY 1) WHERE r > 0""")
def ratio_join(t):
    rows = t.lineitem.select(F.year("l_shipdate").alias("l_shipdate_year"), "l_returnflag")
    a = rows.filter("l_returnflag = 'R'").groupBy("l_shipdate_year").agg(F.count(F.lit(1)).alias("r"))
    b = rows.groupBy("l_shipdate_year").agg(F.count(F.lit(1)).alias("a"))
    return joins.ratio(a, b, ["l_shipdate_year"], "r", "a").withColumn("ratio", F.round("ratio", 9))


@query("""
SELECT p_brand, coalesce(a.n, 0) AS small, coalesce(b.n, 0) AS large FROM (SELECT p_brand, count(*) AS n FROM part WHERE p_size <= 2 GROUP BY 1) a FULL JOIN (SELECT p_brand, count(*) AS n FROM part WHERE p_size >= 49 GROUP BY 1) b USING (p_brand)""")
def full_outer_counts(t):
    n = lambda c: t.part.filter(c).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return joins.full_counts(n("p_size <= 2"), n("p_size >= 49"), ["p_brand"], ("small", "large"))


@query("""
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1""")
def null_safe_anti(t):
    known = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.not_in(t.orders.filter("o_totalprice > 100000").select("o_orderkey", "o_orderpriority"), known, ["o_orderkey"]).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS outside FROM (SELECT * FROM orders WHERE o_totalprice > 200000 EXCEPT ALL SELECT * FROM orders WHERE o_orderstatus <> 'P')")
def subset_proof(t):
    rows = t.orders
    return joins.outside(rows.filter("o_totalprice > 200000"), rows.filter("o_orderstatus <> 'P'")).agg(F.count(F.lit(1)).alias("outside"))


@query("SELECT o_orderstatus, count(*) AS n FROM (SELECT o_orderstatus, o_custkey FROM orders EXCEPT ALL SELECT o_orderstatus, o_custkey FROM orders WHERE o_totalprice > 50000) GROUP BY 1")
def multiset_difference(t):
    rows = t.orders.select("o_orderstatus", "o_custkey", "o_totalprice")
    return joins.outside(rows.select("o_orderstatus", "o_custkey"), rows.filter("o_totalprice > 50000"), multiplicity=True).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_mktsegment, has_order, count(*) AS n FROM (SELECT c_mktsegment, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000) AS has_order FROM customer) GROUP BY ALL""")
def existence_flag(t):
    known = t.orders.filter("o_orderpriority = '1-URGENT' AND o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.existence(t.customer, known, ["c_custkey"], "has_order").groupBy("c_mktsegment", "has_order").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, lang FROM documents WHERE text IN (SELECT text FROM documents WHERE source = 'src0')")
def forbidden_set(t):
    docs = t.documents
    return joins.is_in(docs.select("doc_id", "lang", "text"), docs.filter("source = 'src0'").select("text"), ["text"]).select("doc_id", "lang")


@query("""
SELECT s_suppkey, p_partkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS i FROM supplier) JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS i FROM part) USING (i)""")
def positional_zip(t):
    right = t.part.select("p_partkey", (-F.col("p_retailprice")).alias("down"))
    return joins.zipped(t.supplier.select("s_suppkey", "s_acctbal"), right, ["s_acctbal", "s_suppkey"], ["down", "p_partkey"]).select("s_suppkey", "p_partkey")


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def ordered_update(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    changes = rows.filter("c_acctbal < 0").select("c_custkey", F.lit("DEBT").alias("c_mktsegment"))
    return joins.updated(rows, changes, "c_custkey", ["c_mktsegment"]).select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey FROM customer WHERE sha256(c_custkey::VARCHAR) IN (SELECT sha256(o_custkey::VARCHAR) FROM orders WHERE o_totalprice > 400000)")
def hash_lookup(t):
    hashes = t.orders.filter("o_totalprice > 400000").select(F.sha2(F.col("o_custkey").cast("string"), 256).alias("h"))
    return joins.hashed_in(t.customer.select("c_custkey"), "c_custkey", hashes, "h")


@query("SELECT doc_id, row_number() OVER (ORDER BY text, doc_id) - 1 AS row_idx FROM documents")
def row_index(t):
    return joins.ranged_index(t.documents.select("doc_id", "text"), ["text", "doc_id"]).select("doc_id", "row_idx")


@query("SELECT s_suppkey, s_name FROM (SELECT *, row_number() OVER (ORDER BY s_name, s_suppkey) - 1 AS i FROM supplier) WHERE i BETWEEN 20 AND 34")
def slice_rows(t):
    return joins.ranged_index(t.supplier.select("s_suppkey", "s_name"), ["s_name", "s_suppkey"], "i").filter("i between 20 and 34").drop("i")


@query("""
SELECT DISTINCT s_nationkey AS k FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9900""")
def set_difference(t):
    return t.supplier.select(F.col("s_nationkey").alias("k")).distinct().subtract(t.customer.filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("k")))


@query("""
SELECT value, array_to_string(list_sort(list(set_name)), ',') AS held_by FROM (SELECT DISTINCT n_nationkey AS value, 'nation' AS set_name FROM nation UNION SELECT s_nationkey, 'supplier' FROM supplier WHERE s_acctbal > 8000 UNION SELECT c_nationkey, 'customer' FROM customer WHERE c_acctbal > 9800) GROUP BY 1 HAVING count(*) < 3""")
def set_equality(t):
    sets = {"nation": t.nation.select(F.col("n_nationkey").alias("k")), "supplier": t.supplier.filter("s_acctbal > 8000").select(F.col("s_nationkey").alias("k")), "customer": t.customer.filter("c_acctbal > 9800").select(F.col("c_nationkey").alias("k"))}
    return diff.sets_equal(sets, "k").withColumn("held_by", F.array_join("held_by", ","))


@query("""
WITH n AS (SELECT o_orderstatus, o_orderpriority, count(*) FILTER (o_orderkey % 2 = 0) AS n_a, count(*) FILTER (o_orderkey % 2 = 1) AS n_b FROM orders GROUP BY ALL) SELECT * FROM n WHERE n_a <> n_b""")
def multiset_equal(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return diff.multiset_differences(rows.filter("o_orderkey % 2 = 0"), rows.filter("o_orderkey % 2 = 1"), ["o_orderstatus", "o_orderpriority"])


def _perturbed(labels):
    """A second version of ``labels``: some values flipped, some lost."""
    quality = F.when(F.col("doc_id") % 7 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    toxic = F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("int")).otherwise(F.col("toxic"))
    return labels.select("doc_id", quality.alias("quality"), toxic.alias("toxic"))


_NEW = "(SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS quality, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE toxic END AS toxic FROM labels)"
_DIFF = f"(SELECT doc_id, o.quality IS DISTINCT FROM n.quality AS q, o.toxic IS DISTINCT FROM n.toxic AS t, o.quality AS oq, n.quality AS nq, o.toxic AS ot, n.toxic AS nt FROM labels o JOIN {_NEW} n USING (doc_id))"


@query(f"SELECT doc_id, CASE WHEN q AND t THEN 'quality,toxic' WHEN q THEN 'quality' ELSE 'toxic' END AS changed FROM {_DIFF} WHERE q OR t")
def frame_diff(t):
    return diff.frame_diff(t.labels, _perturbed(t.labels), "doc_id", ["quality", "toxic"]).withColumn("changed", F.array_join("changed", ","))


@query(f"SELECT doc_id, 'quality' AS field, oq::VARCHAR AS old, nq::VARCHAR AS new FROM {_DIFF} WHERE q UNION ALL SELECT doc_id, 'toxic', ot::VARCHAR, nt::VARCHAR FROM {_DIFF} WHERE t")
def changed_facts(t):
    facts = diff.changed_facts(t.labels, _perturbed(t.labels), "doc_id", ["quality", "toxic"])
    return facts.select("doc_id", F.explode("facts").alias("field", "v")).select("doc_id", "field", "v.old", "v.new")


@query(f"SELECT doc_id, 'toxic' AS field, 'unrecorded' AS problem FROM {_DIFF} WHERE t UNION ALL SELECT doc_id, 'quality', 'unfounded' FROM labels WHERE doc_id % 13 = 0 AND doc_id % 7 <> 0")
def ledger_check(t):
    changes = diff.frame_diff(t.labels, _perturbed(t.labels), "doc_id", ["quality", "toxic"])
    told = t.labels.filter("doc_id % 7 = 0 OR doc_id % 13 = 0").select("doc_id", F.lit("quality").alias("field"))
    return diff.ledger_mismatches(changes, told, "doc_id", "field")


@query(f"SELECT 'quality' AS column_name, count(*) FILTER (q) AS rows FROM {_DIFF} UNION ALL SELECT 'toxic', count(*) FILTER (t) FROM {_DIFF}")
def differing_columns(t):
    return diff.differing_columns(t.labels, _perturbed(t.labels), "doc_id", ["quality", "toxic"])


@query("""
SELECT count(*) FILTER (b.doc_id IS NULL) AS missing, count(*) FILTER (a.doc_id IS NULL) AS added, 0::BIGINT AS repeated FROM (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0) a FULL JOIN (SELECT doc_id FROM labels) b ON a.doc_id = b.doc_id""")
def identity_report(t):
    return diff.identity_report(t.documents.filter("doc_id % 3 <> 0").select("doc_id"), t.labels.select("doc_id"), "doc_id")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'b' WHEN o_totalprice > 200000 THEN 'a' ELSE o_orderpriority END AS o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN 'second' WHEN o_totalprice > 200000 THEN 'first' ELSE 'base' END AS layer FROM orders""")
def layered_merge(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    a = rows.filter("o_totalprice > 200000").select("o_orderkey", F.lit("a").alias("o_orderpriority"))
    b = rows.filter("o_orderkey % 5 = 0").select("o_orderkey", F.lit("b").alias("o_orderpriority"))
    return diff.layered(rows, a, b, "o_orderkey", "o_orderpriority")


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS p_name, p_partkey % 12 = 0 AS from_proposal FROM part""")
def acceptance_merge(t):
    rows = t.part.select("p_partkey", "p_name")
    proposals = rows.filter("p_partkey % 4 = 0").select("p_partkey", F.upper("p_name").alias("text"))
    accepted = proposals.filter("p_partkey % 3 = 0").select("p_partkey", F.sha2("text", 256).alias("text_sha256"), F.lit(True).alias("accepted"))
    stale = proposals.filter("p_partkey % 3 = 1").select("p_partkey", F.sha2(F.lit("other"), 256).alias("text_sha256"), F.lit(True).alias("accepted"))
    return diff.accepted_text(rows, proposals, accepted.unionByName(stale), "p_partkey", "p_name")


_REASONS = "(SELECT doc_id, 'long' AS r FROM documents WHERE n_chars > 5000 UNION SELECT doc_id, 'foreign' FROM documents WHERE lang <> 'en' UNION SELECT doc_id, 'flagged' FROM labels WHERE toxic = 1)"


def _reason_parts(t):
    return {"long": t.documents.filter("n_chars > 5000"), "foreign": t.documents.filter("lang <> 'en'"), "flagged": t.labels.filter("toxic = 1")}


@query(f"SELECT doc_id, string_agg(r, ',' ORDER BY r) AS reasons FROM {_REASONS} GROUP BY 1")
def reason_union(t):
    return diff.reason_union(_reason_parts(t), "doc_id").withColumn("reasons", F.array_join("reasons", ","))


@query(f"SELECT r AS code, count(*) AS n FROM {_REASONS} GROUP BY 1")
def reason_histogram(t):
    return diff.reason_histogram(diff.reason_union(_reason_parts(t), "doc_id"))


@query("""
SELECT count(*) AS selected, count(*) FILTER (doc_id % 4 IN (2)) AS uncovered, count(*) FILTER (doc_id % 12 = 0) AS in_both, 0::BIGINT AS unselected FROM labels""")
def reconciliation(t):
    rows = t.labels.select("doc_id")
    return diff.reconciliation(rows, rows.filter("doc_id % 4 IN (0, 1)"), rows.filter("doc_id % 4 = 3 OR doc_id % 12 = 0"), "doc_id")


@query("""
SELECT count(*) FILTER (b.n IS NULL) AS missing, count(*) FILTER (a.doc_id IS NULL) AS added, count(*) FILTER (b.n > 1) AS repeated
FROM documents a FULL JOIN (SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id FROM documents WHERE doc_id % 3 = 0) GROUP BY 1) b ON a.doc_id = b.doc_id""")
def shard_merge(t):
    docs = t.documents.select("doc_id", "lang")
    _, report = diff.merged_shards([docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 3 = 0").drop("lang")], docs, "doc_id")
    return report


@query("""
SELECT key AS n_nationkey, problem FROM (SELECT coalesce(a.k, b.k) AS key, CASE WHEN a.k IS NULL THEN 'extra' WHEN b.k IS NULL THEN 'missing' WHEN a.v <> b.v THEN 'disagree' END AS problem
FROM (SELECT n_nationkey AS k, n_regionkey AS v FROM nation WHERE n_nationkey <> 3) a FULL JOIN (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 6 = 0 THEN 9 ELSE n_regionkey END AS v FROM nation WHERE n_nationkey <> 7) b ON a.k = b.k) WHERE problem IS NOT NULL""")
def mapping_cross_check(t):
    a = t.nation.select("n_nationkey", "n_regionkey").filter("n_nationkey <> 3")
    b = t.nation.filter("n_nationkey <> 7").select("n_nationkey", F.when(F.col("n_nationkey") % 6 == 0, F.lit(9)).otherwise(F.col("n_regionkey")).alias("n_regionkey"))
    return audit.mapping_differences(a, b, "n_nationkey", "n_regionkey")


@query("""
WITH c AS (SELECT c_nationkey AS code, c_mktsegment AS grp, count(*) AS n FROM customer WHERE c_acctbal > 8500 GROUP BY ALL), d AS (SELECT n_nationkey AS code, unnest(['BUILDING', 'MACHINERY']) AS grp FROM nation)
SELECT coalesce(c.code, d.code) AS code, coalesce(c.grp, d.grp) AS grp, CASE WHEN d.code IS NULL THEN 'foreign' WHEN c.code IS NULL THEN 'absent' WHEN n > 3 THEN 'suppressed' END AS problem
FROM c FULL JOIN d ON c.code = d.code AND c.grp = d.grp WHERE d.code IS NULL OR c.code IS NULL OR n > 3""")
def cube_partition(t):
    cube = t.customer.filter("c_acctbal > 8500").groupBy(F.col("c_nationkey").alias("code"), F.col("c_mktsegment").alias("grp")).agg(F.count(F.lit(1)).alias("count")).withColumn("suppressed", F.col("count") > 3)
    return audit.partition_findings(cube, t.nation.select(F.col("n_nationkey").alias("code")), "code", ["BUILDING", "MACHINERY"], "grp")


@query("""
WITH s AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9000), r AS (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 9950)
SELECT 'cells' AS source, count(*) FILTER (s.c_nationkey IS NOT NULL) AS supported, count(*) FILTER (s.c_nationkey IS NULL) AS unsupported FROM customer c LEFT JOIN s ON s.c_nationkey = c.c_nationkey AND s.c_mktsegment = c.c_mktsegment
UNION ALL SELECT 'nations', count(*) FILTER (r.c_nationkey IS NOT NULL), count(*) FILTER (r.c_nationkey IS NULL) FROM customer c LEFT JOIN r ON r.c_nationkey = c.c_nationkey""")
def source_support(t):
    rows = t.customer.select("c_nationkey", "c_mktsegment", "c_acctbal")
    cells = lambda keys, low: rows.groupBy(*keys).agg(F.sum((F.col("c_acctbal") > low).cast("int")).alias("count")).withColumn("suppressed", F.lit(False))
    return audit.source_support(rows, {"cells": (cells(["c_nationkey", "c_mktsegment"], 9000), ["c_nationkey", "c_mktsegment"]), "nations": (cells(["c_nationkey"], 9950), ["c_nationkey"])})


@query("""
SELECT user_id, round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END), 4) AS reserved, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 4) AS settled,
  sum(CASE WHEN event_type IN ('click', 'purchase') THEN value ELSE 0 END) <= 500 AS within_cap, sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) <= sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS settled_within_reserved FROM events GROUP BY 1""")
def reservation_invariants(t):
    rows = t.events.select("user_id", F.when(F.col("event_type") == "click", "reserve").when(F.col("event_type") == "purchase", "settle").alias("kind"), "value")
    out = audit.reservation_invariants(rows, "user_id", "kind", "value", 500)
    return out.withColumn("reserved", F.round("reserved", 4)).withColumn("settled", F.round("settled", 4))


@query(f"""
SELECT 'identity' AS section, 'missing' AS name, 0.0::DOUBLE AS value UNION ALL SELECT 'identity', 'added', 0 UNION ALL SELECT 'identity', 'repeated', 0
UNION ALL SELECT 'prose', 'changed', count(*) FILTER (doc_id % 50 = 0)::DOUBLE FROM documents UNION ALL SELECT 'prose', 'unvetted', count(*) FILTER (doc_id % 50 = 0 AND doc_id % 100 <> 0)::DOUBLE FROM documents
UNION ALL SELECT 'frozen', 'lang', count(*) FILTER (doc_id % 30 = 0 AND lang <> 'en')::DOUBLE FROM documents UNION ALL SELECT 'frozen', 'source', 0
UNION ALL SELECT * FROM (SELECT 'failure', 'too_long', count(*)::DOUBLE AS n FROM documents WHERE n_chars > 20000) WHERE n > 0
UNION ALL SELECT 'drift', 'lang', round(sum(abs(n - m)) / 2 / (SELECT count(*) FROM documents), 9) FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1) JOIN (SELECT CASE WHEN doc_id % 30 = 0 THEN 'en' ELSE lang END AS lang, count(*) AS m FROM documents GROUP BY 1) USING (lang)
UNION ALL SELECT 'collision', 'shared_values', count(*)::DOUBLE FROM (SELECT 1 FROM (SELECT CASE WHEN doc_id % 50 = 0 THEN upper(text) ELSE text END AS x FROM documents) GROUP BY x HAVING count(*) > 1)
UNION ALL SELECT 'collision', 'rows_sharing', coalesce(sum(n), 0)::DOUBLE FROM (SELECT count(*) AS n FROM (SELECT CASE WHEN doc_id % 50 = 0 THEN upper(text) ELSE text END AS x FROM documents) GROUP BY x HAVING count(*) > 1)
UNION ALL SELECT 'blank', 'source', 0""")
def release_report(t):
    base = t.documents
    changed = base.withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.upper("text")).otherwise(F.col("text"))).withColumn("lang", F.when(F.col("doc_id") % 30 == 0, F.lit("en")).otherwise(F.col("lang")))
    vetted = base.filter("doc_id % 100 = 0").select(F.sha2(F.col("doc_id").cast("string"), 256).alias("id_sha256"))
    out = audit.release_report(base, changed, "doc_id", "text", ["lang"], ["lang", "source"], {"too_long": F.col("n_chars") > 20000}, vetted, ["source"])
    return out.withColumn("value", F.round("value", 9))
