"""Queries over weighted tables and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.operators import compare, weights
from strataforge.plans.registry import query


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, bool_or(l_discount = 0) AS suppressed
FROM lineitem GROUP BY ALL""")
def weighted_cube(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", F.col("l_quantity").alias("quantity"), (F.col("l_discount") == 0).alias("suppressed"))
    return weights.cube(rows, ["l_returnflag", "l_linestatus"], "quantity").withColumn("quantity", F.round("quantity", 2))


@query("""
SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand
HAVING count(*) >= (SELECT greatest(50, ceil(5 * count(*) / 200.0)) FROM part)""")
def having_threshold(t):
    ones = t.part.select("p_brand", F.lit(1).alias("n"))
    return weights.thresholded(ones, ["p_brand"], "n", weights.release_threshold(ones, "n", 50, 5, 200))


@query("""
WITH p AS (SELECT o_orderstatus, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' WHEN o_orderpriority = '5-LOW' THEN 'low' END AS pool, o_totalprice FROM orders)
SELECT o_orderstatus, pool, round(sum(o_totalprice), 2) AS value FROM p WHERE pool IS NOT NULL GROUP BY ALL""")
def pooled_cube(t):
    pool = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "high").when(F.col("o_orderpriority") == "3-MEDIUM", "medium").when(F.col("o_orderpriority") == "5-LOW", "low")
    return weights.pooled(t.orders.withColumn("value", F.col("o_totalprice")), ["o_orderstatus"], pool, "pool", "value").withColumn("value", F.round("value", 2))


@query("""
SELECT count(*)::DOUBLE AS total, count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))::DOUBLE AS kept,
  round(count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')) / count(*), 9) AS coverage FROM orders""")
def pooled_cube_coverage(t):
    ones = t.orders.select("o_orderpriority", F.lit(1).alias("count"))
    after = weights.pooled(ones, [], F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"), F.col("o_orderpriority")), "pool")
    return weights.pooling_coverage(ones, after, floor=None).withColumn("coverage", F.round("coverage", 9))


@query("""
WITH s AS (SELECT user_id % 10 AS bucket, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) / count(*) AS share FROM events GROUP BY 1),
c AS (SELECT user_id % 10 AS bucket, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT bucket, event_type, round(CASE WHEN event_type = 'view' THEN n * share ELSE n END, 6) AS n FROM c JOIN s USING (bucket)""")
def share_adjust(t):
    rows = t.events.select((F.col("user_id") % 10).alias("bucket"), "event_type", F.lit(1).alias("one"))
    cells = rows.groupBy("bucket", "event_type").agg(F.count(F.lit(1)).alias("n"))
    out = weights.share_adjusted(cells, ["bucket"], F.col("event_type") == "view", rows, F.col("event_type") == "click", "one", "n")
    return out.withColumn("n", F.round("n", 6))


@query("""
SELECT n_nationkey, coalesce(n, 0) AS n, coalesce(n, 0) >= 10 AS eligible
FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1) ON c_nationkey = n_nationkey""")
def spine_marginal(t):
    facts = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_nationkey").alias("n_nationkey"), F.lit(1).alias("n"))
    return weights.spine_marginal(t.nation.select("n_nationkey"), facts, "n_nationkey", 10, "n")


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY ALL),
s AS (SELECT DISTINCT n_nationkey AS c_nationkey, c_mktsegment FROM nation, customer)
SELECT * FROM c UNION ALL SELECT c_nationkey, c_mktsegment, 0 FROM s ANTI JOIN c USING (c_nationkey, c_mktsegment)""")
def zero_fill_union(t):
    cells = t.customer.filter("c_acctbal > 5000").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    segments = t.customer.agg(F.collect_set("c_mktsegment").alias("s"))  # five market segments
    spine = t.nation.select(F.col("n_nationkey").alias("c_nationkey")).crossJoin(F.broadcast(segments)).select("c_nationkey", F.explode("s").alias("c_mktsegment"))  # one row
    return weights.zero_filled(cells, spine, ["c_nationkey", "c_mktsegment"], {"n": F.lit(0).cast("long")})


@query("SELECT lang, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def normalised_distribution(t):
    return weights.normalised(t.documents, ["lang"]).withColumn("share", F.round("share", 9))


_TV = """
WITH a AS (SELECT l_returnflag AS k, count(*)::DOUBLE AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
b AS (SELECT l_returnflag AS k, count(*)::DOUBLE AS m FROM lineitem GROUP BY 1),
j AS (SELECT k, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM a FULL JOIN b USING (k)),
c AS (SELECT k, n, n / sum(n) OVER () AS q, m / sum(m) OVER () AS p, sum(n) OVER () AS total FROM j)"""


@query(_TV + " SELECT round(sum(abs(q - p)) / 2, 12) AS total_variation FROM c")
def total_variation(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus")
    return compare.total_variation(rows.filter("l_linestatus = 'F'"), rows, ["l_returnflag"]).withColumn("total_variation", F.round("total_variation", 12))


@query(_TV + """
SELECT k AS l_returnflag, n, round(q, 9) AS q, round(p, 9) AS p, round(abs(q - p), 9) AS gap, round(greatest(0.0001, 3 * sqrt(p * (1 - p) / total)), 9) AS tolerance,
  round(p * total, 6) AS expected, p * total >= 5 AND abs(q - p) > greatest(0.0001, 3 * sqrt(p * (1 - p) / total)) AS violated FROM c""")
def cell_tolerance(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus")
    cells = compare.cells(rows.filter("l_linestatus = 'F'"), rows, ["l_returnflag"], absolute=0.0001)
    return cells.select("l_returnflag", "n", *(F.round(c, 9).alias(c) for c in ("q", "p", "gap", "tolerance")), F.round("expected", 6).alias("expected"), "violated")


@query("""
SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer
WHERE (c_nationkey, c_mktsegment) NOT IN (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9000) GROUP BY ALL""")
def unexpected_categories(t):
    rows = t.customer.select("c_nationkey", "c_mktsegment", "c_acctbal")
    return compare.unexpected(rows, rows.filter("c_acctbal > 9000").select("c_nationkey", "c_mktsegment"), ["c_nationkey", "c_mktsegment"]).groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


_DRIFT = """(WITH a AS (SELECT {f} AS k, count(*)::DOUBLE AS n FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-17' GROUP BY 1), b AS (SELECT {f} AS k, count(*)::DOUBLE AS m FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-17' GROUP BY 1),
j AS (SELECT coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM a FULL JOIN b USING (k)), c AS (SELECT n / sum(n) OVER () AS q, m / sum(m) OVER () AS p FROM j) SELECT '{f}' AS field, round(sum(abs(q - p)) / 2, 12) AS total_variation FROM c)"""


@query(_DRIFT.format(f="o_orderstatus") + " UNION ALL " + _DRIFT.format(f="o_orderpriority"))
def marginal_drift(t):
    rows, cut = t.orders.select("o_orderstatus", "o_orderpriority", "o_orderdate"), F.lit("1995-06-17").cast("timestamp")
    return compare.marginal_drift(rows.filter(F.col("o_orderdate") < cut), rows.filter(F.col("o_orderdate") >= cut), ["o_orderstatus", "o_orderpriority"]).withColumn("total_variation", F.round("total_variation", 12))


@query("""
WITH n AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL), p AS (SELECT p_brand, p_type, n / sum(n) OVER (PARTITION BY p_brand) AS p FROM n),
w AS (SELECT p_brand, count(*) / sum(count(*)) OVER () AS w FROM part WHERE p_size <= 10 GROUP BY 1)
SELECT p_type, round(sum(w * p), 9) AS share FROM w JOIN p USING (p_brand) GROUP BY 1""")
def conditioned_mixture(t):
    joint = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    strata = t.part.filter("p_size <= 10").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return weights.conditioned_mixture(joint, "p_brand", "p_type", strata).withColumn("share", F.round("share", 9))


@query("""
WITH a AS (SELECT user_id, count(*) / sum(count(*)) OVER () AS share FROM events GROUP BY 1), b AS (SELECT user_id, count(*) / sum(count(*)) OVER () AS share FROM events WHERE event_type = 'click' GROUP BY 1),
k AS (SELECT a.user_id, a.share AS target, coalesce(b.share, 0) AS actual FROM a LEFT JOIN b USING (user_id) WHERE a.share * 900 >= 1)
SELECT user_id, round(target / sum(target) OVER (), 9) AS target, round(actual / sum(actual) OVER (), 9) AS actual FROM k""")
def resolution_filter(t):
    rows = t.events.select("user_id", "event_type")
    out = weights.resolution_filtered(weights.normalised(rows, ["user_id"]), weights.normalised(rows.filter("event_type = 'click'"), ["user_id"]), "user_id", 900)
    return out.select("user_id", F.round("target", 9).alias("target"), F.round("actual", 9).alias("actual"))


@query("""
WITH n AS (SELECT l_suppkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS r FROM lineitem GROUP BY 1)
SELECT CASE WHEN r <= 25 THEN l_suppkey::VARCHAR ELSE 'Other' END AS l_suppkey, sum(n)::BIGINT AS n FROM n GROUP BY 1""")
def topk_other(t):
    return weights.top_and_other(t.lineitem.select("l_suppkey"), "l_suppkey", 25)


@query("""
WITH e AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT least(floor((c_acctbal - lo) / ((hi - lo) / 12.0::DOUBLE)), 11)::INTEGER AS bin, count(*) AS n FROM customer, e GROUP BY 1""")
def histogram12(t):
    return weights.histogram(t.customer.select("c_acctbal"), "c_acctbal", 12)


@query("""
SELECT c_mktsegment, round(min(c_acctbal), 4) AS low, round(quantile_cont(c_acctbal, 0.25), 4) AS q1, round(quantile_cont(c_acctbal, 0.5), 4) AS q2, round(quantile_cont(c_acctbal, 0.75), 4) AS q3, round(max(c_acctbal), 4) AS high
FROM customer GROUP BY 1""")
def boxplot_series(t):
    out = weights.quartiles(t.customer, "c_acctbal", ["c_mktsegment"])
    return out.select("c_mktsegment", *(F.round(c, 4).alias(c) for c in ("low", "q1", "q2", "q3", "high")))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM lineitem" for a, b in _PAIRS))
def pairwise_corr(t):
    return compare.max_correlation(t.lineitem.select(*_NUM), _NUM).withColumn("correlation", F.round("correlation", 6))


@query("SELECT count(*) FILTER (l_discount IS NULL OR l_discount NOT BETWEEN 0.02 AND 0.08) + count(*) FILTER (l_tax IS NULL OR l_tax NOT BETWEEN 0.02 AND 0.08) AS out_of_bounds FROM lineitem")
def bounds_errors(t):
    return compare.out_of_bounds(t.lineitem.select("l_discount", "l_tax"), ["l_discount", "l_tax"], 0.02, 0.08)


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS labels FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def mapping_consistency(t):
    return weights.inconsistent_mappings(t.orders, "o_custkey", "o_orderpriority")


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    return weights.duplicate_keys(t.lineitem, ["l_orderkey", "l_partkey"])


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM (SELECT quality, toxic, lang FROM documents LEFT JOIN labels USING (doc_id))" for c in ("quality", "toxic", "lang")))
def null_profile(t):
    return weights.null_profile(t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left"), ["quality", "toxic", "lang"])


@query("SELECT 'text' AS column_name, count(*) FILTER (text IS NULL OR regexp_matches(text, '^\\s*$')) AS blanks FROM conversations UNION ALL SELECT 'role', count(*) FILTER (role IS NULL OR regexp_matches(role, '^\\s*$')) FROM conversations")
def blank_profile(t):
    return weights.blank_profile(t.conversations, ["text", "role"])


@query("SELECT count(*) AS shared_values, coalesce(sum(n), 0)::BIGINT AS rows_sharing FROM (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1)")
def collisions(t):
    return weights.collisions(t.documents.select("text"), "text")


@query("SELECT l_returnflag, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS members FROM lineitem GROUP BY 1")
def coverage_sets(t):
    return weights.coverage_sets(t.lineitem, "l_returnflag", "l_linestatus").withColumn("members", F.array_join("members", ","))


@query("SELECT count(*) AS rows, round(avg(c_acctbal), 6) AS mean_c_acctbal, count(DISTINCT c_mktsegment) AS distinct_c_mktsegment, count(DISTINCT c_nationkey) AS distinct_c_nationkey FROM customer")
def overview_cards(t):
    return weights.cards(t.customer, ["c_acctbal"], ["c_mktsegment", "c_nationkey"]).withColumn("mean_c_acctbal", F.round("mean_c_acctbal", 6))


@query("SELECT p_size, count(*) AS n, row_number() OVER (ORDER BY p_size) AS place FROM part GROUP BY 1")
def category_order(t):
    return weights.ordered_counts(t.part, "p_size", "number")


@query("SELECT o_orderpriority, count(*) AS n, row_number() OVER (ORDER BY regexp_extract(o_orderpriority, '^(\\d+)', 1)::INTEGER, o_orderpriority) AS place FROM orders GROUP BY 1")
def band_order(t):
    return weights.ordered_counts(t.orders, "o_orderpriority", "band")


@query("SELECT event_type, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY 1")
def value_counts(t):
    return weights.ordered_counts(t.events, "event_type", "count")


@query("""
SELECT CASE WHEN a.role IS NULL OR b.role IS NULL THEN 'none' ELSE least(a.role, b.role) || '+' || greatest(a.role, b.role) END AS pair, count(*) AS n
FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 GROUP BY 1""")
def relationship_pairs(t):
    turns = t.conversations
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next_role"))
    return weights.pair_counts(turns.join(after, ["conv_id", "turn"], "left"), F.col("role"), F.col("next_role"))


@query(" UNION ALL ".join(f"SELECT '{k}' AS table_name, count(*) AS rows, round(sum(v), 2) AS total, count(*) FILTER (s) AS suppressed_cells, count(*) > 0 AND sum(v) > 0 AS passed FROM ({q})" for k, q in (("orders", "SELECT o_totalprice AS v, o_orderstatus = 'P' AS s FROM orders"), ("parts", "SELECT p_retailprice AS v, p_size > 45 AS s FROM part"))))
def table_metrics(t):
    a = t.orders.select(F.col("o_totalprice").alias("count"), (F.col("o_orderstatus") == "P").alias("suppressed"))
    b = t.part.select(F.col("p_retailprice").alias("count"), (F.col("p_size") > 45).alias("suppressed"))
    return weights.table_metrics({"orders": a, "parts": b}).withColumn("total", F.round("total", 2))


@query("""
SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS customers, coalesce(b.n, 0) AS suppliers
FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9500 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""")
def stratum_report(t):
    a = t.customer.filter("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return weights.stratum_report({"customers": a, "suppliers": b}, "k")


@query("""
SELECT event_type, count(*) AS records, sum(user_id)::BIGINT AS input_tokens, sum(event_id)::BIGINT AS output_tokens,
  round((sum(user_id) * 2.5 + sum(event_id) * 10.25) / 1000000.0, 3)::DOUBLE AS cost FROM events GROUP BY 1""")
def ledger_summary(t):
    out = weights.ledger_summary(t.events, "event_type", {"input_tokens": "user_id", "output_tokens": "event_id"}, {"input_tokens": "2.5", "output_tokens": "10.25"})
    return out.withColumn("cost", F.round("cost", 3).cast("double"))


@query("""
WITH m AS (
  SELECT 'l_returnflag: total variation' AS name, tv AS value, 0.02::DOUBLE AS threshold FROM (""" + _TV + """ SELECT sum(abs(q - p)) / 2 AS tv FROM c)
  UNION ALL SELECT 'l_returnflag: violated cells', v, 0.0 FROM (""" + _TV + """ SELECT coalesce(sum((p * total >= 5 AND abs(q - p) > greatest(0.005, 3 * sqrt(p * (1 - p) / total)))::INT), 0)::DOUBLE AS v FROM c)
  UNION ALL SELECT 'l_returnflag: unexpected rows', 0.0, 0.0)
SELECT name, round(value, 12) AS value, threshold, value <= threshold AS passed FROM m""")
def metric_report(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus")
    return compare.distribution_metrics(rows.filter("l_linestatus = 'F'"), rows, [["l_returnflag"]], 0.02).withColumn("value", F.round("value", 12))
