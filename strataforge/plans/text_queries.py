"""Queries over bands, remaps, text, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions import buckets, text
from strataforge.operators import audit, diff, joins
from strataforge.plans.registry import query
from strataforge.sources.listings import running_parent


@query("SELECT p_partkey, CASE WHEN p_size <= 29 THEN '18-29' WHEN p_size <= 49 THEN '30-49' WHEN p_size <= 66 THEN '50-66' ELSE '67+' END AS four, CASE WHEN p_size <= 19 THEN '16-19' WHEN p_size <= 24 THEN '20-24' WHEN p_size <= 29 THEN '25-29' WHEN p_size <= 34 THEN '30-34' WHEN p_size <= 39 THEN '35-39' WHEN p_size <= 44 THEN '40-44' WHEN p_size <= 49 THEN '45-49' WHEN p_size <= 54 THEN '50-54' ELSE '55-59' END AS twelve FROM part")
def age_bands(t):
    return t.part.select("p_partkey", buckets.age_band(F.col("p_size")).alias("four"), buckets.source_band(F.col("p_size")).alias("twelve"))


@query("SELECT p_partkey, CASE WHEN p_size >= 41 THEN '41-' ELSE p_size::VARCHAR END AS key, least(p_size, 41) AS back, CASE WHEN p_size >= 41 THEN '67+' WHEN p_size <= 29 THEN '18-29' ELSE '30-49' END AS band, least(p_size, 41) AS floor FROM part")
def topcode(t):
    key = buckets.top_coded(F.col("p_size"), 41)
    return t.part.select("p_partkey", key.alias("key")).select("*", buckets.top_code_value(F.col("key"), 41).alias("back"), buckets.age_key_band(F.col("key")).alias("band"), buckets.band_floor(F.col("key")).alias("floor"))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' ELSE 'low' END AS pooled, CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' END AS lenient FROM orders")
def strict_remap(t):
    full = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "low", "5-LOW": "low"}
    return t.orders.select("o_orderkey", buckets.strict_remap(F.col("o_orderpriority"), full, "priority").alias("pooled"), buckets.lenient_remap(F.col("o_orderpriority"), {"1-URGENT": "now"}).alias("lenient"))


@query("SELECT code, label FROM (VALUES ('1-URGENT', 'high'), ('2-HIGH', 'high'), ('3-MEDIUM', 'rest'), ('5-LOW', 'rest')) v(code, label) WHERE code IN (SELECT o_orderpriority FROM orders)")
def mapping_inversion(t):
    table = t.orders.select(F.when(F.col("o_orderpriority") < "3", "high").otherwise("rest").alias("label"), "o_orderpriority").filter("o_orderpriority <> '4-NOT SPECIFIED'").groupBy("label").agg(F.collect_set("o_orderpriority").alias("codes"))
    return buckets.remap_table(table, "label", "codes")


@query("SELECT c_custkey, CASE WHEN v < 0 THEN 'debt' WHEN v < 2500 THEN 'low' WHEN v < 7500 THEN 'mid' ELSE 'high' END AS bin FROM (SELECT c_custkey, least(greatest(c_acctbal, -500), 9000) AS v FROM customer)")
def bin_right_closed(t):
    return t.customer.select("c_custkey", buckets.right_closed_bin(F.col("c_acctbal"), [0, 2500, 7500], ["debt", "low", "mid", "high"], -500, 9000).alias("bin"))


@query("SELECT s_suppkey, CASE WHEN k % 100 BETWEEN 0 AND 29 THEN 'basic' WHEN k % 100 BETWEEN 30 AND 59 THEN 'middle' ELSE 'upper' END AS pool FROM (SELECT s_suppkey, s_suppkey AS k FROM supplier)")
def code_pool(t):
    code = F.concat(F.lit("H"), (F.col("s_suppkey") % 100).cast("string"))
    return t.supplier.select("s_suppkey", buckets.code_pool(code, "H", [(0, 29, "basic"), (30, 59, "middle"), (60, 99, "upper")]).alias("pool"))


@query("SELECT count(*) AS rows, count(*) FILTER (NOT ((o_orderstatus = 'P') = (o_orderpriority = '1-URGENT'))) AS invalid FROM orders")
def paired_fields(t):
    shown = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey"))
    return audit.invalid_rows(t.orders, buckets.paired(F.col("o_orderstatus") == "P", shown))


@query("SELECT l_orderkey, l_linenumber, floor(l_extendedprice / 1000 + 0.5)::BIGINT AS thousands, (l_quantity = floor(l_quantity)) AS whole FROM lineitem")
def rounding(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", buckets.half_up(F.col("l_extendedprice") / 1000).alias("thousands"), buckets.integral(F.col("l_quantity").cast("string")).alias("whole"))


@query("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'calm,quiet' WHEN p_size < 40 THEN 'calm,quiet,bold,loud' ELSE 'bold,loud' END AS phrases FROM part""")
def trait_phrases(t):
    label = F.when(F.col("p_size") < 10, "low").when(F.col("p_size") < 40, "average").otherwise("high")
    out = buckets.phrases({"drive": label}, {"drive": {"low": ["calm", "quiet"], "high": ["bold", "loud"]}})
    return t.part.select("p_partkey", F.array_join(out, ",").alias("phrases"))


@query("SELECT p_partkey, CASE WHEN p_size / 100.0 < 0.05 THEN 'small' WHEN p_size / 100.0 < 0.15 THEN 'medium' ELSE 'large' END AS bucket FROM part")
def fraction_bucket(t):
    return t.part.select("p_partkey", buckets.fraction_bucket(F.col("p_size") / 100.0).alias("bucket"))


@query("""
WITH o AS (SELECT event_id, user_id, event_type, ts FROM events) SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS parent FROM o""")
def running_parent_rows(t):
    return running_parent(t.events.select("event_id", "user_id", "event_type"), "event_id", F.col("event_type") == "purchase", F.col("event_id"), "parent", ["user_id"]).select("event_id", "parent")


_CHECKS = {"short": "length(text) < 300", "long": "length(text) > 900", "exclaims": "contains(text, '!!')", "numbers": "regexp_matches(text, '[0-9]{3}')", "capital_start": "regexp_matches(text, '^[A-Z]')"}
_FLAGS = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in _CHECKS.items()) + "], lambda x: x IS NOT NULL)"


def _checks():
    x = F.col("text")
    return {"short": F.length(x) < 300, "long": F.length(x) > 900, "exclaims": x.contains("!!"), "numbers": x.rlike("[0-9]{3}"), "capital_start": x.rlike("^[A-Z]")}


@query(f"SELECT doc_id, array_to_string({_FLAGS}, ',') AS failures, CASE WHEN lang = 'en' THEN '' ELSE 'foreign' END AS advice FROM documents")
def text_checks(t):
    out = audit.field_findings(t.documents, "doc_id", _checks(), {"foreign": F.col("lang") != "en"})
    return out.select("doc_id", F.array_join("failures", ",").alias("failures"), F.array_join("advice", ",").alias("advice"))


@query(f"SELECT code, count(*) AS n FROM (SELECT unnest({_FLAGS}) AS code FROM documents) GROUP BY 1")
def finding_histogram(t):
    return diff.reason_histogram(t.documents.select(text.flags(_checks()).alias("reasons")))


@query("""
SELECT conv_id, turn, len(list_filter(regexp_extract_all(text, '([0-9]+) of', 1), lambda x: x::BIGINT <> turn)) > 0 AS other FROM conversations""")
def age_mentions(t):
    return t.conversations.select("conv_id", "turn", F.coalesce(text.other_number_before(F.col("text"), "of", F.col("turn")), F.lit(False)).alias("other"))


@query("SELECT doc_id, regexp_matches(lower(text), '(^|[^a-z0-9_])(and|with)([^a-z0-9_]|$)') AS mentions FROM documents WHERE lang = 'en'")
def restricted_terms(t):
    return t.documents.select("doc_id", text.mentions_any(F.col("text"), ["and", "with"]).alias("mentions"))


@query("""
SELECT p_partkey, substr(p_name, 1, instr(p_name || ' ', ' ') - 1) AS first, trim(p_name) AS bare, regexp_replace(p_partkey % 100 || ' - ' || p_name, '^\\s*[0-9]{1,3}(\\s*[-:]\\s*|\\s+)', '') AS named,
  regexp_replace(regexp_replace(lower('  ' || p_name || ' ..'), '[^\\p{L}\\p{N}_]+$', ''), '\\s+', ' ', 'g') AS folded FROM part""")
def string_cleaning(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", text.first_word(n).alias("first"), text.stripped(n).alias("bare"), text.without_code(F.concat_ws(" - ", (F.col("p_partkey") % 100).cast("string"), n)).alias("named"), text.lexical_identity(F.concat(F.lit("  "), n, F.lit(" .."))).alias("folded"))


@query("""
SELECT doc_id, CASE WHEN c = 1 THEN replace(text, ' and the ', ' & the ') ELSE text END AS text, CASE c WHEN 0 THEN 'clause absent' WHEN 1 THEN NULL ELSE 'clause repeated' END AS reason
FROM (SELECT doc_id, text, (length(text) - length(replace(text, ' and the ', ''))) // 9 AS c FROM documents WHERE n_chars < 2000)""")
def clause_repair(t):
    new, reason = text.replaced_once(F.col("text"), " and the ", " & the ")
    return t.documents.select("doc_id", new.alias("text"), reason.alias("reason"))


@query("SELECT doc_id, (length(text) - length(replace(text, lang, ''))) // length(lang) AS n FROM documents")
def occurrences(t):
    return t.documents.select("doc_id", text.occurrences(F.col("text"), F.col("lang")).alias("n"))


_ITEMS = "string_split(regexp_replace(substr(text, 1, 60), '\\s+', ' ', 'g'), ' ')"


def _items():
    return F.split(F.regexp_replace("text", r"\s+", " "), " ")


@query(f"""
WITH i AS (SELECT conv_id, turn, list_filter({_ITEMS}, lambda x: x <> '') AS xs FROM conversations), u AS (SELECT conv_id, turn, unnest(xs) AS x, unnest(range(len(xs))) AS p FROM i),
f AS (SELECT conv_id, turn, arg_min(x, p) AS x, min(p) AS p FROM u GROUP BY conv_id, turn, lower(x)), j AS (SELECT conv_id, turn, string_agg(x, ' ' ORDER BY p) AS items FROM f GROUP BY ALL)
SELECT conv_id, turn, coalesce(items, '') AS items FROM conversations LEFT JOIN j USING (conv_id, turn)""")
def array_dedupe_fold(t):
    return t.conversations.select("conv_id", "turn", F.coalesce(F.array_join(text.deduped(_items()), " "), F.lit("")).alias("items"))


@query(f"""
SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN len(xs) < 3 THEN 'too_few' END, CASE WHEN len(xs) > 6 THEN 'too_many' END, CASE WHEN len(list_filter(xs, lambda x: regexp_matches(x, '^\\s*$'))) > 0 THEN 'blank_item' END,
  CASE WHEN len(list_distinct(list_transform(xs, lambda x: lower(x)))) < len(xs) THEN 'repeated_item' END], lambda x: x IS NOT NULL), ',') AS findings FROM (SELECT conv_id, turn, {_ITEMS} AS xs FROM conversations)""")
def array_checks(t):
    return t.conversations.select("conv_id", "turn", F.array_join(text.list_findings(_items()), ",").alias("findings"))


@query("""
SELECT p_partkey, CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 'exact' ELSE 'not_allowed' END AS verdict, CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN p_brand END AS repaired,
  CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 'case_only' ELSE 'not_allowed' END AS upper_verdict FROM part""")
def title_match(t):
    allowed = F.array(F.lit("Brand#11"), F.lit("Brand#12"))
    verdict, repaired = text.title_match(F.col("p_brand"), allowed)
    upper, _ = text.title_match(F.upper("p_brand"), allowed)
    return t.part.select("p_partkey", verdict.alias("verdict"), repaired.alias("repaired"), upper.alias("upper_verdict"))


_BANK = ["chess", "music", "rowing", "baking", "tennis"]


@query(f"""
WITH b AS (SELECT s_suppkey, w, row_number() OVER (PARTITION BY s_suppkey ORDER BY sha256(s_suppkey || '|' || w), w) AS i FROM supplier, (SELECT unnest({_BANK!r}) AS w) WHERE w <> 'music')
SELECT s_suppkey, 'music,' || string_agg(w, ',' ORDER BY i) AS items FROM b WHERE i <= 3 GROUP BY 1""")
def array_completion(t):
    out = text.completed(F.array(F.lit("music")), _BANK, F.col("s_suppkey").cast("string"), F.lit(4))
    return t.supplier.select("s_suppkey", F.array_join(out, ",").alias("items"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k, '{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}' AS canonical FROM events")
def json_props(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), text.canonical_json(["user_id", "event_type"]).alias("canonical"))


@query("SELECT conv_id, turn, replace(replace(replace(substr(text, 1, 30), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS safe, regexp_replace(substr(text, 1, 50), '(.{20})', '\\1<br>', 'g') AS wrapped FROM (SELECT conv_id, turn, regexp_replace(text, '[\\s\"'']', '_', 'g') || repeat('x', 45) AS text FROM conversations)")
def wrap_and_escape(t):
    x = F.concat(F.regexp_replace("text", r"[\s\"']", "_"), F.repeat(F.lit("x"), 45))
    return t.conversations.select("conv_id", "turn", text.html_escaped(x).alias("safe"), text.wrapped(x, 20).alias("wrapped"))


@query("SELECT doc_id, replace('id ' || doc_id || ' of ' || source, doc_id::VARCHAR, '[id]') AS shown FROM documents")
def redaction(t):
    k = F.col("doc_id").cast("string")
    return t.documents.select("doc_id", text.redacted(F.concat(F.lit("id "), k, F.lit(" of "), F.col("source")), k).alias("shown"))


@query("SELECT doc_id, contains(text, quote) AND contains(lower(quote), lower(lang)) AND trim(quote) <> '' AS grounded FROM (SELECT doc_id, lang, text, substr(text, 3, 40) AS quote FROM documents)")
def quote_grounding(t):
    return t.documents.withColumn("quote", F.substring("text", 3, 40)).select("doc_id", text.grounded(F.col("quote"), F.col("text"), F.col("lang")).alias("grounded"))


@query("""
WITH h AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS i, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS h FROM nation),
c AS (SELECT i // 10 AS c, sha256(string_agg(h, '' ORDER BY i)) AS h FROM h GROUP BY 1) SELECT sha256(string_agg(h, '' ORDER BY c)) AS content_hash FROM c""")
def content_hash(t):
    return diff.content_hash(t.nation, ["n_nationkey"], chunk=10)


@query("""
WITH d AS (SELECT doc_id, text, substr(text, 1, 39) AS b, substr(text, 40, 12) AS o, substr(text, 52) AS a FROM documents),
why AS (SELECT *, CASE WHEN text IS NULL THEN 'no text' WHEN o IN ('', 'EDIT') THEN 'empty patch' WHEN strpos(substr(text, strpos(text, o) + 1), o) > 0 THEN 'excerpt repeated'
  WHEN regexp_matches(right(b, 1) || left(o, 1), '^[\\p{L}\\p{N}_]{2}$') OR regexp_matches(right(o, 1) || left(a, 1), '^[\\p{L}\\p{N}_]{2}$') THEN 'inside a word'
  WHEN regexp_matches(string_split(b, chr(10) || chr(10))[-1], '^[\\s\\p{Z}]*$') AND regexp_matches(string_split(a, chr(10) || chr(10))[1], '^[\\s\\p{Z}]*$') THEN 'whole paragraph'
  WHEN greatest(length(o), 4) > 0.2 * length(text) THEN 'too much changed' WHEN length(b || 'EDIT' || a) NOT BETWEEN 300 AND 900 THEN 'length out of range' END AS reason FROM d)
SELECT doc_id, CASE WHEN reason IS NULL THEN b || 'EDIT' || a END AS patched, reason FROM why""")
def bounded_patches(t):
    patches = F.array(F.struct(F.substring("text", 40, 12).alias("old"), F.lit("EDIT").alias("new")))
    rows = t.documents.select("doc_id", "text", patches.alias("patches"))
    return text.apply_patches(rows, "text", "patches").select("doc_id", "patched", "reason")


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split(substr(regexp_replace(text, '[^a-zA-Z]+', ' ', 'g'), 1, 40), ' '), lambda x: x <> ''), lambda x: lower(x)))), ' ') AS key FROM documents WHERE lang = 'en'")
def normalised_sets(t):
    words = F.filter(F.split(F.regexp_replace("text", r"[^\p{L}\p{M}]+", " "), " "), lambda x: x != "")
    return t.documents.select("doc_id", F.when(F.col("text").isNotNull(), F.coalesce(F.array_join(text.normalised_set(words), " "), F.lit(""))).alias("key"))


@query("SELECT doc_id, safe FROM (SELECT doc_id, bool_and(x) AS safe FROM (SELECT o.doc_id, lower(o.lang) = lower(n.lang) AND o.source = n.source AS x, o.lang IS DISTINCT FROM n.lang OR o.source IS DISTINCT FROM n.source AS y FROM documents o JOIN (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN upper(lang) ELSE lang END AS lang, CASE WHEN doc_id % 9 = 0 THEN 'moved' ELSE source END AS source FROM documents) n USING (doc_id)) WHERE y GROUP BY 1)")
def change_triage(t):
    old = t.documents.select("doc_id", "lang", "source")
    new = old.select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.upper("lang")).otherwise(F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 9 == 0, F.lit("moved")).otherwise(F.col("source")).alias("source"))
    return diff.classified(old, new, "doc_id", ["lang"], [], ["source"]).select("doc_id", "safe")


@query("SELECT count(*) AS rows FROM customer WHERE (c_nationkey, c_mktsegment) NOT IN (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9500)")
def pair_audit(t):
    rows = t.customer.select("c_nationkey", "c_mktsegment", "c_acctbal")
    return audit.pair_audit(rows, rows.filter("c_acctbal > 9500"), ["c_nationkey", "c_mktsegment"])


@query("SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS ids, count(*) = 15000 AND count(DISTINCT o_orderkey) = 15000 AS passed FROM orders")
def structure_check(t):
    return audit.structure(t.orders, "o_orderkey", 15000)


@query("SELECT c_custkey, o_orderpriority FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def attach_one(t):
    last = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("o_orderpriority"))
    return joins.attach_one(t.customer.select("c_custkey"), last, "c_custkey")
