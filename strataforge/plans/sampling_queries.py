"""Queries over quotas, draws, ladders, frozen samples and repairs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strataforge.functions import hashing
from strataforge.operators import flow, ladder, quota, repair, weights
from strataforge.plans.registry import query

#: DuckDB: the hash draw of a payload as a 128-bit integer.
_U64 = "('0x' || substr(sha256({p}), 1, 16))::UBIGINT::HUGEINT"
_SPAN = "18446744073709551616::HUGEINT"


def _lr(src: str, key: str, slots: str, weight: str = "n", by: str = "") -> str:
    """Largest remainder in SQL over ``src`` (key, weight): key, weight, quota."""
    part = f"PARTITION BY {by}" if by else ""
    return f"""(SELECT *, (fl + CASE WHEN row_number() OVER ({part} ORDER BY rm DESC, {key}) <= slots - sum(fl) OVER ({part}) THEN 1 ELSE 0 END)::BIGINT AS quota
FROM (SELECT *, {weight} * slots // tot AS fl, {weight} * slots % tot AS rm FROM (SELECT *, ({slots})::HUGEINT AS slots, sum({weight}) OVER ({part})::HUGEINT AS tot FROM {src})))"""


_NATIONS = "(SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)"


def _nations(t):
    return t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT c_nationkey, n, quota FROM {_lr(_NATIONS, 'c_nationkey', '1000')}")
def lr_quota_int(t):
    return quota.largest_remainder(_nations(t), ["c_nationkey"], "n", 1000)


_BAL = "(SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)"


@query(f"SELECT c_nationkey, c_mktsegment, n, quota FROM {_lr(_BAL, 'c_mktsegment', '17', by='c_nationkey')}")
def lr_quota_grouped(t):
    cells = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return quota.largest_remainder(cells, ["c_mktsegment"], "n", F.lit(17), ["c_nationkey"])


@query(f"SELECT c_nationkey, unnest(range(quota))::INTEGER AS copy FROM {_lr(_NATIONS, 'c_nationkey', '200')}")
def quota_expand(t):
    return quota.expanded(quota.largest_remainder(_nations(t), ["c_nationkey"], "n", 200)).select("c_nationkey", "copy")


@query(f"""
SELECT c_nationkey, copy, row_number() OVER (ORDER BY substr(sha256('slots:' || c_nationkey || ':' || copy), 1, 16), c_nationkey, copy) - 1 AS slot
FROM (SELECT c_nationkey, unnest(range(quota))::INTEGER AS copy FROM {_lr(_NATIONS, 'c_nationkey', '200')})""")
def quota_shuffle(t):
    q = quota.largest_remainder(_nations(t), ["c_nationkey"], "n", 200)
    return quota.shuffled_slots(q, ["c_nationkey"], "slots").select("c_nationkey", "copy", "slot")


@query(f"""
WITH q AS (SELECT c_nationkey, unnest(range(quota))::INTEGER AS copy FROM {_lr(_NATIONS, 'c_nationkey', '500')}),
w AS (SELECT *, sum(n) OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS upto, sum(n) OVER (PARTITION BY c_nationkey) AS tot FROM {_BAL}),
d AS (SELECT q.*, tot, {_U64.format(p="'group:' || c_nationkey || ':' || copy")} * tot // {_SPAN} AS spot FROM q JOIN (SELECT DISTINCT c_nationkey, tot FROM w) USING (c_nationkey))
SELECT c_nationkey, copy, c_mktsegment FROM d JOIN w USING (c_nationkey) WHERE spot < upto AND spot >= upto - n""")
def quota_group_draw(t):
    cells = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return quota.group_quota_draw(_nations(t), "c_nationkey", "n", 500, cells, "c_mktsegment", "n", "group")


@query(f"""
WITH w AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT *, sum(n) OVER (ORDER BY o_orderpriority) AS upto, sum(n) OVER () AS tot FROM w),
d AS (SELECT c_custkey, {_U64.format(p="'draw:' || c_custkey")} * (SELECT max(tot) FROM c) // {_SPAN} AS spot FROM customer)
SELECT c_custkey, o_orderpriority FROM d, c WHERE spot < upto AND spot >= upto - n""")
def weighted_draw(t):
    table = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return quota.weighted_draw(t.customer.select("c_custkey"), table, [], "o_orderpriority", "n", hashing.payload("draw", F.col("c_custkey")), "o_orderpriority")


_OPS = "(SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)"


@query(f"""
WITH q AS (SELECT o_orderpriority, o_orderstatus, quota FROM {_lr(_OPS, 'o_orderpriority, o_orderstatus', '500')}), r AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS i FROM orders)
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM r JOIN q USING (o_orderpriority, o_orderstatus) WHERE i <= quota""")
def stratified_head(t):
    return quota.stratified_head(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_orderpriority", "o_orderstatus"], ["o_orderkey"], 500)


@query("""
SELECT o_orderkey, o_orderpriority, o_orderstatus, i::INTEGER AS depth FROM (SELECT o_orderkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS i FROM orders)
ORDER BY i, o_orderpriority, o_orderstatus LIMIT 100""")
def round_robin(t):
    return quota.round_robin(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_orderpriority", "o_orderstatus"], ["o_orderkey"], 100)


_LANGS = "(SELECT lang, count(*) AS n FROM documents GROUP BY 1)"


@query(f"""
WITH q AS (SELECT lang, quota FROM {_lr(_LANGS, 'lang', '150')}), r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('pick:' || doc_id), doc_id) AS i FROM documents) SELECT doc_id, lang FROM r JOIN q USING (lang) WHERE i <= quota""")
def hash_ranked_per_stratum(t):
    docs = t.documents.select("doc_id", "lang")
    quotas = quota.largest_remainder(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), ["lang"], "n", 150)
    return quota.hash_ranked(docs, ["lang"], "doc_id", quotas, "pick")


@query("SELECT doc_id FROM documents ORDER BY sha256('top:' || doc_id), doc_id LIMIT 40")
def hash_top(t):
    return quota.hash_top(t.documents.select("doc_id"), "doc_id", 40, "top")


@query(f"""
WITH m AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), e AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderstatus) AS slots FROM orders WHERE o_totalprice > 250000),
q AS (SELECT o_orderstatus, o_orderpriority, unnest(range(quota)) AS copy FROM {_lr("(SELECT m.*, (SELECT max(slots) FROM e WHERE e.o_orderstatus = m.o_orderstatus) AS s FROM m WHERE o_orderstatus IN (SELECT o_orderstatus FROM e))", "o_orderpriority", "s", by="o_orderstatus")}),
s AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY substr(sha256('attach:' || o_orderstatus || ':' || o_orderpriority || ':' || copy), 1, 16), o_orderpriority, copy) - 1 AS i FROM q)
SELECT o.o_orderkey, s.o_orderpriority AS drawn FROM orders o LEFT JOIN e USING (o_orderkey) LEFT JOIN s ON s.o_orderstatus = e.o_orderstatus AND s.i = e.i""")
def quota_attach(t):
    marginal = t.orders.groupBy("o_orderstatus", F.col("o_orderpriority").alias("drawn")).agg(F.count(F.lit(1)).alias("n"))
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return quota.attach_by_quota(rows, F.col("o_totalprice") > 250000, "o_orderstatus", marginal, "drawn", "n", "o_orderkey", "attach").select("o_orderkey", "drawn")


@query("SELECT n_nationkey AS k, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1 HAVING count(*) >= 55")
def audited_marginal(t):
    table = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n")).withColumn("eligible", F.col("n") >= 55)
    return quota.audited_marginal(table, "k", "n", None)


def _water(rounds: int, slots: int) -> str:
    sql, prior = "WITH r0 AS (SELECT c_nationkey AS k, count(*) AS w, (count(*) FILTER (c_acctbal > 0 AND c_nationkey % 3 > 0) + 5)::BIGINT AS room, 0::BIGINT AS quota FROM customer GROUP BY 1)", "r0"
    for i in range(1, rounds + 1):
        src = f"(SELECT k, w, room, quota AS had, CASE WHEN quota < room THEN w ELSE 0 END AS ww, greatest({slots} - (SELECT sum(quota) FROM {prior}), 0) AS s FROM {prior})"
        part = f"(SELECT *, ww * s // greatest(tot, 1) AS fl, CASE WHEN tot > 0 THEN ww * s % tot ELSE -1 END AS rm FROM (SELECT *, sum(ww) OVER ()::HUGEINT AS tot FROM {src}))"
        sql += f", r{i} AS (SELECT k, w, room, least(room, had + fl + CASE WHEN tot > 0 AND row_number() OVER (ORDER BY rm DESC, k) <= s - sum(fl) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota FROM {part})"
        prior = f"r{i}"
    return sql + f" SELECT k, room, quota FROM {prior}"


@query(_water(4, 900))
def waterfill_quota(t):
    rooms = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("w"), (F.count_if((F.col("c_acctbal") > 0) & (F.col("c_nationkey") % 3 > 0)) + 5).alias("room"))
    return quota.water_filled(rooms, "k", "w", "room", 900, 4).select("k", "room", "quota")


@query("""
WITH a AS (SELECT c_nationkey, c_mktsegment, round(avg(c_acctbal), 4) AS v FROM customer WHERE c_acctbal > 7000 GROUP BY ALL HAVING count(*) >= 3), b AS (SELECT c_nationkey, round(avg(c_acctbal), 4) AS v FROM customer WHERE c_acctbal > 9000 GROUP BY 1 HAVING count(*) >= 6), c AS (SELECT round(avg(c_acctbal), 4) AS v FROM customer)
SELECT x.c_custkey, coalesce(a.v, b.v, c.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'nation_segment' WHEN b.v IS NOT NULL THEN 'nation' ELSE 'all' END AS level
FROM customer x LEFT JOIN a USING (c_nationkey, c_mktsegment) LEFT JOIN b ON b.c_nationkey = x.c_nationkey, c""")
def ladder_lookup(t):
    rows = t.customer
    mean = F.round(F.avg("c_acctbal"), 4).alias("v")
    a = rows.filter("c_acctbal > 7000").groupBy("c_nationkey", "c_mktsegment").agg(mean, F.count(F.lit(1)).alias("k")).filter("k >= 3")
    b = rows.filter("c_acctbal > 9000").groupBy("c_nationkey").agg(mean, F.count(F.lit(1)).alias("k")).filter("k >= 6")
    c = rows.agg(mean)
    levels = [(ladder.Level("nation_segment", ("c_nationkey", "c_mktsegment")), a), (ladder.Level("nation", ("c_nationkey",)), b), (ladder.Level("all", ()), c)]
    return ladder.ladder_lookup(rows, levels, "v").select("c_custkey", "v", "level")


_LV = "SELECT {k}{c}o_orderpriority, n AS w, sum(n) OVER ({p}ORDER BY o_orderpriority) AS upto, sum(n) OVER ({q}) AS tot FROM (SELECT {k}{c}o_orderpriority, count(*) AS n FROM o WHERE {f} GROUP BY ALL)"
_LADDER = f"""
WITH o AS (SELECT c_nationkey, c_mktsegment, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 400000),
a AS ({_LV.format(k="c_nationkey, c_mktsegment", c=", ", p="PARTITION BY c_nationkey, c_mktsegment ", q="PARTITION BY c_nationkey, c_mktsegment", f="true")}),
b AS ({_LV.format(k="c_nationkey", c=", ", p="PARTITION BY c_nationkey ", q="PARTITION BY c_nationkey", f="true")}),
c AS ({_LV.format(k="", c="", p="", q="", f="true")}),
x AS (SELECT c_custkey, c_nationkey, c_mktsegment, {_U64.format(p="'ladder:' || c_custkey")} AS u FROM customer),
d AS (SELECT x.*, CASE WHEN (c_nationkey, c_mktsegment) IN (SELECT c_nationkey, c_mktsegment FROM a) THEN 'nation_segment' WHEN c_nationkey IN (SELECT c_nationkey FROM b) THEN 'nation' ELSE 'all' END AS level FROM x)
SELECT c_custkey, level AS o_orderpriority_level, o_orderpriority FROM d JOIN a USING (c_nationkey, c_mktsegment) WHERE level = 'nation_segment' AND u * tot // {_SPAN} BETWEEN upto - w AND upto - 1
UNION ALL SELECT c_custkey, level, o_orderpriority FROM d JOIN b USING (c_nationkey) WHERE level = 'nation' AND u * tot // {_SPAN} BETWEEN upto - w AND upto - 1
UNION ALL SELECT c_custkey, level, o_orderpriority FROM d, c WHERE level = 'all' AND u * tot // {_SPAN} BETWEEN upto - w AND upto - 1"""
_LEVELS = [ladder.Level("nation_segment", ("c_nationkey", "c_mktsegment")), ladder.Level("nation", ("c_nationkey",)), ladder.Level("all", ())]


def _ladder_table(t):
    return t.orders.filter("o_totalprice > 400000").join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"), "o_custkey").select("c_nationkey", "c_mktsegment", "o_orderpriority", F.lit(1).alias("count"))


def _ladder_rows(t):
    return ladder.ladder_draw(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), _ladder_table(t), _LEVELS, "o_orderpriority", hashing.payload("ladder", F.col("c_custkey")), suppressed=None)


@query(_LADDER)
def ladder_draw(t):
    return _ladder_rows(t).select("c_custkey", "o_orderpriority_level", "o_orderpriority")


@query(f"SELECT o_orderpriority_level AS level, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share, o_orderpriority_level <> 'nation_segment' AS backed_off FROM ({_LADDER}) GROUP BY 1")
def backoff_rates(t):
    return ladder.backoff_rates(_ladder_rows(t), "o_orderpriority_level", "nation_segment").withColumn("share", F.round("share", 9))


@query("SELECT p_brand, p_type, n + 2 AS weight, round((n + 2) / sum(n + 2) OVER (PARTITION BY p_brand), 9) AS p FROM (SELECT p_brand, p_type, count(*) FILTER (p_size > 25) AS n FROM part GROUP BY ALL) WHERE n > 0")
def ladder_probabilities(t):
    table = t.part.select("p_brand", "p_type", (F.col("p_size") > 25).cast("int").alias("count"))
    return ladder.probabilities(table, ladder.Level("brand", ("p_brand",)), "p_type", smoothing=2, suppressed=None).withColumn("p", F.round("p", 9))


@query(f"SELECT c_custkey, {_U64.format(p="'flag:' || c_custkey")} < {hashing.threshold('0.00701')}::HUGEINT AS rare, {_U64.format(p="'half:' || c_custkey")} < {hashing.threshold('0.5')}::HUGEINT AS half FROM customer")
def bernoulli_hash(t):
    return t.customer.select("c_custkey", hashing.bernoulli(hashing.payload("flag", F.col("c_custkey")), "0.00701").alias("rare"), hashing.bernoulli(hashing.payload("half", F.col("c_custkey")), "0.5").alias("half"))


_SHAPES = ["disc", "cube", "cone", "ring", "rod", "slab", "knot"]


@query(f"SELECT c_custkey, {_SHAPES!r}[({_U64.format(p="'pick:' || c_custkey")} % 7)::BIGINT + 1] AS shape FROM customer")
def stable_pick(t):
    return t.customer.select("c_custkey", hashing.pick(hashing.payload("pick", F.col("c_custkey")), F.array(*map(F.lit, _SHAPES))).alias("shape"))


_RATES = {"BUILDING": [("low", "0.2"), ("mid", "0.35")], "MACHINERY": [("low", "0.5")]}


@query(f"""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN CASE WHEN u < {hashing.threshold('0.2')}::HUGEINT THEN 'low' WHEN u < {hashing.threshold('0.55')}::HUGEINT THEN 'mid' ELSE 'high' END
  WHEN 'MACHINERY' THEN CASE WHEN u < {hashing.threshold('0.5')}::HUGEINT THEN 'low' ELSE 'high' END ELSE 'unknown' END AS label FROM (SELECT *, {_U64.format(p="'rate:' || c_custkey")} AS u FROM customer)""")
def rate_label(t):
    return t.customer.select("c_custkey", hashing.rate_label_by(F.col("c_mktsegment"), hashing.payload("rate", F.col("c_custkey")), _RATES, "high").alias("label"))


@query(f"""
WITH x AS (SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 3 ELSE 0 END AS a, 5 AS b, CASE WHEN c_nationkey % 5 = 0 THEN 2 ELSE 0 END AS c, {_U64.format(p="'fit:' || c_custkey")} AS u FROM customer), y AS (SELECT *, u * (a + b + c) // {_SPAN} AS spot FROM x)
SELECT c_custkey, CASE WHEN spot < a THEN 'amber' WHEN spot < a + b THEN 'blue' ELSE 'coral' END AS label FROM y""")
def compatible_label(t):
    allowed = F.filter(F.array(F.when(F.col("c_nationkey") % 2 == 0, F.lit("amber")), F.lit("blue"), F.when(F.col("c_nationkey") % 5 == 0, F.lit("coral"))), lambda x: x.isNotNull())
    return t.customer.select("c_custkey", hashing.compatible_label(hashing.payload("fit", F.col("c_custkey")), {"amber": 3, "blue": 5, "coral": 2}, allowed).alias("label"))


_NS = uuid.UUID("6ba7b810-9dad-11d1-80b4-00c04fd430c8")


@query(f"""
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::INTEGER % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id
FROM (SELECT c_custkey, sha1(unhex('{_NS.hex}') || encode('7:' || c_custkey)) AS h FROM customer)""")
def uuid5_ids(t):
    return t.customer.select("c_custkey", hashing.uuid5(_NS, hashing.payload("7", F.col("c_custkey"))).alias("id"))


@query("SELECT c_custkey, substr(sha256('a:' || c_custkey), 1, 16) AS colon, substr(sha256('[\"a\",\"' || c_custkey || '\"]'), 1, 16) AS json, substr(sha256('a' || chr(0) || c_custkey), 1, 16) AS nul FROM customer")
def hash_payloads(t):
    k = F.col("c_custkey")
    return t.customer.select(k, hashing.u64_hex(hashing.payload("a", k)).alias("colon"), hashing.u64_hex(hashing.json_payload("a", k)).alias("json"), hashing.u64_hex(hashing.nul_payload("a", k)).alias("nul"))


_TARGET = "(SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice))::BIGINT AS w FROM orders GROUP BY ALL)"


@query(f"""
WITH n AS (SELECT o_orderstatus, count(*) AS slots_in FROM orders GROUP BY 1), q AS (SELECT o_orderstatus, o_orderpriority, quota FROM {_lr(f"(SELECT * FROM {_TARGET} JOIN n USING (o_orderstatus))", "o_orderpriority", "slots_in", "w", "o_orderstatus")}),
r AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS i FROM orders), s AS (SELECT r.*, i > coalesce(quota, 0) AS over_ FROM r LEFT JOIN q USING (o_orderstatus, o_orderpriority)),
t AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, over_ ORDER BY o_orderkey) AS turn FROM s), h AS (SELECT o_orderstatus, o_orderpriority, count(*) AS have FROM orders GROUP BY ALL),
sh AS (SELECT o_orderstatus, o_orderpriority AS new_, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, c) AS turn FROM (SELECT o_orderstatus, o_orderpriority, unnest(range(greatest(quota - coalesce(have, 0), 0))) AS c FROM q LEFT JOIN h USING (o_orderstatus, o_orderpriority)))
SELECT o_orderkey, t.o_orderstatus, coalesce(CASE WHEN over_ THEN new_ END, o_orderpriority) AS o_orderpriority, over_ AND new_ IS NOT NULL AS repaired FROM t LEFT JOIN sh ON sh.o_orderstatus = t.o_orderstatus AND sh.turn = t.turn AND over_""")
def repair_to_quota(t):
    source = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.round(F.sum("o_totalprice")).cast("long").alias("w"))
    return repair.repaired_to_quota(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), source, ["o_orderstatus"], "o_orderpriority", "w", ["o_orderkey"])


@query(f"""
SELECT doc_id, toxic IS NULL AS filled, CASE WHEN toxic IS NOT NULL THEN toxic::VARCHAR WHEN quality = 0 THEN 'forced' WHEN {_U64.format(p="'fill:' || doc_id")} < {hashing.threshold('0.5')}::HUGEINT THEN 'a' ELSE 'b' END AS toxic
FROM (SELECT doc_id, quality, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE toxic END AS toxic FROM labels)""")
def attribute_fill(t):
    rows = t.labels.select("doc_id", "quality", F.when(F.col("doc_id") % 3 != 0, F.col("toxic").cast("string")).alias("toxic"))
    return repair.hash_filled(rows, "toxic", ["0", "1"], (F.col("quality") == 0, "forced"), ("a", "b"), "doc_id", "fill").select("doc_id", "filled", "toxic")


@query("""
WITH l AS (SELECT o_orderkey, o_orderpriority, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 0 WHEN o_orderstatus = 'F' THEN 1 END AS side FROM orders), n AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, side ORDER BY o_orderkey) AS turn FROM l WHERE side IS NOT NULL)
SELECT l.o_orderkey, coalesce(b.o_totalprice, l.o_totalprice) AS o_totalprice, b.o_orderkey IS NOT NULL AS exchanged FROM l LEFT JOIN n a ON a.o_orderkey = l.o_orderkey LEFT JOIN n b ON b.o_orderpriority = a.o_orderpriority AND b.turn = a.turn AND b.side = 1 - a.side""")
def pair_exchange(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return repair.pair_exchanged(rows, F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F", ["o_orderpriority"], ["o_totalprice"], "o_orderkey").select("o_orderkey", "o_totalprice", "exchanged")


@query("""
WITH r AS (SELECT c_mktsegment, max(c_acctbal) AS best FROM customer WHERE c_nationkey < 5 GROUP BY 1)
SELECT r.c_mktsegment, min(c_custkey) AS c_custkey FROM r JOIN customer c ON c.c_mktsegment = r.c_mktsegment AND c_acctbal = best AND c_nationkey < 5 GROUP BY 1""")
def best_donor(t):
    donors = t.customer.filter("c_nationkey < 5").select("c_mktsegment", "c_custkey", (-F.col("c_acctbal")).alias("down"))
    return repair.best_donor(t.customer, donors, ["c_mktsegment"], ["down"], "c_custkey")


@query("""
SELECT p_partkey, CASE WHEN p_size > 40 AND p_brand <> 'BULK' THEN 'BULK' ELSE p_brand END AS p_brand, CASE WHEN p_retailprice < 950 THEN 1 ELSE p_size END AS p_size,
  array_to_string(list_filter([CASE WHEN p_size > 40 AND p_brand <> 'BULK' THEN 'bulk' END, CASE WHEN p_retailprice < 950 AND p_size <> 1 THEN 'cheap' END], lambda x: x IS NOT NULL), ',') AS repairs FROM part""")
def attribute_repairs(t):
    rows = t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice")
    out = repair.attribute_repairs(rows, {"bulk": ("p_brand", F.col("p_size") > 40, F.lit("BULK")), "cheap": ("p_size", F.col("p_retailprice") < 950, F.lit(1))})
    return out.select("p_partkey", "p_brand", "p_size", F.array_join("repairs", ",").alias("repairs"))


@query()
def missingness_allocation(t):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    source = weights.cube(rows.select("c_nationkey", F.lit(1).alias("count"), F.lit(False).alias("suppressed")), ["c_nationkey"])
    out = repair.allocated_missing(rows, ["c_nationkey"], "stratum", F.col("c_acctbal") > 0, "c_mktsegment", "BUILDING", source, "count", 0.4, "c_custkey", "missing")
    return out.select("c_custkey", "c_mktsegment", "allocated")


@query()
def freeze_origin_flow(t):
    rows = t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment"))
    return flow.frozen(rows, ["c_nationkey"], "c_mktsegment", "c_custkey", 120)


@query()
def freeze_proportional(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return flow.frozen(rows, ["o_orderstatus"], "o_orderpriority", "o_orderkey", 333, mode="proportional")


@query(f"SELECT c_mktsegment, quota AS n, quota AS n_ids FROM {_lr('(SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)', 'c_mktsegment', '120')} WHERE quota > 0")
def freeze_origin_quotas(t):
    """Each origin's rows in the frozen sample: the largest remainder of its share, ids once each."""
    return freeze_origin_flow(t).join(t.customer.select("c_custkey"), "c_custkey", "left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c_custkey").alias("n_ids"))


@query(f"SELECT o_orderpriority, quota AS n, quota AS n_ids FROM {_lr('(SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)', 'o_orderpriority', '333')} WHERE quota > 0")
def freeze_proportional_quotas(t):
    """As ``freeze_origin_quotas``, for the proportional mode."""
    return freeze_proportional(t).join(t.orders.select("o_orderkey"), "o_orderkey", "left_semi").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("n_ids"))


@query(f"SELECT o_orderstatus, quota AS n FROM {_lr('(SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)', 'o_orderstatus', '333')} WHERE quota > 0")
def freeze_proportional_strata(t):
    """Each stratum's rows in the frozen sample: its proportional quota, kept by the exchange of origins."""
    return freeze_proportional(t).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT count(*) AS n_rows, greatest(sum((c_mktsegment = 'BUILDING')::BIGINT), floor(0.4 * count(*) + 0.5)::BIGINT)::BIGINT AS n_value,
  greatest(0, floor(0.4 * count(*) + 0.5)::BIGINT - sum((c_mktsegment = 'BUILDING')::BIGINT))::BIGINT AS n_allocated, 0::BIGINT AS n_wrong FROM customer""")
def missingness_totals(t):
    """The allocation meets its target, takes eligible rows alone and changes no other."""
    after = missingness_allocation(t).withColumnRenamed("c_mktsegment", "now").join(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), "c_custkey")
    fine = F.when(F.col("allocated"), (F.col("now") == "BUILDING") & (F.col("c_mktsegment") != "BUILDING") & (F.col("c_acctbal") > 0)).otherwise(F.col("now").eqNullSafe(F.col("c_mktsegment")))
    total = lambda c: F.sum(c.cast("long"))
    return after.agg(F.count(F.lit(1)).alias("n_rows"), total(F.col("now") == "BUILDING").alias("n_value"), total(F.col("allocated")).alias("n_allocated"), total(~fine).alias("n_wrong"))
