import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataforge.functions.hashing import payload
from strataforge.operators import audit, compare, diff, flow, joins, ladder, quota, repair, weights


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- quotas


def by_hand(weights_, slots):
    total = sum(weights_.values())
    base = {k: w * slots // total for k, w in weights_.items()}
    order = sorted(weights_, key=lambda k: (-(weights_[k] * slots % total), k))
    for k in order[: slots - sum(base.values())]:
        base[k] += 1
    return base


def test_largest_remainder_of_known_sizes(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "k string, n int")
    assert dict(rows(quota.largest_remainder(df, ["k"], "n", 7), "k", "quota")) == {"a": 4, "b": 2, "c": 1}
    ties = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1)], "k string, n int")
    assert dict(rows(quota.largest_remainder(ties, ["k"], "n", 2), "k", "quota")) == {"a": 1, "b": 1, "c": 0}
    none = spark.createDataFrame([("a", 0), ("b", 0)], "k string, n int")
    assert dict(rows(quota.largest_remainder(none, ["k"], "n", 5), "k", "quota")) == {"a": 0, "b": 0}


def test_largest_remainder_of_random_sizes(spark):
    r = random.Random(1)
    groups = [({f"k{i:02}": r.choice([1, 3, 10**9, 10**12 + i]) for i in range(r.randrange(1, 20))}, r.randrange(0, 5000)) for _ in range(12)]
    df = spark.createDataFrame([(g, k, n, s) for g, (w, s) in enumerate(groups) for k, n in w.items()], "g int, k string, n long, s int").repartition(3)
    got = {}
    for g, k, q in rows(quota.largest_remainder(df, ["k"], "n", F.col("s"), ["g"]), "g", "k", "quota"):
        got.setdefault(g, {})[k] = q
    assert got == {g: by_hand(w, s) for g, (w, s) in enumerate(groups)}


def test_expansion_has_no_row_for_zero(spark):
    df = spark.createDataFrame([("a", 0), ("b", 2), ("c", None)], "k string, quota int")
    assert rows(quota.expanded(df), "k", "copy") == [("b", 0), ("b", 1)]


def test_water_filling_respects_room(spark):
    df = spark.createDataFrame([("a", 10, 2), ("b", 10, 50), ("c", 1, 50), ("d", 5, 0)], "k string, w int, room int")
    got = dict(rows(quota.water_filled(df, "k", "w", "room", 24, 6), "k", "quota"))
    assert sum(got.values()) == 24 and got["a"] == 2 and got["d"] == 0 and got["b"] == 20 and got["c"] == 2
    assert sum(dict(rows(quota.water_filled(df, "k", "w", "room", 500, 6), "k", "quota")).values()) == 102


def test_stratified_modes(spark):
    df = spark.createDataFrame([(i, "m1" if i < 3 else "m2") for i in range(4)] + [(i, "m3") for i in range(4, 8)], "id int, m string")
    assert Counter(m for (m,) in rows(quota.stratified_head(df, ["m"], ["id"], 4), "m")) == {"m1": 2, "m3": 2}
    assert Counter(m for (m,) in rows(quota.round_robin(df, ["m"], ["id"], 5), "m")) == {"m1": 2, "m2": 1, "m3": 2}


@pytest.mark.parametrize("parts", [1, 7])
def test_draws_do_not_depend_on_partitions(spark, parts):
    base = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("s"))
    df = base.orderBy(F.desc("id")).repartition(parts)
    table = spark.createDataFrame([(0, "x", 3), (0, "y", 1), (1, "z", 1)], "g int, v string, n int")
    quotas = spark.createDataFrame([(i, i) for i in range(7)], "s long, quota int")
    for make in (
        lambda d: quota.weighted_draw(d.withColumn("g", F.lit(0)), table, ["g"], "v", "n", payload("w", F.col("id")), "v").select("id", "v"),
        lambda d: quota.hash_ranked(d, ["s"], "id", quotas, "h").select("id"),
        lambda d: quota.hash_top(d, "id", 20, "t").select("id"),
        lambda d: flow.frozen(d.withColumn("o", (F.col("id") % 3).cast("string")), ["s"], "o", "id", 50).select("id"),
    ):
        assert rows(make(df), "*") == rows(make(base), "*")


def test_weighted_draw_meets_its_weights(spark):
    table = spark.createDataFrame([("x", 3), ("y", 1), ("never", 0)], "v string, n int")
    got = Counter(v for (v,) in rows(quota.weighted_draw(spark.range(8000), table, [], "v", "n", payload("q", F.col("id")), "v"), "v"))
    assert set(got) == {"x", "y"} and abs(got["x"] - 6000) < 200


def test_quota_attachment_is_exact(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, "f").otherwise("m").alias("sex"), (F.col("id") < 70).alias("works"))
    marginal = spark.createDataFrame([("f", "a", 3), ("f", "b", 1), ("m", "a", 1), ("m", "b", 1)], "sex string, job string, n int")
    got = Counter((r.sex, r.job) for r in quota.attach_by_quota(df, F.col("works"), "sex", marginal, "job", "n", "id", "s").collect())
    assert got == {("f", "a"): 26, ("f", "b"): 9, ("m", "a"): 18, ("m", "b"): 17, ("f", None): 15, ("m", None): 15}


def test_marginals_are_checked_before_they_are_filtered(spark):
    good = spark.createDataFrame([("a", 60, True), ("b", 49, False)], "k string, n int, eligible boolean")
    assert rows(quota.audited_marginal(good, "k", "n", 109), "k") == [("a",)]
    for bad, why in (([("a", 1, True)] * 2, "repeats"), ([("a", -1, True)], "negative"), ([("a", 1, True)], "total")):
        with pytest.raises(Exception, match=why):
            quota.audited_marginal(spark.createDataFrame(bad, "k string, n int, eligible boolean"), "k", "n", 2).collect()


# --- ladders


LEVELS = [ladder.Level("cell", ("m", "a")), ladder.Level("m", ("m",)), ladder.Level("all", ())]


def ladder_table(spark):
    return spark.createDataFrame([("1", "x", "single", 900, False), ("1", "x", "married", 100, False), ("2", "y", "single", 0, False), ("2", "y", "married", 7, True), ("2", "z", "married", 5, False)], "m string, a string, v string, count int, suppressed boolean")


def test_ladder_uses_the_first_populated_level(spark):
    df = spark.createDataFrame([(1, "1", "x"), (2, "1", "q"), (3, "2", "y"), (4, "9", "y")], "id int, m string, a string")
    got = {r.id: (r.v, r.v_level) for r in ladder.ladder_draw(df, ladder_table(spark), LEVELS, "v", payload("l", F.col("id"))).collect()}
    assert [got[i][1] for i in (1, 2, 3, 4)] == ["cell", "m", "m", "all"] and got[3][0] == "married"
    p = dict(rows(ladder.probabilities(ladder_table(spark).filter("m = '1'"), LEVELS[0], "v", smoothing=100), "v", "p"))
    assert p == {"single": 1000 / 1200, "married": 200 / 1200}
    with pytest.raises(Exception, match="no level"):
        ladder.ladder_draw(df, ladder_table(spark), LEVELS[:1], "v", payload("l", F.col("id"))).collect()


def test_a_change_in_one_level_moves_no_other_row(spark):
    df = spark.range(300).select(F.col("id"), F.lit("1").alias("m"), F.when(F.col("id") < 150, "x").otherwise("q").alias("a"))
    change = ladder_table(spark).unionByName(spark.createDataFrame([("1", "new", "divorced", 400, False)], ladder_table(spark).schema))
    a, b = ({r.id: r.v for r in ladder.ladder_draw(df, t, LEVELS, "v", payload("l", F.col("id"))).collect()} for t in (ladder_table(spark), change))
    assert all(a[i] == b[i] for i in range(150)) and any(a[i] != b[i] for i in range(150, 300))


# --- flows


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6))
def test_balanced_cells(seed):
    r = random.Random(seed)
    strata, origins = [(s,) for s in range(r.randrange(1, 5))], ["a", "b", "c"][: r.randrange(1, 4)]
    available = {(s, o): r.randrange(0, 6) for s in strata for o in origins}
    available = {c: n for c, n in available.items() if n}
    pool = [c for c, n in available.items() for _ in range(n)]
    if not pool:
        return
    chosen = dict(Counter(r.sample(pool, r.randrange(1, len(pool) + 1))))
    wanted = Counter(o for _, o in r.sample(pool, sum(chosen.values())))
    got = flow.balanced(available, chosen, {o: wanted.get(o, 0) for o in origins})
    assert all(0 <= n <= available.get(c, 0) for c, n in got.items())
    assert {o: sum(n for (_, x), n in got.items() if x == o) for o in origins} == {o: wanted.get(o, 0) for o in origins}


def test_two_surplus_origins_do_not_overfill_one_cell():
    available = {((1,), "a"): 2, ((1,), "b"): 2, ((1,), "c"): 1, ((2,), "c"): 3}
    got = flow.balanced(available, {((1,), "a"): 2, ((1,), "b"): 2}, {"a": 1, "b": 1, "c": 2})
    assert got[(1,), "c"] <= 1 and sum(got.values()) == 4


def test_frozen_sample(spark):
    df = spark.createDataFrame([(i, "abc"[(i >= 5) + (i >= 8)], i % 2) for i in range(10)], "id int, o string, s int")
    got = flow.frozen(df, ["s"], "o", "id", 7)
    assert Counter(o for (o,) in rows(got, "o")) == {"a": 4, "b": 2, "c": 1} and got.columns == df.columns
    with pytest.raises(ValueError):
        flow.balanced({((1,), "a"): 1}, {((1,), "a"): 1}, {"a": 2})


# --- comparison


def test_total_variation_and_nulls(spark):
    a = spark.createDataFrame([("x",)] * 3 + [("y",)] + [(None,)], "k string")
    b = spark.createDataFrame([("x",)] * 2 + [("z",)] * 2 + [(None,)], "k string")
    assert compare.total_variation(a, b, ["k"]).first()[0] == pytest.approx((0.2 + 0.2 + 0.4 + 0.2 + 0.2) / 2)  # nulls stay apart
    assert rows(compare.unexpected(a, b, ["k"]), "k") == [("y",)]  # but are equal as values
    assert compare.total_variation(a, a.filter("k = 'x'"), ["k"]).first()[0] == pytest.approx(0.4)
    assert compare.total_variation(a.limit(0), b, ["k"]).first()[0] == 0.5


def test_tolerance_gate(spark):
    a, b = spark.range(1000).select((F.col("id") % 2).alias("k")), spark.range(1000).select((F.col("id") % 4 == 0).cast("long").alias("k"))
    report = {r.name: (r.value, r.passed) for r in compare.distribution_metrics(a, b, [["k"]], 0.02).collect()}
    assert report["k: total variation"] == (0.25, False) and report["k: violated cells"] == (2.0, False) and report["k: unexpected rows"] == (0.0, True)
    assert compare.distribution_metrics(a, b, [["k"]], 0.3, heldout=True).count() == 1


def test_mixture_needs_every_stratum(spark):
    joint = spark.createDataFrame([("s", "x", 1), ("s", "y", 3), ("t", "x", 1)], "s string, c string, n int")
    strata = spark.createDataFrame([("s", 1), ("t", 1)], "s string, n int")
    assert dict(rows(weights.conditioned_mixture(joint, "s", "c", strata), "c", "share")) == {"x": 0.625, "y": 0.375}
    more = strata.unionByName(spark.createDataFrame([("u", 1)], "s string, n int"))
    assert weights.conditioned_mixture(joint, "s", "c", more).count() == 0


def test_share_of_nothing_is_zero(spark):
    cells = spark.createDataFrame([("a", "young", 10), ("b", "young", 10), ("b", "old", 4), ("c", "young", 1)], "k string, band string, count int")
    base = spark.createDataFrame([("a", 17, 0), ("a", 18, 0), ("b", 17, 3), ("b", 18, 1)], "k string, age int, w int")
    got = dict(((k, b), n) for k, b, n in rows(weights.share_adjusted(cells, ["k"], F.col("band") == "young", base, F.col("age") >= 18, "w"), "k", "band", "count"))
    assert got == {("a", "young"): 0.0, ("b", "young"): 2.5, ("b", "old"): 4.0, ("c", "young"): 0.0}


def test_pooling_floor(spark):
    df = spark.createDataFrame([("a", 99), ("b", 2)], "k string, count int")
    after = weights.pooled(df, [], F.when(F.col("k") == "a", F.lit("A")), "p")
    assert weights.pooling_coverage(df, after, floor=None).first().coverage == 99 / 101
    with pytest.raises(Exception, match="lost too much"):
        weights.pooling_coverage(df, after).collect()


# --- joins, diffs, repairs


def test_lookups_reject_gaps_and_repeats(spark):
    df, dim = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert rows(joins.lookup(df, dim, "k", ["v"]), "k", "v") == [(1, "x"), (2, "y")]
    for bad in (dim.filter("k = 1"), dim.unionByName(dim.limit(1))):
        with pytest.raises(Exception, match="missing or repeated"):
            joins.lookup(df, bad, "k", ["v"]).collect()
    with pytest.raises(Exception, match="repeats on the right"):
        joins.attach_one(df, dim.unionByName(dim), "k").collect()


def test_null_keys_in_joins(spark):
    a, b = spark.createDataFrame([(None,), (1,), (2,)], "k int"), spark.createDataFrame([(None,), (1,)], "k int")
    assert rows(joins.not_in(a, b, ["k"]), "k") == [(2,)] and rows(joins.is_in(a, b, ["k"]), "k") == [(1,), (None,)]
    assert rows(joins.existence(a, b, ["k"]), "k", "exists") == [(1, True), (2, False), (None, False)]
    assert rows(joins.outside(a, b), "k") == [(2,)]


def test_global_row_numbers(spark):
    r = random.Random(2)
    df = spark.createDataFrame([(i, r.randrange(9)) for i in range(500)], "id int, k int").repartition(5)
    got = {r.id: r.row_idx for r in joins.ranged_index(df, ["k", "id"]).collect()}
    assert got == {i: n for n, (k, i) in enumerate(sorted((r.k, r.id) for r in df.collect()))}
    odd = df.withColumn("k", F.when(F.col("k") > 5, F.col("k")))
    assert rows(joins.numbered(odd, ["id"], ["k"], spread=True), "id", "row_idx") == rows(joins.numbered(odd, ["id"], ["k"]), "id", "row_idx")


def test_diff_and_ledger(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 2)], "id int, t string, n int")
    b = spark.createDataFrame([(1, "x", 5), (2, "Y!", 1), (4, "q", 2)], "id int, t string, n int")
    changes = diff.frame_diff(a, b, "id", ["t", "n"])
    assert rows(changes, "id", "changed") == [(1, ["n"]), (2, ["t"])]
    assert tuple(diff.identity_report(a, b, "id").first()) == (1, 1, 0)
    assert rows(diff.classified(a, b, "id", ["t"], [], ["n"]), "id", "safe") == [(1, False), (2, True)]
    ledger = spark.createDataFrame([(1, "n"), (3, "t")], "id int, field string")
    assert rows(diff.ledger_mismatches(changes, ledger, "id", "field"), "id", "problem") == [(2, "unrecorded"), (3, "unfounded")]
    assert diff.only_differs(a, b, "id", ["t", "n"], ["t"]).count() == 1


def test_content_hash_depends_on_rows_and_order_alone(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    h = lambda d, order=("id",): diff.content_hash(d, list(order), chunk=7).first()[0]
    assert h(df) == h(df.repartition(6)) and h(df) != h(df.withColumn("v", F.upper("v"))) and h(df) != h(df, (F.desc("id"),))


def test_minimal_repair(spark):
    df = spark.createDataFrame([(i, "s", "a" if i < 8 else "b") for i in range(10)] + [(20, "other", "z")], "id int, s string, c string")
    source = spark.createDataFrame([("s", "a", 5), ("s", "b", 3), ("s", "d", 2)], "s string, c string, w int")
    got = repair.repaired_to_quota(df, source, ["s"], "c", "w", ["id"]).collect()
    assert Counter(r.c for r in got if r.s == "s") == {"a": 5, "b": 3, "d": 2} and sum(r.repaired for r in got) == 3
    assert [(r.id, r.c) for r in sorted(got) if r.repaired] == [(5, "b"), (6, "d"), (7, "d")]
    assert [r.c for r in got if r.s == "other"] == ["z"]
    assert sorted(map(tuple, repair.repaired_to_quota(df, source, ["s"], "c", "w", ["id"], spread=True).collect())) == sorted(map(tuple, got))


def test_stages_roll_back(spark):
    df = spark.range(3)
    add = lambda d: d.withColumn("x", F.lit(1))
    good, bad = lambda d: d.limit(0), lambda d: d.limit(1)
    out, log = repair.staged(df, [("one", add, good), ("two", add, bad), ("three", add, good)])
    assert out is df and log == [("one", 0), ("two", 1)]
    assert repair.staged(df, [("one", add, good)])[0].columns == ["id", "x"]


def test_missingness_reaches_its_share(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 4).cast("string").alias("s"), F.when(F.col("id") < 10, "unknown").otherwise("known").alias("e"))
    source = spark.createDataFrame([(str(i), i + 1) for i in range(4)], "s string, w int")
    out = repair.allocated_missing(df, ["s"], "key", F.col("id") < 150, "e", "unknown", source, "w", 0.2, "id", "seed")
    got = out.collect()
    assert sum(r.e == "unknown" for r in got) == 40 and sum(r.allocated for r in got) == 30 and all(r.id < 150 for r in got if r.allocated)
    assert sorted(map(tuple, repair.allocated_missing(df.repartition(5), ["s"], "key", F.col("id") < 150, "e", "unknown", source, "w", 0.2, "id", "seed").collect())) == sorted(map(tuple, got))


def test_release_gate(spark):
    base = spark.createDataFrame([(1, "some text", "a"), (2, "other", "b")], "id int, t string, f string")
    vetted = spark.createDataFrame([], "id_sha256 string")
    report = audit.release_report(base, base, "id", "t", ["f"], ["f"], {}, vetted, ["t"])
    assert audit.hard_failures(report).count() == 0
    worse = base.withColumn("t", F.when(F.col("id") == 2, F.lit(" ")).otherwise(F.col("t"))).withColumn("f", F.lit("a"))
    failed = {(r.section, r.name) for r in audit.hard_failures(audit.release_report(base, worse, "id", "t", ["f"], ["f"], {"short": F.length("t") < 3}, vetted, ["t"])).collect()}
    assert failed == {("prose", "unvetted"), ("frozen", "f"), ("failure", "short"), ("blank", "t")}
    assert audit.schema_differences(base, {"id": "int", "t": "bigint", "g": "int"}) == ["extra f", "missing g", "t is string, not bigint"]
