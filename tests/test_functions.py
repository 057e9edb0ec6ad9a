import uuid
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataforge.functions import buckets, hashing, text

def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_draws_are_sha256_prefixes(spark):
    import hashlib

    for x in ("", "a:b", "æøå", "p-1"):
        want = int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "big")
        r = one(spark, u=hashing.u64(F.lit(x)), f=hashing.uniform(F.lit(x)), b=hashing.below(F.lit(x), F.lit(1000)), big=hashing.below(F.lit(x), F.lit(10**15)))
        assert int(r.u) == want and r.f == want / 2**64 and r.b == want * 1000 >> 64 and r.big == want * 10**15 >> 64


def test_thresholds_and_rates(spark):
    assert hashing.threshold(0.00701) == 129311675956703952 and hashing.threshold("0.00701") == 129311675956703957 and hashing.threshold("1") == 2**64
    df = spark.range(20000).withColumn("d", hashing.payload("t", F.col("id")))
    assert abs(df.filter(hashing.bernoulli(F.col("d"), "0.3")).count() / 20000 - 0.3) < 0.02
    assert df.filter(hashing.bernoulli(F.col("d"), "0")).count() == 0 and df.filter(hashing.bernoulli(F.col("d"), "1")).count() == 20000
    got = dict(df.groupBy(hashing.rate_label(F.col("d"), [("a", "0.5"), ("b", "0.25")], "c").alias("k")).count().collect())
    assert abs(got["a"] - 10000) < 400 and abs(got["b"] - 5000) < 400 and set(got) == {"a", "b", "c"}
    r = one(spark, none=hashing.pick(F.lit("x"), F.array().cast("array<string>")), unknown=hashing.rate_label_by(F.lit(None).cast("string"), F.lit("x"), {"s": [("a", "1")]}, "r"), no=hashing.compatible_label(F.lit("x"), {"a": 1}, F.array(F.lit("b"))))
    assert r.none is None and r.unknown == "unknown" and r.no is None


def test_uuid5(spark):
    got = spark.range(50).select(hashing.uuid5(uuid.NAMESPACE_DNS, hashing.payload("s", F.col("id"))).alias("u")).collect()
    assert [r.u for r in got] == [str(uuid.uuid5(uuid.NAMESPACE_DNS, f"s:{i}")) for i in range(50)]


def test_bands(spark):
    rows = spark.createDataFrame([(a,) for a in (16, 19, 20, 29, 30, 49, 50, 66, 67, 71, None)], "age int")
    got = [(r.a, r.b) for r in rows.select(buckets.age_band(F.col("age")).alias("a"), buckets.source_band(F.col("age")).alias("b")).collect()]
    assert [x for x, _ in got] == ["18-29"] * 4 + ["30-49"] * 2 + ["50-66"] * 2 + ["67+"] * 3
    assert [x for _, x in got][:4] == ["16-19", "16-19", "20-24", "25-29"]
    keys = spark.createDataFrame([("30",), ("71-",), ("x",), (None,)], "k string")
    assert [tuple(r) for r in keys.select(buckets.age_key_band(F.col("k")), buckets.top_code_value(F.col("k"))).collect()] == [("30-49", 30), ("67+", 71), ("67+", None), ("67+", None)]
    edges = spark.createDataFrame([(-5.0,), (45.0,), (44.9,), (99.0,), (None,)], "x double")
    assert [r[0] for r in edges.select(buckets.right_closed_bin(F.col("x"), [45, 55], ["low", "mid", "high"], 20, 80)).collect()] == ["low", "mid", "low", "high", None]


def test_remaps(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert [r[0] for r in df.select(buckets.lenient_remap(F.col("k"), {"a": "x"})).collect()] == ["x", None, None]
    for bad in ("z", None):
        with pytest.raises(Exception, match="no mapping"):
            df.filter(F.col("k").eqNullSafe(bad)).select(buckets.strict_remap(F.col("k"), {"a": "x"})).collect()
    with pytest.raises(Exception, match="two labels"):
        buckets.remap_table(spark.createDataFrame([("x", ["1", "2"]), ("y", ["2"])], "label string, codes array<string>"), "label", "codes").collect()


def test_eligibility_and_pairing(spark):
    df = spark.createDataFrame([(1, False), (0, False), (5, True), (None, False), (3, None)], "count int, suppressed boolean")
    assert df.filter(buckets.eligible()).count() == 1
    r = one(spark, a=buckets.paired(F.lit(True), F.lit(1), F.lit("x")), b=buckets.paired(F.lit(True), F.lit(None)), c=buckets.paired(F.lit(None).cast("boolean"), F.lit(None)), d=buckets.paired(F.lit(False), F.lit(1)))
    assert (r.a, r.b, r.c, r.d) == (True, False, True, False)


def test_lists(spark):
    df = spark.createDataFrame([(["Chess ", "chess", "", "Music"],), ([],), (None,), (["a", "b", "c"],)], "xs array<string>")
    got = df.select(text.deduped(F.col("xs")).alias("d"), text.list_findings(F.col("xs")).alias("f"), text.normalised_set(F.col("xs")).alias("s"), text.completed(F.col("xs"), ["a", "q", "r"], F.lit("s"), F.lit(4)).alias("c")).collect()
    assert got[0].d == ["Chess", "Music"] and got[1].d == [] and got[0].f == ["blank_item"] and got[1].f == ["too_few"] and got[2].f == ["missing"]
    assert got[0].s is None and got[3].s == ["a", "b", "c"] and len(got[3].c) == 4 and set(got[3].c) <= {"a", "b", "c", "q", "r"} and len(got[1].c) == 3


PROSE = "Første afsnit med æbler og grønne træer i haven.\n\n" + "Andet afsnit fortæller mere om dagene ved havet. " * 7


@pytest.mark.parametrize(
    ("patches", "reason"),
    [
        ([("æbler", "pærer")], None),
        ([("missing", "x")], "excerpt absent"),
        ([("havet", "x")], "excerpt repeated"),
        ([("grøn", "x")], "inside a word"),
        ([("Første afsnit med æbler og grønne træer i haven.", "x")], "whole paragraph"),
        ([("med æbler", "x"), ("æbler og", "y")], "overlap"),
        ([("æbler", "x" * 121)], "too much changed"),
        ([("", "x")], "empty patch"),
    ],
)
def test_patches(patches, reason):
    new, why = text.patch_text(PROSE, patches)
    assert why == reason and (new is None) == (reason is not None)
    if new:
        assert new == PROSE.replace("æbler", "pærer")


LINES = "One line here.\nAnother line here.\n\nMiddle.\n\nThe end of it all."


@pytest.mark.parametrize(
    ("old", "reason"),
    [
        ("One line here.", None),  # a line of a paragraph of two
        ("One line here.\nAnother line here.", "whole paragraph"),
        ("Middle.", "whole paragraph"),
        ("Middle.\n\nThe end of it all.", "whole paragraph"),  # two whole paragraphs
        ("here.\n\nMiddle.", "excerpt absent" if "here.\n\nMiddle." not in LINES else None),  # the first keeps a part
        ("end of", None),
    ],
)
def test_a_patch_may_not_empty_a_paragraph(old, reason):
    assert text.patch_text(LINES, [(old, "x")], least=0, most_share=1.0)[1] == reason


def test_an_excerpt_is_given_once():
    assert text.patch_text(LINES, [("end of", "x"), ("end of", "y")], least=0)[1] == "excerpt given twice"


@settings(max_examples=100, deadline=None)
@given(st.text("ab ", max_size=30), st.text("ab", min_size=1, max_size=3))
def test_patches_count_overlaps(body, old):
    places = [i for i in range(len(body)) if body.startswith(old, i)]
    _, why = text.patch_text(body, [(old, "zz")], least=0)
    if len(places) != 1:
        assert why == ("excerpt absent" if not places else "excerpt repeated")


def test_text_rules(spark):
    x = F.lit("He is 41 år. Then 42 år, not a smoker; the Smoker left.")
    r = one(spark, other=text.other_number_before(x, "år", F.lit(41)), same=text.other_number_before(x, "år", F.lit("x").try_cast("long")), un=text.unnegated(F.lit("not a smoker"), ["smoker"], ["not a"]), yes=text.unnegated(x, ["smoker"], ["not a"]), word=text.mentions_any(x, ["smoke"]), tabs=text.stripped(F.lit("\t a \n")), code=text.without_code(F.lit("084 - Region")), esc=text.script_safe_json(F.lit("<a&b>")))
    assert r.other is True and r.same is not True and r.un is False and r.yes is True and r.word is False and r.tabs == "a" and r.code == "Region"
    assert r.esc == "\\u003ca\\u0026b\\u003e"
    a, b = text.replaced_once(F.col("t"), "x", "y")
    got = spark.createDataFrame([("a x",), ("a",), ("x x",), (None,)], "t string").select(a, b).collect()
    assert [tuple(g) for g in got] == [("a y", None), ("a", "clause absent"), ("x x", "clause repeated"), (None, "no text")]


def test_decimal_literals(spark):
    assert one(spark, x=hashing._wide(2**64)).x == Decimal(2**64)

