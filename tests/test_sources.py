from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from strataforge.sources import cubes, listings, tables
from strataforge.streaming import windows


def test_cube_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text("﻿OMR;KØN;INDHOLD\n084 Region;1 Mænd;12\n085 Other;2 Kvinder;..\n086 Third;1 Mænd;\n", encoding="utf-8")
    got = cubes.with_counts(cubes.read_cube(spark, str(tmp_path / "c.csv"), ["OMR", "KØN"])).orderBy("OMR").collect()
    assert [(r.OMR, r["OMR__label"], r["KØN"], r["count"], r.suppressed) for r in got] == [("084", "084 Region", "1", 12, False), ("085", "085 Other", "2", 0, True), ("086", "086 Third", "1", 0, True)]
    (tmp_path / "wide.csv").write_text("A;N\nx;1;2;3\n")
    with pytest.raises(Exception, match="number of columns"):
        cubes.read_cube(spark, str(tmp_path / "wide.csv"), ["A"]).collect()


def test_count_problems(spark):
    df = spark.createDataFrame([("5",), ("x",), ("1.5",), ("-2",), (".",), ("7.0",), (None,)], "raw string").fillna("")
    got = [(r["count"], r.suppressed, r.problem) for r in cubes.with_counts(df, strict=False).collect()]
    assert got == [(5, False, None), (0, False, "malformed"), (0, False, "non-integral"), (0, False, "negative"), (0, True, None), (7, False, None), (0, True, None)]
    for raw, why in (("x", "malformed"), ("1.5", "non-integral"), ("-2", "negative")):
        with pytest.raises(Exception, match=why):
            cubes.with_counts(df.filter(F.col("raw") == raw)).collect()
    with pytest.raises(Exception, match="negative count"):
        cubes.reject_negative(spark.createDataFrame([(-1,)], "count int")).collect()


def test_metadata(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"variables": [{"id": "ALDER", "values": [{"id": "17", "text": "17"}, {"id": "18", "text": "18"}, {"id": "TOT", "text": "all"}]}, {"id": "OMR", "values": [{"id": "101", "text": "K"}, {"id": "084", "text": "R"}]}]}')
    meta = cubes.read_metadata(spark, str(tmp_path / "m.json"))
    taken = cubes.selected_values(meta, [cubes.Selection("ALDER", "adult_exact_ages"), cubes.Selection("OMR", "municipalities")])
    assert sorted(r.id for r in taken.collect()) == ["101", "18"] and cubes.estimated_cells(taken) == 3
    for bad in (cubes.Selection("OMR", "nope"), cubes.Selection("NONE", "all")):
        with pytest.raises(ValueError):
            cubes.selected_values(meta, [bad])
    with pytest.raises(ValueError):
        cubes.estimated_cells(meta, most=5)
    wanted = spark.createDataFrame([("OMR", "999"), ("OMR", "101")], "variable string, id string")
    assert [tuple(r) for r in cubes.unknown_values(meta, wanted).collect()] == [("OMR", "999")]


LISTING = 'SEKVENS;NIVEAU;KODE;TITEL\n1;1;084;Top A\n2;2;01;"Mid\nA"\n3;3;101;Leaf 1\n4;3;102;Leaf 2\n5;1;085;Top B\n6;2;02;Mid B\n7;3;201;Leaf 3\n'


def test_hierarchy(spark, tmp_path):
    (tmp_path / "l.csv").write_text(LISTING)
    got = [(r.code, r.middle, r.top) for r in listings.hierarchy(listings.read_listing(spark, str(tmp_path / "l.csv"))).orderBy("code").collect()]
    assert got == [("101", "01", "084"), ("102", "01", "084"), ("201", "02", "085")]
    rows = [(1, 1, "a", ""), (2, 2, "b", ""), (3, 1, "c", ""), (4, 3, "d", "")]
    with pytest.raises(Exception, match="before its parents"):
        listings.hierarchy(spark.createDataFrame(rows, "seq int, level int, code string, title string")).collect()
    twice = [(1, 1, "a", ""), (2, 2, "b", ""), (3, 3, "d", ""), (4, 3, "d", "")]
    with pytest.raises(Exception, match="repeats"):
        listings.hierarchy(spark.createDataFrame(twice, "seq int, level int, code string, title string")).collect()


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, k string")
    tables.write_ordered(df, str(tmp_path / "t"), single_file=True)
    assert [r.k for r in tables.scan(spark, str(tmp_path / "t"), ["k"], 2, {"n": "int", "k": "string"}).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="expected 3"):
        tables.scan(spark, str(tmp_path / "t"), rows=3)
    with pytest.raises(ValueError, match="missing z"):
        tables.scan(spark, str(tmp_path / "t"), contract={"n": "int", "k": "string", "z": "int"})
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_ordered(df, str(tmp_path / "t"))
    wide = tables.widened_union([df, spark.createDataFrame([(2**40, None)], "n long, extra string"), spark.sql("select cast(1.5 as double) n, null extra")])
    assert dict(wide.dtypes) == {"n": "double", "k": "string", "extra": "string"} and wide.count() == 4
    report = spark.createDataFrame([("m", True), ("n", False)], "name string, passed boolean")
    assert '"passed": false' in tables.report_json(report) and "| m | True |" in tables.report_markdown(report, "t")
    assert tables.run_identity(a=1, b="x") == tables.run_identity(b="x", a=1) != tables.run_identity(a=2, b="x")
    assert tables.share_at({"a": [{"b": True}, {"b": 0.5}]}, "b") == 0.5 and tables.share_at([], "b") is None


@dataclass
class Config:
    rows: int
    seed: int = 1


def test_configs(tmp_path):
    tables.save_config(Config(5), str(tmp_path / "c.json"))
    assert tables.load_config(str(tmp_path / "c.json"), Config) == Config(5)
    (tmp_path / "bad.json").write_text('{"rows": 1, "extra": 2}')
    with pytest.raises(ValueError, match="extra"):
        tables.load_config(str(tmp_path / "bad.json"), Config)


def test_stream_equals_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = windows.windowed_counts(stream, "ts", ["event_type"], "value").writeStream.outputMode("complete").format("memory").queryName("w").start()
    q.processAllAvailable()
    q.stop()
    norm = lambda df: sorted((str(r.window_start), r.event_type, r.n, round(r.total, 6)) for r in df.collect())
    assert norm(spark.table("w")) == norm(windows.windowed_counts(batch, "ts", ["event_type"], "value"))
