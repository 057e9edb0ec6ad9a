import base64
import gzip
import hashlib
import json
from pathlib import Path

import pytest

from strataforge.llm import warc


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


SCHEMA = "page_id long, url string, html string, payload_bytes string, shard int"
ROWS = [(5, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, "<p>other é</p>"), (3, "http://b\r\nX: y", None), (4, "u", ""), (2, "http://a/2", "<p>same</p>"), (None, "n", "<p>same</p>"), (8, "z", "line\r\n\r\nWARC/1.1\r\n" * 50)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def contents(folder):
    return {p.name: p.read_bytes() for p in Path(folder).iterdir()}


def test_round_trip(spark, tmp_path):
    warc.write_warc(table(spark, ROWS), f"file://{tmp_path}/w", roll_bytes=300, min_shards=3)
    got = warc.read_warc(spark, f"file://{tmp_path}/w", payloads=True).collect()
    assert sorted((r.key if r.key is not None else -1, r.payload_digest, r.payload_bytes) for r in got) == sorted((i if i is not None else -1, sha(h), len((h or "").encode())) for i, _, h in ROWS)
    kinds = sorted((r.key if r.key is not None else -1, r.record_type, r.refers_to) for r in got if r.payload_digest == sha("<p>same</p>"))
    assert kinds == [(-1, "revisit", 2), (2, "response", None), (2, "revisit", 2), (5, "revisit", 2)]
    assert sorted((r.key, r.record_type, r.refers_to) for r in got if r.payload_bytes == 0) == [(3, "response", None), (4, "revisit", 3)]
    for r in got:
        if r.record_type == "response":
            assert sha(bytes(r.payload).decode()) == r.payload_digest
    names = contents(tmp_path / "w")
    assert not [n for n in names if n.endswith(".tmp")] and "MANIFEST.json" in names
    listed = json.loads(names["MANIFEST.json"])["files"]
    assert {x["file"] for x in listed} == {n for n in names if n.endswith(".gz")} and sum(x["records"] for x in listed) == len(ROWS)
    assert all(hashlib.sha256(names[x["file"]]).hexdigest() == x["sha256"] and x["bytes"] == len(names[x["file"]]) for x in listed)


def test_threshold_for_revisits(spark, tmp_path):
    warc.write_warc(table(spark, ROWS), f"file://{tmp_path}/w", least_revisit=5)
    got = warc.read_warc(spark, f"file://{tmp_path}/w").filter("payload_bytes = 0").collect()
    assert [r.record_type for r in got] == ["response", "response"]


def test_bytes_do_not_depend_on_partitions(spark, tmp_path):
    rows = [(i, f"http://h/{i % 7}", f"<p>{i % 40}</p>" * (i % 13)) for i in range(400)]
    for k, parts in enumerate((1, 5)):
        warc.write_warc(table(spark, rows[:: 1 if k else -1]).repartition(parts), f"file://{tmp_path}/{k}", roll_bytes=4000, min_shards=4)
    assert contents(tmp_path / "0") == contents(tmp_path / "1")
    text = b"".join(gzip.decompress(v) for n, v in sorted(contents(tmp_path / "0").items()) if n.endswith(".gz"))
    assert text.count(b"WARC/1.1\r\nWARC-Type") == 400


def test_damage_is_an_error(spark, tmp_path):
    good = warc._record("response", 1, "u", b"abc", 3, hashlib.sha1(b"abc").digest(), None, 0, "2020-01-01T00:00:00Z")
    assert warc.parse_record(good)[1].endswith(b"abc")
    for bad in (good.replace(b"abc", b"abd"), good[:-1], good.replace(b"WARC/1.1", b"WARC/9.9")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_empty_table_and_skewed_keys(spark, tmp_path):
    warc.write_warc(table(spark, []), f"file://{tmp_path}/e")
    assert warc.read_warc(spark, f"file://{tmp_path}/e").count() == 0
    rows = [(i, "u", "x" * 100 + str(i)) for i in range(300)] + [(10**15, "far", "y")]
    files = warc.write_warc(table(spark, rows), f"file://{tmp_path}/s", shard_bytes=3000, min_shards=2)
    assert sum(f["records"] for f in files) == 301 and len(files) > 3
    got = [r.key for r in warc.read_warc(spark, f"file://{tmp_path}/s").collect()]
    assert sorted(got) == sorted(r[0] for r in rows)


def test_one_key_and_no_key_are_cut(spark, tmp_path):
    rows = [(7, f"u{i}", "same" if i % 3 else f"own {i} " * 20) for i in range(300)] + [(None, f"n{i}", f"none {i} " * 20) for i in range(100)] + [(None, None, "lone")] * 3 + [(i, "v", "same") for i in range(8, 30)]
    files = warc.write_warc(table(spark, rows), f"file://{tmp_path}/k", shard_bytes=3000, min_shards=2)
    assert max(f["records"] for f in files) < 150 and len({f["shard"] for f in files}) > 8
    got = warc.read_warc(spark, f"file://{tmp_path}/k").collect()
    assert sorted(map(str, ((r.key, r.url, r.payload_digest) for r in got))) == sorted(map(str, ((k, u, sha(h)) for k, u, h in rows)))
    assert len({r.record_id for r in got}) == len(rows)
    same = [r for r in got if r.payload_digest == sha("same")]
    assert [(r.key, r.url) for r in same if r.record_type == "response"] == [(7, "u1")]
    assert {r.refers_to for r in same if r.record_type == "revisit"} == {7}
    assert sorted((r.record_type, r.refers_to) for r in got if r.payload_digest == sha("lone")) == [("response", None), ("revisit", None), ("revisit", None)]


def test_a_file_of_a_lost_attempt_is_taken(tmp_path):
    import pyarrow.fs as pafs

    fs = pafs.LocalFileSystem()
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(b"content")
        warc._commit(fs, f"{tmp_path}/{name}", f"{tmp_path}/final", 7)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["final"]
