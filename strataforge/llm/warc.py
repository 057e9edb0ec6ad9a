"""WARC writer and reader (operator 1).

Writer: equal payloads are found by digest (two narrow shuffles without payloads); key ranges
are dealt to shards by payload bytes, read from a histogram of the keys and thus by the data
alone; a key that holds more than a shard, and rows without one, are cut by payload and URL. One
wide shuffle puts each shard's records into a partition of its own, sorted by key. Every shard is
written to files that roll once their compressed size passes a limit. Headers, record ids and
digests are generated anew from the content, so a retried or speculative task writes the same
bytes: under a temporary name, then renamed to a name that holds a digest of the content. A file of that
name that another attempt left is the same file, and is taken as it is. The manifest, which alone
says what belongs to the archive, is written last, likewise.

Reader: one task per file of the manifest; every member is parsed and its digests are checked.

Defined results: a null payload is empty; null keys sort first and are never referred to when
the group has another key; of rows that share the smallest key of a payload, the response is one with
the smallest URL (null first); a row repeated with key and payload gives one response and revisits of
the same key; an empty table gives a manifest without files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm import skew
from strataforge.llm.shared import shuffles_dropped

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the UUID namespace for URLs
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the WARC 1.1 standard
BINS = 4096


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _decisions(pages: DataFrame, least: int) -> DataFrame:
    """(key, sha, target, target_url): records whose payload another record shares, with key and URL of the group's response.

    Payloads that many records share are heavy keys: their groups are broadcast.
    """
    digest = pages.withColumn("digest", F.struct("sha", "size"))
    rank = F.struct(F.col("key").isNull().alias("none"), "key", F.col("url").isNotNull().alias("named"), "url")
    groups = digest.filter(F.col("size") >= least).groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = groups.select("digest", F.col("first.key").alias("target"), F.col("first.url").alias("target_url"))
    return skew.attached(digest.select("key", "digest").distinct(), groups, "digest").select("key", F.col("digest.sha").alias("sha"), "target", "target_url")


def _place(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds the key reaches, by binary search; 0 for null."""
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    half = lambda x: F.shiftright(x["lo"] + x["hi"], 1)
    step = lambda x, _: F.when(x["lo"] >= x["hi"], x).when(F.get(table, half(x)) <= key, F.struct((half(x) + 1).alias("lo"), x["hi"].alias("hi"))).otherwise(F.struct(x["lo"].alias("lo"), half(x).alias("hi")))
    steps = F.array_repeat(F.lit(0), len(bounds).bit_length() + 1)
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), step, lambda x: x["lo"])
    return F.when(key.isNull(), F.lit(0)).otherwise(found).cast("int")


def _shards(pages: DataFrame, shard_bytes: int, min_shards: int) -> tuple[Column, Column, int]:
    """Columns with the first shard of a row's key and the number of shards that it is cut into, and how many shards there are.

    Key ranges that hold more than a shard are cut into equal steps, round by round, until each fits
    or holds one key; ranges in order then fill shards. A key that alone holds more than a shard is
    cut into several, as are the rows without a key, which come first. All of it follows from the
    rows alone. The driver holds about one range a shard.
    """
    low, high, total, bare = pages.agg(F.min("key"), F.max("key"), F.sum("size"), F.sum(F.when(F.col("key").isNull(), F.col("size")))).first()
    total, bare = int(total or 0), int(bare or 0)
    target = max(1, min(shard_bytes, -(-total // min_shards)))
    first, bounds, parts = max(1, -(-bare // target)), [], []
    if low is not None:
        cells: dict[int, list[int]] = {low: [high + 1, total]}  # start: stop, bytes
        while heavy := {a: c for a, c in cells.items() if c[1] > target and c[0] - a > 1}:
            starts = sorted(cells)
            spans = {a: -(-(c[0] - a) // max(2, min(BINS, BINS * 64 // len(heavy)))) for a, c in heavy.items()}
            cell = _place(starts[1:], F.col("key"))
            begin, width = (F.from_json(F.lit(json.dumps(x)), "array<bigint>") for x in (starts, [spans.get(a, 0) for a in starts]))
            counted = pages.filter("key is not null").select(F.get(begin, cell).alias("a"), F.get(width, cell).alias("w"), "key", "size").filter("w > 0")
            found = counted.groupBy("a", "w", F.expr("(key - a) div w").alias("b")).agg(F.sum("size").alias("n")).collect()
            for a in heavy:
                del cells[a]
            for r in found:
                x = r["a"] + r["b"] * r["w"]
                cells[x] = [min(x + r["w"], heavy[r["a"]][0]), int(r["n"])]
        filled = 0
        for a in sorted(cells):
            n = cells[a][1]
            if not parts or n > target or filled + n > target:
                bounds.append(a)
                parts.append(max(1, -(-n // target)))
                filled = 0
            filled += n
    base = [first]
    for n in parts:
        base.append(base[-1] + n)
    place = _place(bounds[1:], F.col("key"))
    pick = lambda xs: F.get(F.from_json(F.lit(json.dumps(xs)), "array<int>"), place)
    null = F.col("key").isNull()
    return F.when(null, F.lit(0)).otherwise(pick(base[:-1] or [0])).cast("int"), F.when(null, F.lit(first)).otherwise(pick(parts or [1])).cast("int"), base[-1]


def _name(key, url: str | None, digest: str, ordinal: int) -> str:
    """Record id, by content: equal rows are told apart by their ordinal."""
    return uuid.uuid5(NAMESPACE, json.dumps([key, digest, url, ordinal])).urn


def _record(kind: str, key, url: str | None, payload: bytes, size: int, sha: bytes, target: tuple | None, ordinal: int, date: str) -> bytes:
    digest = base64.b32encode(sha).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{_name(key, url, digest, ordinal)}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_name(target[0], target[1], digest, 0)}>")]
        if target[0] is not None:
            head.append(("X-Refers-To-Key", str(target[0])))
    if key is not None:
        head.append(("X-Key", str(key)))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{a}: {b}\r\n" for a, b in head).encode()
    return b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _packed(data: bytes, level: int) -> bytes:
    """One gzip member, the same bytes for the same data."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _commit(fs: pafs.FileSystem, temp: str, final: str, size: int) -> None:
    """Renames a complete file; one that another attempt left under the same name, by content, will do."""
    there = lambda: (x := fs.get_file_info(final)).type == pafs.FileType.File and x.size == size
    if not there():
        try:
            fs.move(temp, final)
            return
        except OSError:  # where a rename does not replace: another attempt was faster
            if not there():
                raise
    fs.delete_file(temp)


class _Roll:
    """Files of one shard. Each is written under a temporary name and renamed when it is complete."""

    def __init__(self, folder: str, shard: int, limit: int, attempt: str) -> None:
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.shard, self.limit, self.attempt, self.n = shard, limit, attempt, 0
        self.out, self.done = None, []

    def add(self, member: bytes, responses: int) -> None:
        if self.out is None:
            self.stem = f"part-{self.shard:06d}-{self.n:04d}"
            self.temp = f"{self.root}/.{self.stem}.{self.attempt}.tmp"
            self.out, self.size, self.records, self.responses, self.sum = self.fs.open_output_stream(self.temp, compression=None), 0, 0, 0, hashlib.sha256()
            self.n += 1
        self.out.write(member)
        self.sum.update(member)
        self.size, self.records, self.responses = self.size + len(member), self.records + 1, self.responses + responses
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            final = f"{self.stem}-{self.sum.hexdigest()[:16]}.warc.gz"
            _commit(self.fs, self.temp, f"{self.root}/{final}", self.size)
            self.done.append((final, self.shard, self.records, self.responses, self.size, self.sum.hexdigest()))


MANIFEST = T.StructType([T.StructField("file", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("records", T.LongType()), T.StructField("responses", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType())])


def write_warc(pages: DataFrame, folder: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", roll_bytes: int = 64 << 20, shard_bytes: int = 128 << 20, min_shards: int = 48, least_revisit: int = 0, level: int = 6, date: str = "2020-01-01T00:00:00Z") -> list[dict]:
    """Writes all rows below ``folder`` (a URI that every executor reaches) and returns the manifest's files.

    ``key_col`` is an integer column. Shards hold about ``min(shard_bytes, total / min_shards)``
    payload bytes, and each is one task; ``roll_bytes`` bounds a file's compressed size but for its last record.
    """
    rows = pages.select(F.col(key_col).cast("long").alias("key"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha", F.unhex(F.sha1("payload")))
    narrow = rows.select("key", "url", "size", "sha")
    base, parts, shards = _shards(narrow.select("key", "size"), shard_bytes, min_shards)
    marks = _decisions(narrow, least_revisit)
    none = lambda kind: F.lit(None).cast(kind)
    part = F.pmod(F.xxhash64("sha", "url"), parts).cast("int")  # rows equal in key, payload and URL stay together
    full = rows.select("key", "url", "payload", "size", "sha", none("long").alias("target"), none("string").alias("target_url"), F.lit(1).alias("order"), F.lit(False).alias("mark"), (base + part).alias("shard"))
    told = marks.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))  # to every shard of the key
    told = told.select("key", none("string").alias("url"), none("binary").alias("payload"), none("long").alias("size"), "sha", "target", "target_url", F.lit(0).alias("order"), F.lit(True).alias("mark"), (base + F.col("part")).alias("shard"))
    dealt = full.unionByName(told).repartitionById(shards, "shard").sortWithinPartitions(F.col("key").asc_nulls_first(), "sha", "order", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        roll, done, current, mark, seen = None, [], None, None, Counter()
        for batch in batches:
            for key, url, payload, size, sha, target, target_url, _, is_mark, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if roll is None or roll.shard != number:
                    if roll is not None:
                        roll.close()
                        done += roll.done
                    roll, current = _Roll(folder, number, roll_bytes, attempt), None
                if current != (key, sha):
                    current, mark, seen = (key, sha), None, Counter()
                if is_mark:
                    mark = target, target_url
                    continue
                k = seen[url]
                seen[url] += 1
                revisit = mark is not None and not (mark == (key, url) and k == 0)
                record = _record("revisit" if revisit else "response", key, url, b"" if revisit else payload, size, sha, mark, k, date)
                roll.add(_packed(record, level), int(not revisit))
        if roll is not None:
            roll.close()
            done += roll.done
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=MANIFEST.names)

    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    with shuffles_dropped(pages.sparkSession):
        files = sorted((r.asDict() for r in dealt.mapInArrow(write, MANIFEST).collect()), key=lambda r: r["file"])
    temp = f"{root}/.MANIFEST.json.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as out:
        out.write(json.dumps({"format": "WARC/1.1", "files": files}, indent=1).encode())
    fs.move(temp, f"{root}/MANIFEST.json")
    return files


def _members(stream) -> Iterator[bytes]:
    """Contents of each gzip member, reading a bounded piece at a time."""
    z, out = zlib.decompressobj(31), []
    while piece := stream.read(1 << 20):
        while piece:
            out.append(z.decompress(piece))
            piece = z.unused_data
            if z.eof:
                yield b"".join(out)
                z, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("the last gzip member is cut off")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; wrong lengths or digests are errors."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"malformed record {fields.get('WARC-Record-ID')}")
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"block digest differs in {fields['WARC-Record-ID']}")
    return fields, block


RECORDS = T.StructType([T.StructField("key", T.LongType()), T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("record_id", T.StringType()), T.StructField("file", T.StringType())])


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row a record of the committed files; with ``payloads`` also ``payload`` (null for revisits)."""
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(f"{root}/MANIFEST.json") as f:
        files = [(x["file"],) for x in json.loads(f.read())["files"]]
    schema = T.StructType([*RECORDS.fields, *([T.StructField("payload", T.BinaryType())] if payloads else [])])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()][: len(schema)]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        fields, block = parse_record(data)
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                        if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                            raise ValueError(f"payload digest differs in {fields['WARC-Record-ID']}")
                        whole = [int(fields[x]) if x in fields else None for x in ("X-Key", "X-Refers-To-Key")]
                        rows.append((whole[0], fields.get("WARC-Target-URI"), size, digest, kind, whole[1], fields["WARC-Record-ID"], name, payload if kind == "response" else None)[: len(schema)])
                        held += len(data) if payloads else 300
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=schema.names)
                            rows, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=schema.names)

    names = spark.createDataFrame(files, "file string")
    if files:
        names = names.repartition(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism)))
    return names.mapInArrow(read, schema)
