"""Pages as WARC archives, written in deterministic shards and read back.

``write_archives`` range-sorts the records, gives each its place in that order
and cuts the order into shards of ``shard_records``.  One task writes a shard:
every record is a gzip member of its own, and a file rolls once it holds
``roll_bytes`` of compressed records.  Headers and digests are made anew from
the payload; dates are an argument and record ids follow from place and
content, so the same rows give the same bytes under any partitioning.

A file is written under a temporary name and renamed when it is complete; a
repeated task writes the same bytes again.  The manifest, one row per file
with its size and SHA-256, is written last, also under a temporary name: the
folder counts as an archive once ``manifest`` is there, and readers take only
the files that it lists.

Paths are those of Spark; the tasks open them by pyarrow's file systems
(local, ``hdfs``, ``s3`` / ``s3a``, ``gs``, ``abfs``).
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.llm.common import Scratch

SHARD_RECORDS = 8192
ROLL_BYTES = 4 << 20
#: Beyond as many shards, a task writes several, one after another.
_TASKS = 10_000
#: Payloads shorter than this are always written out.
LEAST_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_READ = 1 << 20
_BATCH = 8 << 20

MANIFEST = "shard bigint, file string, records bigint, bytes bigint, sha256 string"
RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, record_id string, payload binary"


def store_at(path: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system and path for a path as Spark writes it."""
    path = re.sub(r"^s3[an]:", "s3:", path)
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path) if ":" in path else f"file://{path}")


def headers(first: str, fields: dict) -> bytes:
    return "".join([first, "\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None), "\r\n"]).encode()


def member(fields: dict, block: bytes) -> bytes:
    """One record as a gzip member; the same input gives the same bytes."""
    fields = {**fields, "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Length": len(block)}
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(headers("WARC/1.1", fields)) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def record(place: int, page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, refers_url: str | None, date: str) -> bytes:
    """A response, or (with ``refers_to``) a revisit that keeps the HTTP headers only."""
    link = lambda u: None if u is None else quote(u, safe="%/:?#[]@!$&'()*+,;=~-._")
    http = headers("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)})
    again = refers_to is not None
    return member({
        "WARC-Type": "revisit" if again else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_NAMES, f'{place} {page_id} {link(url)} {digest}')}>",
        "WARC-Date": date, "WARC-Target-URI": link(url), "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Profile": REVISIT if again else None, "WARC-Truncated": "length" if again else None,
        "WARC-Refers-To-Target-URI": link(refers_url) if again else None, "WARC-Refers-To-Date": date if again else None,
        "X-Page-Id": page_id, "X-Refers-To-Page-Id": refers_to,
        "Content-Type": "application/http;msgtype=response"}, http if again else http + payload)


class _File:
    """A file in the making: its records go to a temporary name until ``done``."""

    def __init__(self, folder: str, shard: int, part: int, date: str):
        self.store, base = store_at(folder)
        self.shard, self.name = shard, f"shard-{shard:08d}-{part:04d}.warc.gz"
        self.final, self.temp = f"{base}/{self.name}", f"{base}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.store.create_dir(f"{base}/_temporary", recursive=True)
        self.out, self.sha, self.size, self.records = self.store.open_output_stream(self.temp, compression=None), hashlib.sha256(), 0, 0
        self.add(member({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_NAMES, self.name)}>", "WARC-Date": date, "WARC-Filename": self.name,
                         "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
        self.records = 0

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1

    def done(self) -> tuple:
        self.out.close()
        # some stores refuse to rename onto the file of an earlier attempt
        if self.store.get_file_info(self.final).type != fs.FileType.NotFound:
            self.store.delete_file(self.final)
        self.store.move(self.temp, self.final)
        return self.shard, self.name, self.records, self.size, self.sha.hexdigest()


def _writer(folder: str, shard_records: int, roll_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, part, done, target = None, 0, [], None
        for b in batches:
            cols = [b.column(c) for c in ("place", "page_id", "url", "payload", "digest", "refers_to", "refers_url")]
            for i in range(b.num_rows):
                place, page_id, url, payload, digest, refers_to, refers_url = (c[i].as_py() for c in cols)
                if payload is None:  # the row before its page says what the page revisits
                    target = (place, refers_to, refers_url)
                    continue
                shard = place // shard_records
                if file and (file.shard != shard or file.size >= roll_bytes):
                    done.append(file.done())
                    file, part = None, part + 1 if file.shard == shard else 0
                file = file or _File(folder, shard, part, date)
                known = target[1:] if target and target[0] == place else (None, None)
                file.add(record(place, page_id, url, payload, digest, *known, date))
        if file:
            done.append(file.done())
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string() if k in (1, 4) else pa.int64()) for k in range(5)], names)
    return run


def _placed(pages: DataFrame, scratch: Scratch, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Every page with its ``place`` in the order of id, url and payload digest.

    Rows that agree in all three are the same record; a last sort key spreads
    them over the range partitions.  The sorted rows are written once; the
    number of rows in each range, one row a partition, gives the places.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = (pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
            .select("*", F.sha2("payload", 256).alias("digest"), F.xxhash64(F.monotonically_increasing_id()).alias("spread")))
    key = ["page_id", "url", "digest", "spread"]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).drop("spread")
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = scratch.table(rows.select("*", F.spark_partition_id().alias("range"), nth.alias("nth")), "sorted")
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "range").withColumn("place", F.col("start") + F.col("nth")).drop("range", "nth", "start")


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   shard_records: int = SHARD_RECORDS, roll_bytes: int = ROLL_BYTES, date: str = DATE) -> DataFrame:
    """Writes one record per row into ``folder`` and gives the manifest.

    Of equal payloads (SHA-256) of at least ``LEAST_REVISIT`` bytes, the record
    with the smallest id is a response and the others revisit it; rows that
    repeat that id are responses too.  A null text is an empty payload, a null
    url an absent header.  A null id sorts first and is never revisited: such
    rows revisit a record with an id, or are responses where there is none.
    An empty table gives an empty manifest; other columns are not looked at.
    Pages go through whole, however long.  A folder with a manifest is refused.
    """
    spark, jvm = pages.sparkSession, pages.sparkSession._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    manifest = jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    if files.exists(manifest):
        raise FileExistsError(f"{folder} has a manifest")
    placed = _placed(pages, scratch, id_col, url_col, html_col)
    slim = placed.select("place", "page_id", "url", "digest", F.octet_length("payload").alias("n")).where(F.col("n") >= LEAST_REVISIT)
    first = (slim.groupBy("digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1 and first is not null"))
    shard = F.expr(f"place div {shard_records}").alias("shard")
    # 'place' and 'page_id' of the revisiting row; it meets its page in the writing task
    revisits = (slim.join(first, "digest").where("page_id is null or page_id <> first.page_id")
                .select(shard, "place", F.lit(None).cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
                        F.lit(None).cast("string").alias("digest"), F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url")))
    records = placed.select(shard, "place", "page_id", "url", "payload", "digest", F.lit(None).cast("bigint").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"))
    tasks = min(_TASKS, max(1, -(-placed.count() // shard_records)))
    dealt = (revisits.unionByName(records).repartitionById(tasks, F.expr(f"cast(shard % {tasks} as int)"))
             .sortWithinPartitions("place", F.col("payload").isNotNull()).drop("shard"))
    temp = f"{folder}/_temporary-{uuid.uuid4().hex}"
    dealt.mapInArrow(_writer(folder, shard_records, roll_bytes, date), MANIFEST).write.parquet(temp)
    scratch.drop("sorted")
    files.rename(jvm.org.apache.hadoop.fs.Path(temp), manifest)
    files.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary"), True)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after another."""
    z, whole, data = zlib.decompressobj(31), [], stream.read(_READ)
    while data:
        whole.append(z.decompress(data))
        data = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(whole)
            z, whole = zlib.decompressobj(31), []
        data = data or stream.read(_READ)
    if whole:
        raise ValueError("the last record is cut off")


def parsed(data: bytes) -> tuple[dict, bytes]:
    """A record's header fields and block; lengths and the block's digest are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    n = int(fields["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"bad record {fields.get('WARC-Record-ID')}")
    return fields, block


def page(fields: dict, block: bytes) -> tuple:
    """A response's or revisit's ``RECORD``: length and digest are those of the
    payload read, for a revisit those that its headers carry."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda k: int(fields[k]) if k in fields else None
    size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    if fields["WARC-Type"] == "revisit":
        payload = None
    elif size != len(payload) or digest != hashlib.sha256(payload).hexdigest():
        raise ValueError(f"bad payload of {fields['WARC-Record-ID']}")
    return number("X-Page-Id"), fields.get("WARC-Target-URI"), fields["WARC-Type"], size, digest, number("X-Refers-To-Page-Id"), fields["WARC-Record-ID"], payload


def _reader(folder: str, with_payload: bool):
    schema = pa.schema([(c, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in RECORD.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_at(folder)
        for b in batches:
            for name, records in zip(b.column("file").to_pylist(), b.column("records").to_pylist()):
                rows, size, seen = [], 0, 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for data in members(f):
                        fields, block = parsed(data)
                        if fields["WARC-Type"] not in ("response", "revisit"):
                            continue
                        row = page(fields, block)
                        rows.append(row if with_payload else (*row[:-1], None))
                        seen, size = seen + 1, size + 200 + (len(row[-1] or b"") if with_payload else 0)
                        if size >= _BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{name} holds {seen} records, the manifest says {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all files in the manifest, ``RECORD``; lengths, digests
    and the number of records are checked.  Files are dealt by number, so that
    many tasks read them; without ``with_payload`` payloads are checked but not kept."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file", "records")
    return files.repartition(min(_TASKS, max(1, files.count())), "file").mapInArrow(_reader(folder, with_payload), RECORD)
