"""Archives: exact round trips, the same bytes under any partitioning, revisits against brute force."""
import gzip
import hashlib
import os
import uuid
from collections import defaultdict

import pytest

from arrears.llm import warc
from arrears.llm.common import Scratch
from arrears.llm.queries import QUERIES
from tests.llm.conftest import SMALL, odd_pages


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) of (page_id, html) rows."""
    groups, out = defaultdict(list), []
    for i, html in rows:
        groups[html or ""].append(i)
    for i, html in rows:
        data = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        again = len(data) >= 100 and bool(ids) and i != min(ids)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=str)


def wrote(spark, pages, folder, **kw):
    warc.write_archives(pages, folder, Scratch(spark, "t"), **kw)
    names = sorted(x for x in os.listdir(folder) if x.endswith(".gz"))
    return {n: open(f"{folder}/{n}", "rb").read() for n in names}


def query_rows(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=str)


def test_query_on_driver_table(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert query_rows(QUERIES["op11_warc"](spark, SMALL)) == brute(pages)


def test_odd_rows_come_back(spark, odd_files, tmp_path):
    pages = odd_pages(spark)
    rows = [(r.page_id, r.html) for r in pages.collect()]
    assert query_rows(QUERIES["op11_warc"](spark, odd_files)) == brute(rows)
    warc.write_archives(pages, str(tmp_path / "a"), Scratch(spark, "t"))
    back = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted(((r.page_id, bytes(r.payload)) for r in back if r.record_type == "response"), key=str) == sorted(
        ((i, (h or "").encode()) for (i, h), b in zip(sorted(rows, key=lambda r: str(r[0])), range(99)) if ((i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "response", None) in brute(rows))), key=str)
    assert len({r.record_id for r in back}) == len(back) == len(rows)
    assert {r.url for r in back if r.page_id == 2} == {"http://b.example/%C3%A4%20b%0D%0AX:%201"}


@pytest.mark.parametrize("shard_records,roll", [(8192, 1 << 22), (50, 1 << 22), (70, 20_000), (1, 1)])
def test_same_bytes_under_any_partitioning(spark, tmp_path, shard_records, roll):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").limit(120).unionByName(odd_pages(spark).select("page_id", "url", "html"))
    one = wrote(spark, pages.coalesce(1), str(tmp_path / "a"), shard_records=shard_records, roll_bytes=roll)
    many = wrote(spark, pages.repartition(7, "html"), str(tmp_path / "b"), shard_records=shard_records, roll_bytes=roll)
    assert one == many
    files = {r.file: r for r in spark.read.parquet(str(tmp_path / "a/manifest")).collect()}
    assert files.keys() == one.keys()
    for name, data in one.items():
        assert (files[name].bytes, files[name].sha256) == (len(data), hashlib.sha256(data).hexdigest())
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        last = max(len(warc.member({}, b"")), 1 << 20)
        assert len(data) < roll + last
    assert sum(r.records for r in files.values()) == pages.count()
    if roll == 1:
        assert all(r.records == 1 for r in files.values())


def test_members_are_gzip_of_records(spark, tmp_path):
    data = warc.record(3, 7, "http://a.example/", b"<p>" * 50, hashlib.sha256(b"<p>" * 50).hexdigest(), None, None, warc.DATE)
    assert data == warc.record(3, 7, "http://a.example/", b"<p>" * 50, hashlib.sha256(b"<p>" * 50).hexdigest(), None, None, warc.DATE)
    fields, block = warc.parsed(gzip.decompress(data))
    assert fields["WARC-Type"] == "response" and block.endswith(b"<p>" * 50) and int(fields["Content-Length"]) == len(block)
    uuid.UUID(fields["WARC-Record-ID"][1:-1])


def test_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "a")
    files = wrote(spark, spark.read.parquet(f"{SMALL}/pages.parquet"), folder)
    name, data = next(iter(files.items()))
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data[:len(data) // 2])
    with pytest.raises(Exception, match="cut off|bad|manifest|invalid"):
        warc.read_archives(spark, folder).collect()
    with pytest.raises(FileExistsError):
        warc.write_archives(odd_pages(spark), folder, Scratch(spark, "t"))


def test_a_repeated_task_replaces_its_file(spark, tmp_path):
    folder = str(tmp_path / "a")
    os.makedirs(folder)
    with open(f"{folder}/shard-00000000-0000.warc.gz", "wb") as f:
        f.write(b"left by an attempt that was lost")
    files = wrote(spark, odd_pages(spark), folder)
    assert list(files) == ["shard-00000000-0000.warc.gz"] and warc.read_archives(spark, folder).count() == odd_pages(spark).count()
    assert not [x for x in os.listdir(folder) if x.startswith("_temporary")]


def test_paths_of_stores():
    assert warc.store_at("file:/a/b")[1] == "/a/b" and warc.store_at("/a/b")[1] == "/a/b"
