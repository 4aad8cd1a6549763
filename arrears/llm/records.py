"""Token ids as length-delimited binary records with a separate index.

A record file is a run of frames.  A frame is the payload's length (64 bits),
the masked CRC-32 of those eight bytes, the payload, and its masked CRC-32,
all little-endian; the mask turns the checksum right by 15 bits and adds a
constant, so that checksums of data that holds checksums stay sound.  A
payload is a header (width of an id in bytes, whether the document has an id,
the id) and the token ids.  Beside ``part-N.rec`` lies ``part-N.idx``, the 64-bit
offset of every frame, which lets a reader take records in any order.

Documents are dealt by range of their id, so file after file holds them in
ascending order; each task writes its own file under a temporary name and then
renames it, and a second attempt writes the same bytes again.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import Scratch
from arrears.llm.shingles import pieces
from arrears.llm.tokens import Encoder

MASK = 0xA282EAD8
_HEADER = struct.Struct("<BBq")
_READ = 8 << 20

FILES = "part int, path string, n_docs bigint, n_tokens bigint, n_bytes bigint"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(f, offset: int) -> tuple[bytes, int]:
    """The payload of the frame at ``offset`` of an open file, and the next offset."""
    f.seek(offset)
    head = f.read(12)
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError(f"bad length at {offset}")
    n = struct.unpack("<Q", head[:8])[0]
    body = f.read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
        raise ValueError(f"bad record at {offset}")
    return body[:n], offset + 16 + n


def payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _HEADER.pack(width, doc_id is not None, doc_id or 0) + ids


def parsed(data: bytes) -> tuple[int | None, np.ndarray]:
    width, known, doc_id = _HEADER.unpack_from(data)
    return doc_id if known else None, np.frombuffer(data, f"<u{width}", offset=_HEADER.size)


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path) if ":" in path else f"file://{path}")


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), Encoder.at(tokenizer)
        store, base = _at(folder)
        name, tries = f"{base}/part-{part:06d}", uuid.uuid4().hex
        end, width = np.array([end_id], encoder.dtype).tobytes(), encoder.dtype.itemsize
        offsets, tokens, at = [], 0, 0
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{name}.{tries}") as out:
            for whole in batches:
                for b in pieces(whole, "text"):
                    for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text").to_pylist())):
                        data = frame(payload(doc_id, ids + end, width))
                        out.write(data)
                        offsets.append(at)
                        at += len(data)
                        tokens += len(ids) // width + 1
        with store.open_output_stream(f"{name}.{tries}.i") as out:
            out.write(np.array(offsets, "<u8").tobytes())
        store.move(f"{name}.{tries}", f"{name}.rec")
        store.move(f"{name}.{tries}.i", f"{name}.idx")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/part-{part:06d}"]),
                                          *(pa.array([x], pa.int64()) for x in (len(offsets), tokens, at))], [c.split()[0] for c in FILES.split(", ")])
    return run


def write_records(docs: DataFrame, scratch: Scratch, tokenizer: str, end_id: int = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the record and index files and gives one row per file, ``FILES``.

    Rows are ordered by id (a null id first), then text; a null text is
    written as an empty one; repeated rows are written each.  An empty table
    gives files without records.  Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    dealt = d.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    return scratch.table(dealt.mapInArrow(_writer(scratch.path("records"), tokenizer, end_id), FILES), "files")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
            store, base = _at(path)
            with store.open_input_file(f"{base}.idx") as f:
                offsets = np.frombuffer(f.read(), "<u8")
            rows: list[tuple] = []
            with store.open_input_stream(f"{base}.rec", buffer_size=_READ) as f:
                stream = _Forward(f)
                for at in offsets.tolist():
                    doc_id, ids = parsed(unframe(stream, at)[0])
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["doc_id", "start", "n_tokens", "ids_crc32"])


class _Forward:
    """A stream read in order, with the ``seek`` that ``unframe`` asks for."""

    def __init__(self, f):
        self.f, self.at = f, 0

    def seek(self, offset: int) -> None:
        if offset != self.at:
            raise ValueError(f"the index says {offset}, the file is at {self.at}")

    def read(self, n: int) -> bytes:
        data = self.f.read(n)
        self.at += len(data)
        return data


def read_records(files: DataFrame) -> DataFrame:
    """One row per record, checksums checked: ``doc_id``, ``start`` (ids of all
    records before it), ``n_tokens``, ``ids_crc32`` (of 32-bit ids)."""
    n_files = files.count()
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    files = files.select("part", "path", F.coalesce(before, F.lit(0)).alias("start"))
    # a number given, AQE does not put the few small rows into one task: a task reads about one file
    return files.repartition(max(1, n_files), "part").mapInArrow(_reader, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def record_at(path: str, i: int) -> tuple[int | None, np.ndarray]:
    """Record ``i`` of one file, by its index alone."""
    store, base = _at(path)
    with store.open_input_file(f"{base}.idx") as f:
        f.seek(8 * i)
        at = struct.unpack("<Q", f.read(8))[0]
    with store.open_input_file(f"{base}.rec") as f:
        return parsed(unframe(f, at)[0])
