"""WARC archives through a chunked record table.

Pages become rows of (record, chunk number, bytes); a record of any size
passes through the writer and the reader as a stream of chunks of at most
``CHUNK`` bytes.  Digests grow chunk by chunk: the writer checks the running
SHA-1 against the header it wrote first, the reader carries the digest of
all bytes so far on every chunk row, so no Python task holds a whole record.

Equal payloads are stored once: the record with the largest page id is the
response, others are revisits that refer to it.  Which is which is settled
on digests alone (SHA-1, size and a second hash must agree); a payload that
a third of all pages share meets its answer spread over lanes.

Each task attempt writes files of its own name below the shared folder, and
a written manifest lists those of the attempts that count: a lost executor
leaves at most an unlisted file.

Defined results: null html is an empty payload; equal rows are all written,
and every row that carries the largest id of its payload is a response; a
null id never outranks another (if all are null, all are responses); no rows
give an empty manifest and no records; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.llm.common import lane_lookup, let, scratch_path, written

CHUNK, ROLL, LEVEL = 65_536, 256 << 20, 1
#: Bytes of chunk rows that the reader sends at once.
SEND = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY = ["sha", "n_bytes", "check"]
_CRLF = b"\r\n"


def _tags(id_col: str, payload: str) -> list[Column]:
    whole = F.coalesce(F.col(payload), F.lit(""))
    return [F.col(id_col).alias("id"), F.unhex(F.sha1(whole)).alias("sha"), F.octet_length(whole).cast("long").alias("n_bytes"), F.xxhash64(whole).alias("check")]


def chunk_table(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", chunk: int = CHUNK) -> DataFrame:
    """(id, url, KEY, refers_to, response, chunk_no, n_chunks, data): the
    chunks of a record stand together and in order; a revisit has one, empty."""
    rows = written(pages.select(*_tags(id_col, payload)), "warc-tags")
    kept = rows.groupBy(*KEY).agg(F.max("id").alias("keep"))
    told = lane_lookup(rows, kept, KEY, ["id"]).groupBy("id", *KEY).agg(F.max("keep").alias("keep"))
    match = F.col("p.id").eqNullSafe(F.col("t.id"))
    for c in KEY:
        match = match & (F.col(f"p.{c}") == F.col(f"t.{c}"))
    wide = pages.select(*_tags(id_col, payload), F.col(url).alias("url"), F.col(payload).alias("payload"))
    met = wide.alias("p").join(told.alias("t"), match).select("p.*", "t.keep").withColumn("response", F.col("id").eqNullSafe(F.col("keep")))
    count = F.greatest(F.ceil(F.col("n_bytes") / chunk), F.lit(1)).cast("int")
    records = met.select(
        "id", "url", *KEY, F.when(~F.col("response"), F.col("keep")).alias("refers_to"), "response",
        F.when(F.col("response"), count).otherwise(1).alias("n_chunks"),
        F.when(F.col("response"), F.coalesce("payload", F.lit(""))).otherwise("").cast("binary").alias("bytes"))
    # chunk numbers first, then each chunk is cut: no row and no array holds a record's chunks
    numbered = records.select("*", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
    return numbered.select(*[c for c in numbered.columns if c != "bytes"], F.substring("bytes", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _heads(row: dict, date: str) -> bytes:
    """WARC header and, as the start of the block, the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()
    kind = "response" if row["response"] else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(row['id'])}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {quote(row['url'] or '', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha1:{base32(row['sha'])}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + (row['n_bytes'] if row['response'] else 0)}"]
    if not row["response"]:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'])}"]
    return "\r\n".join(lines).encode() + 2 * _CRLF + http


class _Writer:
    """One archive file after another; one gzip member per record."""

    def __init__(self, folder: str, roll: int, date: str) -> None:
        self.files, base = fs.FileSystem.from_uri(folder)
        self.files.create_dir(base, recursive=True)
        self.folder, self.base, self.roll, self.date = folder, base, roll, date
        self.name, self.out, self.records, self.size = "", None, 0, 0
        self.done: list[tuple[str, int, int]] = []

    def _send(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, row: dict) -> None:
        if row["chunk_no"] == 0:
            if self.out is None:
                task = TaskContext.get()
                self.name = f"part-{task.partitionId() if task else 0:05d}-{uuid.uuid4().hex}.warc.gz"
                self.out, self.records, self.size = self.files.open_output_stream(f"{self.base}/{self.name}", compression=None), 0, 0
            self.member, self.digest = zlib.compressobj(LEVEL, wbits=31), hashlib.sha1()
            self._send(self.member.compress(_heads(row, self.date)))
        self.digest.update(row["data"])
        self._send(self.member.compress(row["data"]))
        if row["chunk_no"] + 1 == row["n_chunks"]:
            if row["response"] and self.digest.digest() != row["sha"]:
                raise ValueError(f"the chunks of {record_id(row['id'])} do not give its digest")
            self._send(self.member.compress(2 * _CRLF) + self.member.flush())
            self.records += 1
            if self.size >= self.roll:
                self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.records, self.size))
            self.out = None


def write_archives(chunks: DataFrame, folder: str, roll: int = ROLL, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the chunk table as WARC files below ``folder`` (a URI that
    pyarrow opens); the written manifest (file, n_records, n_bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    writer = writer or _Writer(folder, roll, date)
                    writer.add(row)
        if writer:
            writer.close()
            names, records, sizes = zip(*writer.done)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(records, type=pa.int64()), pa.array(sizes, type=pa.int64())], names=["file", "n_records", "n_bytes"])

    return written(chunks.mapInArrow(run, "file string, n_records long, n_bytes long"), "warc-manifest")


class _Stream:
    """Bytes of a gzip archive, a bounded piece at a time."""

    def __init__(self, source, piece: int = 1 << 18) -> None:
        self.source, self.piece, self.buffer, self.raw = source, piece, b"", b""
        self.member, self.inside = zlib.decompressobj(31), False

    def _more(self) -> bool:
        if not self.raw:
            self.raw = self.source.read(self.piece)
            if not self.raw:
                if self.inside:
                    raise ValueError("the archive ends inside a record")
                return False
        self.inside = True
        self.buffer += self.member.decompress(self.raw, self.piece)
        self.raw = self.member.unconsumed_tail
        if self.member.eof:
            self.raw, self.member, self.inside = self.member.unused_data, zlib.decompressobj(31), False
        return True

    def line(self) -> bytes | None:
        while (at := self.buffer.find(_CRLF)) < 0:
            if not self._more():
                return None
        line, self.buffer = self.buffer[:at], self.buffer[at + 2 :]
        return line

    def some(self, most: int) -> bytes:
        while not self.buffer:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        data, self.buffer = self.buffer[:most], self.buffer[most:]
        return data

    def exactly(self, size: int) -> bytes:
        parts = []
        while size:
            parts.append(self.some(size))
            size -= len(parts[-1])
        return b"".join(parts)

    def head(self) -> tuple[dict[str, str], int] | None:
        """Header lines up to the blank one, and their size in bytes."""
        fields, size = {}, 0
        while (line := self.line()) is not None:
            size += len(line) + 2
            if not line:
                return fields, size
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        return None


def read_file(source, chunk: int = CHUNK) -> Iterator[dict]:
    """Chunk rows of one archive, each with the size and digest so far."""
    stream = _Stream(source)
    while (found := stream.head()) is not None:
        warc, _ = found
        http, size = stream.head()
        left, n, digest = int(warc["Content-Length"]) - size, 0, hashlib.sha1()
        row = {"record": warc["WARC-Record-ID"], "record_type": warc["WARC-Type"], "refers_to": warc.get("WARC-Refers-To"),
               "url": warc["WARC-Target-URI"], "stated_bytes": int(http["Content-Length"]), "stated_digest": warc["WARC-Payload-Digest"].partition(":")[2]}
        number = 0
        while True:
            data = stream.exactly(min(left, chunk))
            left, n = left - len(data), n + len(data)
            digest.update(data)
            yield row | {"chunk_no": number, "data": data, "bytes_so_far": n, "digest_so_far": base32(digest.digest()), "last": left == 0}
            number += 1
            if not left:
                break
        if row["record_type"] == "response" and base32(digest.digest()) != row["stated_digest"]:
            raise ValueError(f"{warc['WARC-Record-ID']} does not have the digest that its header states")
        if stream.exactly(4) != 2 * _CRLF:
            raise ValueError(f"{warc['WARC-Record-ID']} does not end where its header says")


_READ = pa.schema([("record", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("stated_bytes", pa.int64()),
                   ("stated_digest", pa.string()), ("chunk_no", pa.int64()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_())])


def read_archives(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Chunk rows of all listed files; without ``with_data`` the bytes are
    read and digested but not returned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(name)
                with files.open_input_stream(path, compression=None) as source:
                    rows, size = [], 0
                    for row in read_file(source, chunk):
                        rows.append(row if with_data else row | {"data": None})
                        size += len(rows[-1]["data"] or b"") + 256
                        if size >= SEND:
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    files = max(1, manifest.count())
    return manifest.select("file").repartition(min(files, 20_000)).mapInArrow(run, (
        "record string, record_type string, refers_to string, url string, stated_bytes long, stated_digest string, "
        "chunk_no long, data binary, bytes_so_far long, digest_so_far string, last boolean"))


def archive(pages: DataFrame, folder: str | None = None, **names) -> DataFrame:
    """Write ``pages`` as archives (below a scratch folder unless given); the manifest."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    if folder.startswith("file:/") and not folder.startswith("file://"):  # as Spark names local folders
        folder = "file://" + folder.removeprefix("file:")
    return write_archives(chunk_table(pages, **names), folder)


def page_of(record: Column) -> Column:
    """The page id in a record id."""
    return F.regexp_extract(record, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
