"""WARC archives: a writer with revisit records and a splittable reader.

The writer makes one gzip member for each record. A task writes a file of its
own in the shared folder, under a name that no other attempt uses, and returns
the names of what it wrote; only rows of attempts that succeed reach the
manifest, so files of lost or repeated attempts are never read.

Of payloads alike and long enough, the page with the largest id is written as
response and the others as revisits of it. That is decided from small rows of
digest and length, and revisits are written from these rows alone. Payloads stay
where they are read: a Bloom filter of the repeated digests tells which pages
can be written at once, a second one of the pages to be written after all leaves
hardly more than these to be shuffled and confirmed.

The reader cuts each file into byte ranges, one or a few for each task. A task
scans its range for the gzip magic, takes a candidate as a member if its first
bytes decode to the head of a WARC record, and owns the members that start inside
the range; the last one may end beyond it. Between members it goes from one to
the next. Content is unpacked by parts: without payloads a task holds one block
of input and one of output, with them also the record it reads.

Defined results: a null payload is empty; a null url is written as the record's
own URN. Rows repeated with the largest id are responses each. A page without an
id that repeats another's payload revisits it; if no page with the payload has
an id, all are responses. An empty table writes no file and reads no rows. A
member may hold several records; each is a row. Of a damaged member, or a record
whose head makes no sense, what was read before is returned, then a row with
``error`` alone, and the scan goes on behind it. Uncompressed archives have no
magic to be found by and give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import bloom, kernel
from quillmark.llm.native import Columns
from quillmark.llm.storage import Scratch, ship

MIN_REVISIT_BYTES = 1000
RANGE_BYTES = 64 << 20
#: More tasks than this get several ranges each.
MAX_TASKS = 100_000
_BLOCK = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_DATE = "2024-01-01T00:00:00Z"
_HEAD = 4096
_MAX_HEAD = 1 << 20
_SCHEMA = "path string, offset long, in_member int, record_type string, record_id string, target_uri string, payload_bytes long, payload_digest string, refers_to string, payload binary, error string"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system and a path in it, for URIs as Spark gives them."""
    if re.match(r"[a-z][a-z0-9+.-]*:/(?!/)", path):
        path = path.replace(":/", ":///", 1)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _urn(page) -> str:
    return f"<urn:x-page:{page}>"


def _base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(page, url: str | None, size: int, digest: str, payload: bytes | None, refers_to=None) -> bytes:
    """One gzip member. Without ``payload`` it is a revisit of ``refers_to``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if payload is None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else _urn(page)[1:-1]
    head = [
        "WARC/1.1",
        "WARC-Type: " + ("revisit" if payload is None else "response"),
        f"WARC-Record-ID: {_urn(page)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if payload is None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_urn(refers_to)}")
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    whole = ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


_WRITTEN = "path string, length long, page {kind}, url string, digest string, payload binary"


class _File:
    """The archive of one task, made when the first record comes."""

    def __init__(self, folder: str) -> None:
        self.name, self.folder, self.sink = f"{folder}/{uuid.uuid4().hex}.warc.gz", folder, None

    def put(self, member: bytes) -> None:
        if self.sink is None:
            self.fs, self.path = _open(self.name)
            self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
            self.sink = self.fs.open_output_stream(self.path, compression=None)
        self.sink.write(member)

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()

    def length(self) -> int | None:
        return self.fs.get_file_info(self.path).size if self.sink is not None else None


def _write(folder: str, kind: pa.DataType, least: int = 0, repeated=None, wanted=None):
    """Rows (page, url, digest, size, keeper, by digest, by page and digest, payload) to records.

    Rows that may repeat others go through if they may be wanted, or else are
    left out: their revisit is written from its small row.
    """
    names = ["path", "length", "page", "url", "digest", "payload"]
    kinds = [pa.string(), pa.int64(), kind, pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _File(folder)
        try:
            for batch in kernel.slices(batches, 7, 4 << 20):
                here = pa.array([True] * batch.num_rows)
                if repeated is not None:
                    again = _in(repeated, batch.column(5)) & (batch.column(3).to_numpy() >= least)
                    later = again & _in(wanted, batch.column(6))
                    here = pa.array(~again)
                    if later.any():
                        part = batch.filter(pa.array(later))
                        nothing = [pa.nulls(part.num_rows, k) for k in kinds[:2]]
                        yield pa.RecordBatch.from_arrays([*nothing, part.column(0), part.column(1), part.column(2), part.column(7)], names)
                rows = batch.filter(here)
                for page, url, digest, size, keeper, _, _, payload in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    out.put(record(page, url, size, digest, payload or b"") if keeper is None else record(page, url, size, digest, None, keeper))
        finally:
            out.close()
        if out.sink is not None:
            nothing = [pa.nulls(1, k) for k in kinds[2:]]
            yield pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([out.length()], pa.int64()), *nothing], names)

    return run


def _in(sent: tuple, hashes: pa.Array):
    """Which of the hashes a filter, as (broadcast, bits), may hold."""
    return bloom.lookup(sent[0].value, sent[1], hashes.to_numpy(zero_copy_only=False))


def write(pages: DataFrame, folder: str, scratch: Scratch, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` to ``folder``; returns the manifest (path, length)."""
    ship(pages.sparkSession)
    given = Columns(pages)
    kind = given.kind("page_id")
    rows = given.frame.select(given["page_id"].alias("page"), given["url"].cast("string").alias("url"), F.coalesce(given["html"].cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload").cast("long"))
    # who revisits whom, from small rows
    keys = scratch.table(rows.where(F.col("size") >= least).select("page", "url", "digest", "size"), "keys")
    keepers = keys.groupBy("digest", "size").agg(F.max("page").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
    keepers = scratch.table(keepers.select("digest", "size", "keeper"), "keepers")
    by_digest, by_page = F.xxhash64("digest"), F.xxhash64("page", "digest")
    nobody = F.lit(None).cast(kind)
    every = rows.select("page", "url", "digest", "size", nobody.alias("keeper"), by_digest.alias("x"), by_page.alias("y"), "payload")
    wide = pages.select("page_id").limit(0).toArrow().schema.field(0).type
    schema = _WRITTEN.format(kind=kind)
    repeated = bloom.Bloom(keepers.select(by_digest.alias("h")))
    if not repeated.n:
        return scratch.table(every.mapInArrow(_write(folder, wide), schema).select("path", "length"), "manifest")
    revisits = keys.join(keepers, ["digest", "size"]).where("not page <=> keeper")
    # pages that the filter takes for repeated ones and that are written with their payload
    false = bloom.filtered(keys.select(by_digest.alias("h"), "page", "digest"), repeated, f"h long, page {kind}, digest string").drop("h").join(keepers, "digest", "left_anti")
    wanted = scratch.table(keepers.select(F.col("keeper").alias("page"), "digest").union(false.select("page", "digest")).distinct(), "wanted")
    chosen = bloom.Bloom(wanted.select(by_page.alias("h")))
    sent = [(b.sent, b.bits) for b in (repeated, chosen)]
    first = scratch.table(every.mapInArrow(_write(folder, wide, least, *sent), schema), "first")
    late = first.where("path is null").select("page", "url", "digest", "payload")
    sure = wanted.select(F.col("page").alias("page2"), F.col("digest").alias("digest2"))
    late = late.join(sure, F.col("page").eqNullSafe(F.col("page2")) & (F.col("digest") == F.col("digest2")), "left_semi")
    late = late.select("page", "url", "digest", F.length("payload").cast("long").alias("size"), nobody.alias("keeper"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "payload")
    again = revisits.select("page", "url", "digest", "size", "keeper", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(None).cast("binary").alias("payload"))
    rest = late.union(again).mapInArrow(_write(folder, wide), schema)
    return scratch.table(first.where("path is not null").select("path", "length").union(rest.select("path", "length")), "manifest")


class _Range:
    """Bytes of a file from an offset on, read by blocks; ``at`` is where it stands in the file."""

    def __init__(self, source, at: int) -> None:
        self.source, self.data, self.pos, self.at = source, b"", 0, at
        source.seek(at)

    def move(self, to: int) -> None:
        """Stands at ``to``, wherever that is."""
        self.data, self.pos, self.at = b"", 0, to
        self.source.seek(to)

    def more(self) -> bool:
        part = self.source.read(_BLOCK)
        self.data, self.pos = self.data[self.pos :] + part, 0
        return bool(part)

    def left(self) -> int:
        return len(self.data) - self.pos

    def skip(self, n: int) -> None:
        self.pos += n
        self.at += n

    def take(self) -> bytes:
        """The next bytes, none at the file's end."""
        if not self.left() and not self.more():
            return b""
        out = self.data[self.pos : self.pos + (1 << 16)]
        self.skip(len(out))
        return out


class _Content:
    """What the member that starts where the range stands unpacks to, by parts."""

    def __init__(self, source: _Range) -> None:
        self.source, self.unpack, self.data = source, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Takes one more part in; no more at the member's end, and the range then stands there."""
        while not self.unpack.eof:
            raw = self.unpack.unconsumed_tail or self.source.take()
            if not raw:
                raise ValueError("the file ends inside a member")
            part = self.unpack.decompress(raw, _BLOCK)
            if self.unpack.eof:
                self.source.skip(-len(self.unpack.unused_data))
            if part:
                self.data += part
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What comes before ``mark``, which is passed over."""
        while (i := self.data.find(mark)) < 0:
            if len(self.data) > _MAX_HEAD:
                raise ValueError("a record's head has no end")
            if not self.more():
                raise ValueError("a member ends inside a record's head")
        out, self.data = self.data[:i], self.data[i + len(mark) :]
        return out

    def parts(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes."""
        while n:
            if not self.data and not self.more():
                raise ValueError("a member ends inside a record")
            part, self.data = self.data[:n], self.data[n:]
            n -= len(part)
            yield part

    def ended(self) -> bool:
        """Whether only line breaks are left."""
        while True:
            self.data = self.data.lstrip(b"\r\n")
            if self.data or not self.more():
                return not self.data


def _is_member(data: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(data, 16).startswith(b"WARC/")
    except zlib.error:
        return False


def _starts(source: _Range, end: int) -> Iterator[int]:
    """Stands at each member that starts before ``end``; other bytes are passed over."""
    while source.at < end:
        while source.left() < _HEAD and source.more():
            pass
        i = source.data.find(_MAGIC, source.pos)
        if i < 0:
            if source.left() < _HEAD:
                return  # the file ends
            source.skip(source.left() - len(_MAGIC) + 1)
        elif i > source.pos:
            source.skip(i - source.pos)
        elif _is_member(source.data[source.pos : source.pos + _HEAD]):
            yield source.at
        else:
            source.skip(1)


def _digest_of(said: str) -> str | None:
    """A digest in bare lower-case hex, as far as it can be read."""
    value = said.rpartition(":")[2]
    try:
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower() or None
    except ValueError:
        return value


def _record(content: _Content, with_payload: bool) -> tuple:
    """(type, id, uri, payload's bytes, its digest, refers to, payload) of the record that comes next."""
    version, *lines = content.until(b"\r\n\r\n").split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("a record doesn't start with WARC/")
    fields: dict[bytes, str] = {}
    for line in lines:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    said = fields.get(b"content-length", "")
    if not re.fullmatch("[0-9]{1,18}", said):
        raise ValueError(f"Content-Length is {said[:40]!r}")
    http = b"" if fields.get(b"content-type", "").startswith("application/http") else None
    sha, size, kept = hashlib.sha1(), 0, []
    for part in content.parts(int(said)):
        if http is not None and b"\r\n\r\n" not in http:
            # the head of the answer may come in parts
            http += part
            if b"\r\n\r\n" not in http:
                continue
            http, _, part = http.partition(b"\r\n\r\n")
            http += b"\r\n\r\n"
        sha.update(part)
        size += len(part)
        if with_payload:
            kept.append(part)
    kind = fields.get(b"warc-type")
    about = kind, fields.get(b"warc-record-id"), fields.get(b"warc-target-uri")
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length:\s*(\d{1,18})", http or b"") if not size else None
        return *about, int(length[1]) if length else None, _digest_of(fields.get(b"warc-payload-digest", "")), fields.get(b"warc-refers-to"), None
    return *about, size, sha.hexdigest(), fields.get(b"warc-refers-to"), b"".join(kept) if with_payload else None


def _members(source: _Range, end: int, with_payload: bool) -> Iterator[tuple]:
    """(offset, number in the member, type, ..., payload, error) of each record of the members that start before ``end``."""
    for offset in _starts(source, end):
        n = 0
        try:
            content = _Content(source)
            while not content.ended():
                yield offset, n, *_record(content, with_payload), None
                n += 1
        except (ValueError, zlib.error) as why:
            yield offset, n, *[None] * 7, str(why)
            source.move(offset + 1)


def _read(with_payload: bool):
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, place = _open(path)
                with fs.open_input_file(place) as f:
                    rows, size = [], 0
                    for row in _members(_Range(f, start), end, with_payload):
                        rows.append((path, *row))
                        size += 500 + len(row[-2] or b"")
                        if size > 8 << 20:
                            yield rows_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield rows_of(rows)

    return run


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files Spark finds under ``path``; contents aren't read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def read(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """One row for each record in the gzip members of ``files(path, length)``, and one with ``error`` for each damaged member."""
    ship(files.sparkSession)
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = files.select("path", at.alias("start"), "length").select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("end"))
    # ranges are the unit of work: as many tasks, which adaptive execution doesn't merge for their few bytes
    tasks = min(max(1, ranges.count()), MAX_TASKS)
    return ranges.repartitionByRange(tasks, "path", "start").mapInArrow(_read(with_payload), _SCHEMA)


def op8(spark, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    manifest = write(pages, f"{scratch.path}/archives", scratch)
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return read(manifest, with_payload=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


OP8_SQL = """
with p as (select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n from pages),
k as (select html, max(page_id) as keeper from p where n >= 1000 group by html)
select page_id, n::bigint as payload_bytes, sha1(p.html) as payload_digest,
       case when keeper <> page_id then 'revisit' else 'response' end as record_type,
       case when keeper <> page_id then keeper end as refers_to
from p left join k on p.html = k.html and n >= 1000
"""
