"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC.

``write_arc`` puts pages into ARC files; ``convert`` turns any ARC files into WARC files; ``read_warc`` reads WARC files.
All three work record by record on streams, each record its own gzip member, so memory is one record.

The converter reads the version block of a file for the names of the header fields, then header line after header line,
each followed by the declared number of bytes. From these it makes for every record a WARC identifier (from the record's
key and digest, so the same in every run), a WARC date, a media type, a payload digest and a type: of records with equal
payloads of at least ``least`` bytes the one with the largest key is a response and the others revisit it; all
others are responses. Equal payloads are found by SHA-256 in a grouping with partial results, so a payload that most
records share does not meet in one task; payloads never leave their files for that.

Every file is read, and every WARC file written, by a task of its own. Tasks write files under names of their own attempt; only files of committed rows are read again.

Defined cases: a null payload is empty; a null or empty URL is about:blank, white space and controls in a URL are percent
encoded; a null key is written without a key and sorts below all others; records that repeat key and payload are one
response and revisits of it; other columns are ignored; an empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tidemark.llm.storage import attempt_file, create, open_stream, saved
from tidemark.session import new_folder

#: Fixed values of the ARC format: the fields of a header line in versions 1 and 2.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
KEY_HEADER = b"X-Archive-Key"
LEAST = 1000
_CHUNK = 1 << 16
#: Rows about records that a task hands on at once.
ROWS_AT_ONCE = 10_000


# Streams of gzip members


class MemberWriter:
    """Each write is a gzip member of its own."""

    def __init__(self, out):
        self._out, self.at = out, 0

    def write(self, *parts: bytes) -> None:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = b"".join([*map(pack.compress, parts), pack.flush()])
        self._out.write(data)
        self.at += len(data)


class MemberReader:
    """Lines and byte counts from a file of gzip members, or from a plain file."""

    def __init__(self, stream):
        self._stream, self._raw, self._text, self._at = stream, stream.read(_CHUNK), bytearray(), 0
        self._plain = self._raw[:2] != b"\x1f\x8b"
        self._unpack = None

    def _more(self) -> bool:
        """Append some bytes; False at the end."""
        if self._at > _CHUNK:
            del self._text[: self._at]
            self._at = 0
        while True:
            if not self._raw:
                self._raw = self._stream.read(_CHUNK)
                if not self._raw:
                    if self._unpack is not None:
                        raise EOFError("the file ends inside a gzip member")
                    return False
            if self._plain:
                self._text += self._raw
                self._raw = b""
                return True
            if self._unpack is None:
                self._unpack = zlib.decompressobj(31)
            data = self._unpack.decompress(self._raw)
            self._raw = b""
            if self._unpack.eof:
                self._raw, self._unpack = self._unpack.unused_data, None
            if data:
                self._text += data
                return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        seen = self._at
        while (end := self._text.find(b"\n", seen)) < 0:
            seen = len(self._text) - self._at
            if not self._more():
                if len(self._text) == self._at:
                    return None
                end = len(self._text)
                break
            seen += self._at
        found = bytes(self._text[self._at : end])
        self._at = min(end + 1, len(self._text))
        return found.rstrip(b"\r")

    def take(self, count: int) -> bytes:
        while len(self._text) - self._at < count:
            if not self._more():
                raise EOFError("a record is shorter than declared")
        found = bytes(self._text[self._at : self._at + count])
        self._at += count
        return found


# ARC


def _clean_url(url: str | None) -> bytes:
    raw = (url or "about:blank").encode("utf-8", "surrogatepass")
    return b"".join(b"%%%02X" % c if c <= 0x20 or c == 0x7F else bytes([c]) for c in raw)


def arc_header(version: int, url: bytes, date: str, media: str, length: int, offset: int = 0, file: str = "-") -> bytes:
    tail = f" 200 - - {offset} {file} {length}" if version == 2 else f" {length}"
    return url + f" 0.0.0.0 {date} {media}".encode() + tail.encode() + b"\n"


def arc_version_block(version: int, date: str) -> bytes:
    body = f"{version} 0 tidemark\n{ARC_FIELDS[version]}\n\n".encode()
    return arc_header(version, b"filedesc://archive.arc", date, "text/plain", len(body)) + body + b"\n"


def http_block(key: int | None, payload: bytes) -> bytes:
    """A stored answer; the key is one of its header fields."""
    named = b"" if key is None else b"%s: %d\r\n" % (KEY_HEADER, key)
    return (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n%s\r\n" % (len(payload), named)
        + payload
    )


def write_arc(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", versions: tuple[int, ...] = (1, 2),
    date: str = "19980101000000",
) -> DataFrame:
    """One ARC file per task, versions in turn; the files written, with their number of records."""
    folder = new_folder(pages.sparkSession, "arc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version = versions[part % len(versions)]
        file, out, members, count = attempt_file(folder, f"part-{part:06d}", ".arc.gz"), None, None, 0
        for batch in batches:
            for k, u, body in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if out is None:
                    out = create(file)
                    members = MemberWriter(out)
                    members.write(arc_version_block(version, date))
                block = http_block(k, (body.as_py() or "").encode("utf-8", "surrogatepass"))
                members.write(arc_header(version, _clean_url(u.as_py()), date, "text/html", len(block), members.at), block, b"\n")
                count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [file], "records": pa.array([count], pa.int64())})

    rows = pages.select(pages[key].cast("long").alias("k"), pages[url].cast("string").alias("u"), pages[payload].cast("string").alias("p"))
    return saved(rows.mapInArrow(write, "file string, records long"), "arc-files")


def read_arc(stream) -> Iterator[tuple[dict[str, bytes], bytes]]:
    """(header fields by name, block) of every record after the version block."""
    reader = MemberReader(stream)
    first = reader.line()
    if first is None:
        return
    if not first.startswith(b"filedesc:"):
        raise ValueError("not an ARC file: it does not start with a version block")
    about = reader.take(int(first.rsplit(b" ", 1)[1])).split(b"\n")
    names = about[1].decode().split(" ") if len(about) > 1 else []
    if names not in [f.split(" ") for f in ARC_FIELDS.values()]:
        raise ValueError("not an ARC file of version 1 or 2")
    while (line := reader.line()) is not None:
        if not line:  # the line end after a record
            continue
        values = line.split(b" ")
        if len(values) != len(names):
            raise ValueError(f"a header line has {len(values)} fields where the version has {len(names)}")
        header = dict(zip(names, values, strict=True))
        yield header, reader.take(int(header["Archive-length"]))


def split_http(block: bytes) -> tuple[bytes, bytes, dict[bytes, bytes]]:
    """(head with its empty line, payload, fields) of a stored answer; a block without a status line is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block, {}
    head, mark, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    return head + mark, payload, fields


# WARC


def warc_date(arc_date: bytes) -> str:
    """YYYYMMDDhhmmss, cut short in early files, as a WARC date."""
    known = arc_date.decode()[:14]
    known += "00000101000000"[len(known) :]
    return datetime.strptime(known, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(key: int | None, sha1: bytes) -> str:
    """The same record gets the same identifier in every run."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(b'%r/%s' % (key, sha1)).digest()[:16], version=5)}>"


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> tuple[bytes, bytes, bytes]:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogateescape") + b"\r\n", block, b"\r\n\r\n"


def _key_of(fields: dict[bytes, bytes]) -> int | None:
    return int(fields[KEY_HEADER]) if KEY_HEADER in fields else None


def _one_task_each(files: DataFrame) -> tuple[DataFrame, int]:
    """(file, file_nr) with a task for every file, and their number. The list, one short row a file, is ordered once."""
    listed = saved(
        files.select("file").distinct().select("file", (F.row_number().over(Win.orderBy("file")) - 1).alias("file_nr")), "file-list"
    )
    count = listed.count()
    return listed.repartitionById(max(count, 1), F.col("file_nr")), count


def _in_parts(rows: Iterator[tuple], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    while part := list(islice(rows, ROWS_AT_ONCE)):
        columns = [pa.array(c, kind) for c, kind in zip(zip(*part, strict=True), kinds.values(), strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=list(kinds))


def describe_arc(files: DataFrame) -> tuple[DataFrame, int]:
    """One row per ARC record: file, file_nr, nr, key, payload_bytes, sha256, uri, date; and the number of files."""
    kinds = {
        "file": pa.string(), "file_nr": pa.int32(), "nr": pa.int64(), "key": pa.int64(), "payload_bytes": pa.int64(),
        "sha256": pa.binary(), "uri": pa.string(), "date": pa.string(),
    }

    def records(file: str, file_nr: int) -> Iterator[tuple]:
        with open_stream(file) as stream:
            for nr, (header, block) in enumerate(read_arc(stream)):
                _, payload, fields = split_http(block)
                uri = header["URL"].decode("utf-8", "replace")
                yield file, file_nr, nr, _key_of(fields), len(payload), hashlib.sha256(payload).digest(), uri, warc_date(header["Archive-date"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, file_nr in zip(*(c.to_pylist() for c in batch.columns)):
                yield from _in_parts(records(file, file_nr), kinds)

    one_each, count = _one_task_each(files)
    schema = "file string, file_nr int, nr long, key long, payload_bytes long, sha256 binary, uri string, date string"
    return one_each.mapInArrow(describe, schema), count


def decide(records: DataFrame, least: int = LEAST) -> DataFrame:
    """``records`` with ``revisits`` (key, uri and date of the response, for revisits) and ``is_revisit``."""
    mine = F.struct("key", "file", "nr", "uri", "date")
    top = (
        records.filter(F.col("payload_bytes") >= least)
        .groupBy("sha256")
        .agg(F.max(mine).alias("top"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(F.col("sha256").alias("_sha"), "top")
    )
    joined = records.join(top, F.col("sha256") == F.col("_sha"), "left")
    other = F.col("top").isNotNull() & ~((F.col("top.file") == F.col("file")) & (F.col("top.nr") == F.col("nr")))
    response = F.struct(F.col("top.key").alias("key"), F.col("top.uri").alias("uri"), F.col("top.date").alias("date"))
    return joined.select("file", "file_nr", "nr", other.alias("is_revisit"), F.when(other, response).alias("revisits"))


def convert(files: DataFrame, least: int = LEAST) -> DataFrame:
    """WARC files of the ARC files; one row per WARC file: file, records."""
    folder = new_folder(files.sparkSession, "warc")
    described, count_of_files = describe_arc(files)
    records = saved(described, "arc-records")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        target, out, members, count = attempt_file(folder, f"part-{part:06d}", ".warc.gz"), None, None, 0
        name, source, arc, at = None, None, None, -1
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name, source, at = row["file"], open_stream(row["file"]), -1
                    arc = read_arc(source)
                while at < row["nr"]:
                    header, block = next(arc)
                    at += 1
                if out is None:
                    out = create(target)
                    members = MemberWriter(out)
                    members.write(*_warcinfo(part, warc_date(header["Archive-date"])))
                members.write(*_converted(header, block, row["is_revisit"], row["revisits"]))
                count += 1
        if source is not None:
            source.close()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [target], "records": pa.array([count], pa.int64())})

    by_file = decide(records, least).repartitionById(max(count_of_files, 1), F.col("file_nr")).sortWithinPartitions("file", "nr")
    return saved(by_file.mapInArrow(write, "file string, records long"), "warc-files")


def _warcinfo(part: int, date: str) -> tuple[bytes, bytes, bytes]:
    """The first record of a file: of the date of its first page, so the same in every run."""
    return _warc_record(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(b'warcinfo/%d' % part).digest()[:16], version=5)}>"),
            ("WARC-Date", date),
            ("Content-Type", "application/warc-fields"),
        ],
        b"software: tidemark\r\nformat: WARC File Format 1.1\r\n",
    )


def _converted(header: dict[str, bytes], block: bytes, is_revisit: bool, revisits: dict | None) -> tuple[bytes, bytes, bytes]:
    head, payload, fields = split_http(block)
    sha1 = hashlib.sha1(payload).digest()
    stored = [
        ("WARC-Type", "revisit" if is_revisit else "response" if head else "resource"),
        ("WARC-Record-ID", record_id(_key_of(fields), sha1)),
        ("WARC-Date", warc_date(header["Archive-date"])),
        ("WARC-Target-URI", header["URL"].decode("utf-8", "surrogateescape")),
        ("WARC-IP-Address", header["IP-address"].decode()),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
        ("Content-Type", "application/http; msgtype=response" if head else header["Content-type"].decode()),
    ]
    if is_revisit:
        stored.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        stored.append(("WARC-Refers-To", record_id(revisits["key"], sha1)))
        stored.append(("WARC-Refers-To-Target-URI", revisits["uri"]))
        stored.append(("WARC-Refers-To-Date", revisits["date"]))
        if revisits["key"] is not None:
            stored.append(("X-Refers-To-Key", str(revisits["key"])))
    kept = head if is_revisit else block
    stored.append(("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(kept).digest()).decode()))
    return _warc_record(stored, kept)


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record."""
    reader = MemberReader(stream)
    while (line := reader.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while line := reader.line():
            name, _, value = line.decode("utf-8", "surrogateescape").partition(": ")
            fields[name] = value
        yield fields, reader.take(int(fields["Content-Length"]))


def read_warc(files: DataFrame) -> DataFrame:
    """One row per response, resource and revisit: page_id, payload_bytes, payload_digest, record_type, refers_to, url, record_id.

    Payloads are hashed again and compared with their record's digest.
    """

    kinds = {
        "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
        "refers_to": pa.int64(), "url": pa.string(), "record_id": pa.string(),
    }

    def records(file: str) -> Iterator[tuple]:
        with open_stream(file) as stream:
            for fields, block in warc_records(stream):
                kind = fields["WARC-Type"]
                if kind == "warcinfo":
                    continue
                if hashlib.sha1(block).digest() != base64.b32decode(fields["WARC-Block-Digest"].removeprefix("sha1:")):
                    raise ValueError(f"{fields['WARC-Record-ID']}: the block is not that of its digest")
                _, payload, http = split_http(block)
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                size = len(payload)
                if kind == "revisit":
                    size = int(http[b"Content-Length"])
                elif hashlib.sha1(payload).digest() != digest:
                    raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not that of its digest")
                refers = fields.get("X-Refers-To-Key")
                url = fields["WARC-Target-URI"].encode("utf-8", "surrogateescape").decode("utf-8", "replace")
                yield _key_of(http), size, digest.hex(), kind, None if refers is None else int(refers), url, fields["WARC-Record-ID"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                yield from _in_parts(records(file), kinds)

    return _one_task_each(files)[0].mapInArrow(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string",
    )
