"""WARC archives as a Spark data source, both ways: ``format("warc")``.

Writing: each task writes files of gzipped (or plain) records below the folder,
a new one from ``max_bytes`` on; the commit lists the files of the successful
attempts in a manifest, so a file left by a lost or repeated task is never read.

Reading: a folder with a manifest holds what this lists; of any other folder all
files named ``*.warc`` or ``*.warc.gz`` are read, also those in folders below, and
a path may name one file.  Files are planned as partitions, larger first, and
gzipped ones beyond ``split`` bytes as several: each reads the records whose gzip
member begins in its range.  (Plain files can't be entered in the middle without
taking a payload for a record, so each is one partition.)  A reader parses a
record's header block before anything else; records that the pushed-down
predicates on type and headers rule out are skipped without decoding their
payload, as are all payloads if the option ``payload`` is ``false``.

Options: ``path``; ``payload`` (default true); ``types``, a comma-separated list
of record types; ``split``; ``compression`` (gzip or none), ``level`` and
``max_bytes`` for writing. The folder may be on any file system that pyarrow
knows (local, HDFS, S3).

Defined cases: headers are read as UTF-8, or as Latin-1 where that fails, and
continued lines are joined; ``payload_length`` is that of the full payload if the
header names it, else that of the record's block. What is damaged gives a row
whose ``error`` says so, and reading goes on with the next record: ``length``, if
a record has no usable Content-Length (no payload); ``cut off``, if the file ends
within it (what there is of the payload); ``no record``, if something else stands
where a record is due, and ``gzip``, if a member can't be inflated (both without
headers, so predicates on headers rule them out). A folder without archives gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from bibweave.scratch import Scratch

SCHEMA = "record_id string, warc_type string, target_uri string, warc_date string, payload_digest string, refers_to string, payload_length long, content_type string, payload binary, error string"
MANIFEST = "_manifest.json"
#: Column -> header it is read from.
HEADERS = {"record_id": "warc-record-id", "warc_type": "warc-type", "target_uri": "warc-target-uri", "warc_date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "payload_length": "x-payload-length", "content_type": "content-type"}
#: Payloads of at least so many bytes are stored once.
MIN_REVISIT = 1000
#: Bytes from which a gzipped file is read by several tasks, and from which a new file is begun.
SPLIT, MAX_BYTES = 128 << 20, 1 << 30
#: Revisits, of some hundred bytes each, that may be broadcast.
FEW_REVISITS = 100_000
_BUFFER = 1 << 20
_MAGIC, _START = b"\x1f\x8b\x08", b"WARC/"


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{path}")


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


@dataclass
class _File(InputPartition):
    name: str
    begin: int = 0
    end: int | None = None


def record(kind: str, record_id: str, uri: str | None, date: str, payload: bytes, more: dict[str, str]) -> bytes:
    """One record; values lose control characters, which would end a header line."""
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date, **({"WARC-Target-URI": uri} if uri is not None else {}), **more, "Content-Length": str(len(payload))}
    lines = "".join(f"{k}: {''.join(c for c in v if c >= ' ')}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + payload + b"\r\n\r\n"


class _Source:
    """Plain bytes of a file from an offset on, inflating gzip members as they come."""

    def __init__(self, raw, begin: int = 0):
        self.raw, self.buffer, self.at, self.gz, self.done = raw, b"", 0, None, False
        if begin:
            raw.seek(begin)
        self.rest = raw.read(_BUFFER)
        self.packed = self.rest[:2] == _MAGIC[:2]
        self.read = begin  # bytes of the file that went into the buffer
        self.before = 0  # plain bytes before the buffer
        self.hurt: int | None = None  # where a member begins that can't be inflated
        self.members = [(0, begin)]  # where members begin: plain, in the file

    def _more(self) -> bool:
        """Adds to the buffer what is next; False at the end. Raises ``_Damaged`` once all before the damage has been handed out."""
        while not self.done:
            if self.hurt is not None:
                raise _Damaged(self.hurt)
            data, self.rest = self.rest or self.raw.read(_BUFFER), b""
            if not data:
                self.done = True
                return False
            out = [self.buffer[self.at :]]
            self.before += self.at
            have = len(out[0])
            if not self.packed:
                out.append(data)
                have += len(data)
                self.read += len(data)
            while self.packed and data:
                if self.gz is None:
                    self.gz = zlib.decompressobj(31)
                    self.members.append((self.before + have, self.read))
                try:
                    out.append(self.gz.decompress(data))
                except zlib.error:
                    self.hurt = self.members[-1][1]
                    break
                have += len(out[-1])
                left = self.gz.unused_data if self.gz.eof else b""
                self.read += len(data) - len(left)
                data = left
                if self.gz.eof:
                    self.gz = None
                    if data and not data.startswith(_MAGIC[: len(data)]):
                        data = data.lstrip(b"\0")  # padding
            self.buffer, self.at = b"".join(out), 0
            if have > len(out[0]):
                return True
        return False

    def member(self) -> int:
        """Where in the file the member begins that holds the next byte."""
        here = self.before + self.at
        while len(self.members) > 1 and self.members[1][0] <= here:
            self.members.pop(0)
        return self.members[0][1]

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.buffer.find(mark, self.at)) < 0:
            if not self._more():
                return None
        out, self.at = self.buffer[self.at : end], end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        """The next n bytes, or fewer at the end of the file."""
        while len(self.buffer) - self.at < n:
            if not self._more():
                break
        out = self.buffer[self.at : self.at + n]
        self.at += len(out)
        return out

    def skip(self, n: int) -> bool:
        """As take, without keeping; of a plain file the rest is not even read. False if the file ends before."""
        while n > (have := len(self.buffer) - self.at):
            n, self.at = n - have, len(self.buffer)
            if not self.packed and not self.rest:
                self.raw.seek(n, 1)
                self.read += n
                return True
            if not self._more():
                return False
        self.at += n
        return True

    def blanks(self) -> bool:
        """Skips line ends between records; False at the end of the file."""
        while True:
            while self.at < len(self.buffer):
                if self.buffer[self.at] not in b"\r\n":
                    return True
                self.at += 1
            if not self._more():
                return False


def _headers(head: bytes) -> dict[str, str]:
    try:
        text = head.decode("utf-8")
    except UnicodeDecodeError:
        text = head.decode("latin-1")
    out, last = {}, ""
    for line in text.split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _plain(raw, begin: int, end: int | None, wanted, payload: bool):
    """Rows (headers, payload, error) from an offset at which a record begins; ends with a ``_Damaged`` if a member can't be inflated."""
    source = _Source(raw, begin)
    while source.blanks():
        if end is not None and source.member() >= end:
            return
        start = source.take(len(_START))
        if start != _START:
            if wanted({}):
                yield {}, None, "no record"
            if not _next(source):
                return
            continue
        head = source.until(b"\r\n\r\n")
        if head is None:
            if wanted({}):
                yield {}, None, "cut off"
            return
        headers = _headers(start + head)
        length = headers.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            if wanted(headers):
                yield headers, None, "length"
            if not _next(source):
                return
            continue
        n = int(length)
        if not wanted(headers):
            source.skip(n)
        elif payload:
            body = source.take(n)
            yield headers, body, None if len(body) == n else "cut off"
        else:
            whole = source.skip(n)
            yield headers, None, None if whole else "cut off"


class _Damaged(Exception):
    def __init__(self, at: int):
        self.at = at


def _next(source: _Source) -> bool:
    """Goes to the next line that begins a record."""
    while source.until(b"\n" + _START) is not None:
        source.at -= len(_START)
        return True
    return False


def _find(raw, begin: int, size: int) -> int | None:
    """Offset of the first gzip member from ``begin`` on that begins a record."""
    at, tail = begin, b""
    while at < size:
        raw.seek(at)
        data = tail + raw.read(_BUFFER)
        base = at - len(tail)
        i = data.find(_MAGIC)
        while 0 <= i:
            raw.seek(base + i)
            try:
                if zlib.decompressobj(31).decompress(raw.read(4096), len(_START)) == _START:
                    return base + i
            except zlib.error:
                pass
            i = data.find(_MAGIC, i + 1)
        at, tail = base + len(data), data[-(len(_MAGIC) - 1) :]
    return None


def records(raw, wanted, payload: bool, begin: int = 0, end: int | None = None, size: int | None = None) -> Iterator[tuple[dict[str, str], bytes | None, str | None]]:
    """(headers by lower-case name, payload, error) of the records for which ``wanted(headers)`` holds.

    Of those of a gzipped file whose member begins in [begin, end).
    """
    at: int | None = begin
    if begin:
        at = _find(raw, begin, size)
    while at is not None and (end is None or at < end):
        try:
            yield from _plain(raw, at, end, wanted, payload)
            return
        except _Damaged as e:
            if wanted({}):
                yield {}, None, "gzip"
            at = _find(raw, e.at + 1, size) if size is not None else None


def _number(x: str | None) -> int | None:
    return int(x) if x is not None and x.isascii() and x.isdigit() and len(x) < 19 else None


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() != "false"
        self.split = int(options.get("split", SPLIT))
        self.types = {t for t in options.get("types", "").split(",") if t} or None
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes equality, membership and prefix tests on header columns; returns the others."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else ""
            if name in HEADERS and name != "payload_length" and isinstance(f, (EqualTo, In, StringStartsWith, IsNotNull)):
                self.tests.append((HEADERS[name], type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        at, root = _at(self.path)
        info = at.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.File:
            found = [info]
        elif at.get_file_info(f"{root}/{MANIFEST}").type != fs.FileType.NotFound:
            with at.open_input_stream(f"{root}/{MANIFEST}") as f:
                names = json.loads(f.read())
            found = at.get_file_info([f"{root}/{n}" for n in names]) if names else []
        else:
            found = [x for x in at.get_file_info(fs.FileSelector(root, recursive=True)) if x.type == fs.FileType.File and x.path.lower().endswith((".warc", ".warc.gz"))]
        out: list[tuple[int, _File]] = []
        for x in found:
            size = x.size or 0
            parts = max(1, -(-size // self.split)) if x.path.lower().endswith(".gz") else 1
            for i in range(parts):
                out.append((size // parts, _File(x.path, i * size // parts, (i + 1) * size // parts if parts > 1 else None)))
        return [f for _, f in sorted(out, key=lambda p: (-p[0], p[1].name, p[1].begin))]

    def _wanted(self, headers: dict[str, str]) -> bool:
        if self.types and headers.get("warc-type") not in self.types:
            return False
        for name, kind, value in self.tests:
            own = headers.get(name)
            if own is None or (kind == "EqualTo" and own != value) or (kind == "In" and own not in value) or (kind == "StringStartsWith" and not own.startswith(value)):
                return False
        return True

    def read(self, partition):
        if partition is None:
            return
        at, _ = _at(self.path)
        schema = pa.schema([(n, pa.int64() if n == "payload_length" else pa.string()) for n in HEADERS] + [("payload", pa.binary()), ("error", pa.string())])

        def value(name: str, key: str, h: dict[str, str]):
            return h.get(key) if name != "payload_length" else _number(h.get(key, h.get("content-length")))

        def batch(rows):
            columns = [pa.array([value(n, key, h) for h, _, _ in rows], schema.field(n).type) for n, key in HEADERS.items()]
            return pa.RecordBatch.from_arrays([*columns, pa.array([p for _, p, _ in rows], pa.binary()), pa.array([e for _, _, e in rows], pa.string())], schema=schema)

        with at.open_input_file(partition.name) as raw:
            rows, size = [], 0
            for row in records(raw, self._wanted, self.payload, partition.begin, partition.end, raw.size()):
                rows.append(row)
                size += 500 + len(row[1] or b"")
                if size > 8 << 20:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)


class WarcWriter(DataSourceArrowWriter):
    """Writes columns record_id, warc_type, target_uri, warc_date, payload, and headers for digest, length and reference where present."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.packed, self.level = options.get("compression", "gzip") == "gzip", int(options.get("level", "1"))
        self.most = int(options.get("max_bytes", MAX_BYTES))

    def write(self, iterator):
        at, root = _at(self.path)
        at.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                text = {n: c.to_pylist() for n, c in columns.items() if n != "payload"}
                for i in range(batch.num_rows):
                    body = columns["payload"][i].as_py() or b""
                    more = {"Content-Type": text["content_type"][i] if text.get("content_type") and text["content_type"][i] else "application/octet-stream"}
                    for column, header in (("payload_digest", "WARC-Payload-Digest"), ("refers_to", "WARC-Refers-To"), ("payload_length", "X-Payload-Length")):
                        if column in text and text[column][i] is not None:
                            more[header] = str(text[column][i])
                    raw = record(text["warc_type"][i], text["record_id"][i], text["target_uri"][i], text["warc_date"][i], body, more)
                    if self.packed:
                        z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
                        raw = z.compress(raw) + z.flush()
                    if out is not None and size >= self.most:
                        out.close()
                        out = None
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc{'.gz' * self.packed}")
                        out, size = at.open_output_stream(f"{root}/{names[-1]}", compression=None, buffer_size=_BUFFER), 0
                    out.write(raw)
                    size += len(raw)
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages):
        at, root = _at(self.path)
        at.create_dir(root, recursive=True)
        names = [n for m in messages if m for n in m.names]
        target = f"{root}/{MANIFEST}"
        if not self.overwrite and at.get_file_info(target).type != fs.FileType.NotFound:
            with at.open_input_stream(target) as f:
                names = json.loads(f.read()) + names
        with at.open_output_stream(target) as f:
            f.write(json.dumps(sorted(names)).encode())

    def abort(self, messages):
        at, root = _at(self.path)
        for n in (n for m in messages if m for n in m.names):
            at.delete_file(f"{root}/{n}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes ``format("warc")`` known and lets filters reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def as_records(pages: DataFrame, min_revisit: int = MIN_REVISIT, scratch: Scratch | None = None) -> DataFrame:
    """Pages (page_id, url, html) as WARC records, one per row.

    Of the rows whose payloads are equal (by SHA-1 and length) and long enough,
    the one with the largest page_id is the response and the others revisit it.
    Null html is an empty payload; a null url has no target header. Rows that
    repeat the largest page_id are all responses. Rows without a page_id are
    responses, and none revisits them. Further columns are not read.
    """
    scratch = scratch or Scratch(pages.sparkSession)
    body = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit("").cast("binary"))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"), body.alias("payload"))
    base = base.withColumn("payload_length", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    # which rows revisit which is settled without payloads: digests, lengths and ids
    slim = scratch.save(base.where(F.col("page_id").isNotNull() & (F.col("payload_length") >= min_revisit)).select("page_id", "digest", "payload_length").distinct())
    groups = slim.groupBy("digest", "payload_length").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    revisits = scratch.save(slim.join(groups, ["digest", "payload_length"]).where("page_id != first"))
    few = revisits.count() <= FEW_REVISITS
    # rows without an id, which may be many, find nothing, each in a place of its own
    keys = ["page_id", "digest", "payload_length"]
    known = base.where("page_id is not null").join(F.broadcast(revisits) if few else revisits, keys, "left")
    joined = known.unionByName(base.where("page_id is null").withColumn("first", F.lit(None).cast("long")))
    again = F.col("first").isNotNull()
    return joined.select(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("warc_type"), "target_uri", F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"), F.when(again, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        "payload_length", F.lit("text/html; charset=utf-8").alias("content_type"), F.when(again, F.lit("").cast("binary")).otherwise(F.col("payload")).alias("payload"),
    )


def write(records_: DataFrame, path: str, compression: str = "gzip", **options) -> None:
    register(records_.sparkSession)
    records_.write.format("warc").options(path=path, compression=compression, **options).mode("append").save()


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def round_trip(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Writes the pages and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Twice, each time by a predicate on the type: responses with their payloads,
    revisits by their headers alone.
    """
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark)
    path = scratch.path()
    write(as_records(pages, scratch=scratch), path)
    urn = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(urn(c) != "", urn(c).cast("long"))
    full = read(spark, path).where("warc_type = 'response'")
    full = full.select(number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to"))
    heads = read(spark, path, payload="false").where("warc_type = 'revisit'")
    heads = heads.select(number("record_id"), "payload_length", F.regexp_replace("payload_digest", "^sha1:", ""), "warc_type", number("refers_to"))
    return full.union(heads)


def digest(payload: bytes) -> str:
    return hashlib.sha1(payload).hexdigest()
