"""WARC archives: a Python data source that writes and reads them, and the revisit records of repeated pages.

Writing: each task writes one file of records, every record a gzip member of its own, as WARC 1.1 has it. The
member's header carries its length in the extra field ``sl``, so that a reader can jump over it. A list of the files
of tasks that succeeded is written last; a reader takes only what is listed, so failed attempts leave no records. A page
whose payload equals that of a page with a smaller id becomes a ``revisit`` record, which repeats the HTTP headers
but not the payload.

Reading (format ``warc``): a file is one partition. Filters on the type, id, URI, digest and the other header columns
are taken over by the source and decided on the WARC headers alone, for which the first kilobytes of a record are
inflated; the rest of a record that fails them, or whose payload the schema does not ask for, is neither read nor
inflated. Plain archives and gzip members without the extra field are read too, the latter inflated to their ends.

Rows: a NULL html is an empty payload; equal payloads of at least ``least_bytes`` (0: empty ones too) are revisited.
Rows that repeat the smallest id of their payload are all responses. A payload known only from rows without an id
has responses only. A NULL url is an empty URI. Carriage returns and line feeds in a URL are percent-coded.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, WriterCommitMessage, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, StringStartsWith
from pyspark.sql.types import StructType

from leadlens.llm.common import bound_batches, shared_folder

END_OF_RECORD = b"\r\n\r\n"
RECORD_ID = "urn:page:"
#: Columns of the source, in order; all but the last two come from the WARC headers.
SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, "
    "payload_digest string, content_type string, content_length long, payload_bytes long, payload binary"
)
HEADER_OF = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type",
}


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: five hexadecimal digits make four base 32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and what the headers say: payload_bytes, payload_digest, record_type, refers_to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).select(
        "*", base32_sha1(F.col("html").cast("binary")).alias("payload_digest"), F.octet_length("html").cast("long").alias("payload_bytes")
    )
    # One row for each payload that several rows have, combined before the shuffle; the join may split hot payloads.
    key = [F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b")]
    groups = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy(*key).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = groups.filter("n > 1").select("d", "b", "first").repartition("d", "b")
    joined = rows.join(groups, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")), "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes a record for each row to archives in the folder ``path``, which must be new."""
    bound_batches(pages.sparkSession)
    pages.sparkSession.dataSource.register(WarcDataSource)
    rows = with_types(pages, least_bytes)
    uri = F.replace(F.replace(F.coalesce(F.col("url"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record_id = F.concat(F.lit(RECORD_ID), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    rows.select(
        "record_type", record_id.alias("record_id"), uri.alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.lit(RECORD_ID), F.col("refers_to").cast("string")).alias("refers_to"), "payload_digest",
        F.lit("application/http; msgtype=response").alias("content_type"), F.lit(0).cast("long").alias("content_length"), "payload_bytes",
        F.when(F.col("record_type") == "response", F.col("html").cast("binary")).alias("payload"),
    ).write.format("warc").mode("append").save(as_uri(path))


def as_uri(path: str) -> str:
    return path if ":" in path else f"file://{path}"


def open_fs(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and the path in it of any URI that pyarrow knows; Hadoop's ``file:/x`` is ``file:///x``."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def record_bytes(row: dict) -> bytes:
    """A WARC record of an HTTP response, ended by its blank lines."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Target-URI: {row['target_uri']}",
        f"WARC-Date: {row['date']}", f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
    ]
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <{row['refers_to']}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"Content-Type: {row['content_type']}", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + payload + END_OF_RECORD


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member whose extra field ``sl`` has its length and the data's, 0 where 32 bits don't hold them."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 24 + len(body) + 8
    skip = struct.pack("<II", size, len(data)) if max(size, len(data)) < 1 << 32 else bytes(8)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8) + skip
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    name: str
    records: int


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = open_fs(self.path)
        fs.create_dir(folder, recursive=True)
        name, records = f"{uuid.uuid4().hex}.warc.gz", 0
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as f:
            for batch in iterator:
                for row in batch.to_pylist():
                    f.write(member(record_bytes(row)))
                    records += 1
        return Written(name, records)

    def commit(self, messages: list[Written | None]) -> None:
        """Lists the files of this write, under a name of its own so that several writes add up."""
        fs, folder = open_fs(self.path)
        fs.create_dir(folder, recursive=True)
        files = [m.name for m in messages if m is not None and m.records]
        with fs.open_output_stream(f"{folder}/_files-{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = open_fs(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{folder}/{m.name}")


class ArchiveFile(InputPartition):
    def __init__(self, uri: str) -> None:
        self.uri = uri


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, suffix: str) -> None:
        self.path, self.suffix = path, suffix
        self.columns = schema.names
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes over what the headers can decide; yields the rest back to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In, IsNotNull, IsNull, StringStartsWith)) and len(f.attribute) == 1 and f.attribute[0] in HEADER_OF:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[ArchiveFile]:
        """A partition for each archive below the path: those that writes have listed, or all where there is no list."""
        fs, top = open_fs(self.path)
        found = [f for f in fs.get_file_info(pyarrow.fs.FileSelector(top, recursive=True)) if f.is_file and f.size]
        lists = [f.path for f in found if f.base_name.startswith("_files-")]
        names = [f.path for f in found if f.base_name[0] not in "_." and f.base_name.endswith(self.suffix)]
        if lists:
            listed = {name for path in lists for name in json.loads(fs.open_input_stream(path, compression=None).read())}
            names = [n for n in names if n.rpartition("/")[2] in listed]
        place = urlsplit(self.path)
        top_of = f"{place.scheme}://{place.netloc if top.startswith('/') else ''}"
        return [ArchiveFile(top_of + name) for name in sorted(names)]

    def passes(self, headers: dict[str, str]) -> bool:
        for f in self.filters:
            value = column(headers, f.attribute[0])
            if isinstance(f, IsNull):
                ok = value is None
            elif value is None:
                ok = False
            elif isinstance(f, EqualTo):
                ok = value == f.value
            elif isinstance(f, In):
                ok = value in f.value
            elif isinstance(f, StringStartsWith):
                ok = value.startswith(f.value)
            else:
                ok = True
            if not ok:
                return False
        return True

    def read(self, partition: ArchiveFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        rows: dict[str, list] = {name: [] for name in self.columns}
        size = 0
        for row in self.records(partition.uri):
            for name, cells in rows.items():
                cells.append(row.get(name))
            size += 512 + len(row.get("payload") or b"")
            if size > 4 << 20:
                yield as_batch(rows)
                rows, size = {name: [] for name in self.columns}, 0
        if size:
            yield as_batch(rows)

    def records(self, uri: str) -> Iterator[dict]:
        fs, path = open_fs(uri)
        wanted = {"payload", "payload_bytes"} & set(self.columns)
        with fs.open_input_file(path) as f:
            at, size = 0, f.size()
            kind = Member if f.read_at(2, 0) == b"\x1f\x8b" else Plain
            while at < size:
                record = kind(f, at)
                headers = record.headers()
                if not headers.pop("").startswith("WARC/"):
                    raise ValueError(f"no WARC record at byte {at} of {uri}")
                length = int(headers["content-length"])
                begin = record.used
                if self.passes(headers):
                    row = {name: column(headers, name) for name in HEADER_OF} | {"content_length": length}
                    if wanted:
                        http = record.headers() if "http" in headers.get("content-type", "") else {}
                        rest = length - (record.used - begin)
                        row["payload_bytes"] = int(http.get("content-length", rest))
                        if "payload" in wanted:
                            row["payload"] = record.take(rest)
                    yield row
                at = record.end(begin + length + len(END_OF_RECORD))


class Plain:
    """An uncompressed record that begins at a position of a file; it is read in blocks, as far as it is asked for."""

    def __init__(self, f: pa.NativeFile, at: int, block: int = 1 << 14) -> None:
        self.f, self.at, self.next, self.block = f, at, at, block
        self.data, self.used = b"", 0  # what is read of the record, and how much of it is taken

    def more(self) -> bool:
        new = self.f.read_at(self.block, self.next)
        self.next += len(new)
        self.block = 1 << 20
        self.data += new
        return bool(new)

    def headers(self) -> dict[str, str]:
        """The lines up to a blank one, names in lower case, the first line under an empty name."""
        while (end := self.data.find(b"\r\n\r\n", self.used)) < 0:
            if not self.more():
                raise ValueError("the file ends inside a record's headers")
        first, *lines = self.data[self.used : end].decode("utf-8", "replace").split("\r\n")
        self.used = end + 4
        return {"": first} | {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}

    def take(self, n: int) -> bytes:
        while len(self.data) < self.used + n:
            if not self.more():
                raise ValueError("the file ends inside a record")
        self.used += n
        return self.data[self.used - n : self.used]

    def end(self, length: int) -> int:
        """Where the next record begins."""
        return self.at + length


class Member(Plain):
    """A record in a gzip member of its own, inflated as far as it is asked for."""

    def __init__(self, f: pa.NativeFile, at: int) -> None:
        super().__init__(f, at, 1 << 11)
        self.inflate = zlib.decompressobj(31)
        head = f.read_at(24, at)
        known = head[3:4] == b"\x04" and head[12:16] == b"sl\x08\x00"
        self.size = struct.unpack("<I", head[16:20])[0] if known else 0

    def more(self) -> bool:
        most = self.at + self.size - self.next if self.size else self.block
        new = self.f.read_at(min(self.block, most), self.next)
        self.next += len(new)
        self.block = 1 << 18
        self.data += self.inflate.decompress(new)
        return bool(new) and not (self.inflate.eof and not self.data)

    def end(self, length: int) -> int:
        if self.size:
            return self.at + self.size
        while not self.inflate.eof and self.more():
            self.data = b""
        return self.next - len(self.inflate.unused_data)


def column(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(HEADER_OF[name])
    if value and value[0] == "<" and value[-1] == ">":
        value = value[1:-1]
    if value and name == "payload_digest":
        value = value.removeprefix("sha1:")
    return value


def as_batch(rows: dict[str, list]) -> pa.RecordBatch:
    kinds = {"content_length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.record_batch([pa.array(cells, kinds.get(name, pa.string())) for name, cells in rows.items()], list(rows))


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``; a schema with fewer columns reads less. Option ``suffix`` names the
    ending of the files that count."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, self.options.get("suffix", ""))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to")
        return WarcWriter(self.options["path"])


def read_archives(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    key = "spark.sql.python.filterPushdown.enabled"
    if key not in spark.conf.getAll:
        spark.conf.set(key, "true")  # Spark asks a Python source about filters only then
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").schema(schema).load(as_uri(path))


def warc(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The query: archives written to a new folder of the shared one and read back, a row for each page. Responses'
    sizes and digests are taken from the payloads read; revisits are read without a payload."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    names = "record_type string, record_id string, refers_to string, payload_digest string, payload_bytes long"
    page_id = F.expr(f"try_cast(substring(record_id, {len(RECORD_ID) + 1}) AS BIGINT)").alias("page_id")
    responses = read_archives(spark, path, f"{names}, payload binary").filter(F.col("record_type") == "response")
    revisits = read_archives(spark, path, names).filter(F.col("record_type") == "revisit")
    target = F.expr(f"try_cast(substring(refers_to, {len(RECORD_ID) + 1}) AS BIGINT)").alias("refers_to")
    responses = responses.select(
        page_id, F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), "record_type", target
    )
    return responses.unionByName(revisits.select(page_id, "payload_bytes", "payload_digest", "record_type", target))


#: DuckDB has no base 32; the hexadecimal digest's groups of five digits are turned into four base 32 digits.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS first FROM p),
d AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM d
"""
