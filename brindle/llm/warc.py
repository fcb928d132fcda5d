"""WARC archives: written by Spark's text writer, read by a Python data source that looks at headers first."""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, content_length long, headers map<string,string>, payload_bytes long, payload binary, file string"

#: Columns that are WARC headers, so that conditions on them are decided before a block is touched.
HEADER_COLUMNS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


def base32_sha1(data: Column) -> Column:
    """SHA-1 of a binary or string column as bare upper-case base32: four letters for every five hexadecimal digits."""
    fives = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(F.sha1(data), i * 5 + 1, F.lit(5)), 16, 10).cast("int"))

    def letters(v: Column) -> Column:
        return F.concat(*[F.substring(F.lit(BASE32), F.shiftright(v, k).bitwiseAND(31) + 1, F.lit(1)) for k in (15, 10, 5, 0)])

    return F.array_join(F.transform(fives, letters), "")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for null. Line ends inside a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(name + ": "), safe, F.lit("\r\n")), F.lit(""))


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a record for each row of pages (page_id, url, html) to gzipped archives under path.

    Of rows with equal payloads of at least min_revisit_bytes, that with the smallest page_id becomes a response and
    the others revisit it. Null html is an empty payload, a null url leaves its header out. Null page_ids count as
    larger than all others (a group of null ids only is all responses); rows alike in payload and smallest page_id are
    all responses. An empty table writes an archive folder without records.

    Digests are joined without the payloads, and payloads then by page, so many equal payloads make no large group.
    """
    html = F.coalesce("html", F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    narrow = base.select("page_id", base32_sha1(F.col("html")).alias("digest"), F.octet_length("html").alias("n")).filter(F.col("n") >= min_revisit_bytes)
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1 and first is not null")
    revisits = narrow.join(first, "digest").filter("page_id is null or page_id > first").select("page_id", "digest", "first").distinct()
    known = base.withColumn("digest", base32_sha1(F.col("html")))
    revisits = revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "first")
    rows = known.join(revisits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")
    again = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(again, "").otherwise(F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(again, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(again, _record_id(F.col("first"), F.col("digest")))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page-ID", F.col("first").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", F.octet_length("block").cast("string")),
    )
    # A record ends with two line ends; the writer's line separator is the last character of the second.
    record = F.concat(head, F.lit("\r\n"), F.col("block"), F.lit("\r\n\r"))
    rows.withColumn("block", block).select(record.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


@dataclass
class ArchivePart(InputPartition):
    """Archives that one task reads."""

    files: tuple[str, ...]

    def __init__(self, files: tuple[str, ...]):
        super().__init__(files)
        self.files = files


class WarcReader(DataSourceReader):
    """Plans groups of archives, keeps conditions on headers and reads blocks only of records that meet them."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.target = int(options.get("partitionbytes", 64 << 20))
        self.payload = options.get("payload", "true").lower() == "true"
        self.wanted: list[tuple[str, tuple]] = []
        self.present: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = HEADER_COLUMNS.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if name and isinstance(f, EqualTo):
                self.wanted.append((name, (f.value,)))
            elif name and isinstance(f, In):
                self.wanted.append((name, tuple(f.value)))
            elif name and isinstance(f, IsNotNull):
                self.present.append(name)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        files = sorted((x.path, x.size) for x in found if x.is_file and x.base_name[0] not in "._")
        groups: list[list[str]] = []
        room = 0
        for name, size in files:
            if not groups or room < size:
                groups.append([])
                room = self.target
            groups[-1].append(name)
            room -= size
        return [ArchivePart(tuple(g)) for g in groups] or [ArchivePart(())]

    def _accepts(self, headers: dict[str, str]) -> bool:
        return all(headers.get(k) in v for k, v in self.wanted) and all(k in headers for k in self.present)

    def read(self, partition: ArchivePart) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.binary(), pa.string()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        fs, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        rows: list[tuple] = []
        held = 0
        for name in partition.files:
            with io.BufferedReader(fs.open_input_stream(name), 1 << 20) as stream:
                for headers, length in records(stream, name):
                    if not self._accepts(headers):
                        skip(stream, length)
                        continue
                    size, payload = read_block(stream, headers, length, self.payload)
                    own = [headers.get(HEADER_COLUMNS[c]) for c in names[:6]]
                    rows.append((*own, length, list(headers.items()), size, payload, name))
                    held += length
                    if len(rows) >= 1000 or held >= 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)


def records(stream: io.BufferedReader, name: str) -> Iterator[tuple[dict[str, str], int]]:
    """Headers (names in lower case) and block length of each record; the caller must consume the block."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: a record starts with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        yield headers, int(headers["content-length"])


def skip(stream: io.BufferedReader, length: int) -> None:
    while length > 0:
        got = len(stream.read(min(length, 1 << 20)))
        if not got:
            raise ValueError("an archive ends inside a record")
        length -= got


def read_block(stream: io.BufferedReader, headers: dict[str, str], length: int, wanted: bool) -> tuple[int, bytes | None]:
    """Size of the payload (for revisits that of the full one) and, if wanted, its bytes."""
    if "application/http" not in headers.get("content-type", ""):
        if wanted:
            return length, stream.read(length)
        skip(stream, length)
        return length, None
    head, size = 0, None
    while head < length and (line := stream.readline(length - head)):
        head += len(line)
        if not line.strip():
            break
        if line.lower().startswith(b"content-length:"):
            size = int(line.split(b":")[1])
    rest = length - head
    payload = None
    if wanted and headers.get("warc-type") != "revisit":
        payload = stream.read(rest)
        if len(payload) < rest:
            raise ValueError("an archive ends inside a record")
    else:
        skip(stream, rest)
    return size if size is not None else rest, payload


class WarcDataSource(DataSource):
    """spark.read.format("warc").load(folder); option payload=false leaves all payloads undecoded."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives under path. Conditions on record type, ids, URI, date and digest are pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Writes pages to path and reads them back: a row for each record, with digests of the payloads as read.

    Responses are hashed again from the bytes read; revisits have the length and digest that their headers state.
    """
    write_warc(pages, path, min_revisit_bytes)
    own = F.col("headers")
    back = read_warc(pages.sparkSession, path).select(
        own["x-page-id"].cast("long").alias("page_id"),
        F.when(F.col("record_type") == "revisit", F.col("payload_bytes")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.regexp_replace("payload_digest", "^sha1:", "")).otherwise(base32_sha1(F.col("payload"))).alias("payload_digest"),
        "record_type",
        own["x-refers-to-page-id"].cast("long").alias("refers_to"),
        F.col("target_uri").alias("url"),
    )
    return back
