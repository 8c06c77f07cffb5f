"""WARC archives as a PySpark data source.

Reading plans partitions from files, parses the headers of each record first, applies the pushed-down predicates on
record type and headers to them, and reads or decodes a payload only if a record passes and the column is wanted;
other payloads are skipped (in uncompressed files without reading them). Writing gives one or more files per task; the
files of a write are named in a manifest when it is committed, so what failed or repeated attempts leave is never read.

``page_archive`` writes a crawl with each large payload once and the others as revisits of it.
"""

from __future__ import annotations

import base64
import gzip
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stratavault.llm.base import BROADCAST_ROWS, hot_join
from stratavault.session import materialise

READ_SCHEMA = ("record_type string, record_id string, target_uri string, date string, content_type string, content_length bigint, "
               "payload_digest string, refers_to string, payload_length bigint, headers map<string,string>, payload binary")
WRITE_SCHEMA = ("record_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, "
                "payload_length bigint, payload binary")
#: Column -> header, of the columns that predicates are pushed down on.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
           "content_type": "content-type", "content_length": "content-length", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
MANIFEST = "_manifest-"
_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 1000
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE = "application/http; msgtype=response"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _hex_digest(text: str | None) -> str | None:
    """Bare lower-case hex of a SHA-1 digest in base 32 or hex; other digests as they are."""
    name, _, value = (text or "").partition(":")
    if name.lower() != "sha1":
        return text
    try:
        return (base64.b32decode(value.upper()) if len(value) == 32 else bytes.fromhex(value)).hex()
    except ValueError:
        return text


def _holds(test: ds.Filter, record: dict) -> bool | None:
    """Value of a predicate, None for unknown, as in SQL."""
    if isinstance(test, ds.Not):
        inner = _holds(test.child, record)
        return None if inner is None else not inner
    found = record[test.attribute[0]]
    if isinstance(test, ds.IsNull):
        return found is None
    if isinstance(test, ds.IsNotNull):
        return found is not None
    if isinstance(test, ds.EqualNullSafe):
        return found == test.value
    if found is None:
        return None
    if isinstance(test, ds.In):
        return True if found in test.value else None if None in test.value else False
    if test.value is None:
        return None
    return _TESTS[type(test)](found, test.value)


_TESTS = {
    ds.EqualTo: lambda a, b: a == b, ds.GreaterThan: lambda a, b: a > b, ds.GreaterThanOrEqual: lambda a, b: a >= b,
    ds.LessThan: lambda a, b: a < b, ds.LessThanOrEqual: lambda a, b: a <= b, ds.StringStartsWith: lambda a, b: a.startswith(b),
    ds.StringEndsWith: lambda a, b: a.endswith(b), ds.StringContains: lambda a, b: b in a,
}


def _pushable(test: ds.Filter) -> bool:
    if isinstance(test, ds.Not):
        return _pushable(test.child)
    known = isinstance(test, (ds.IsNull, ds.IsNotNull, ds.EqualNullSafe, ds.In)) or type(test) in _TESTS
    return known and len(test.attribute) == 1 and test.attribute[0] in HEADERS


def _header_lines(stream: io.BufferedIOBase) -> tuple[dict[str, str], int]:
    """Headers up to the blank line, lower-cased names, and the bytes read. Folded lines continue the one before."""
    found: dict[str, str] = {}
    name, read = "", 0
    while True:
        line = stream.readline()
        read += len(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            return found, read
        if text[0] in " \t" and name:
            found[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        found[name] = value.strip()


def _cut_off(headers: dict[str, str]) -> ValueError:
    return ValueError(f"WARC record {headers.get('warc-record-id', 'without id')} is cut off: its block ends before Content-Length")


def _end(stream: io.BufferedIOBase) -> int:
    """Length of a stream that has been read, or skipped, to its end; a skip in a packed one stops there."""
    return stream.tell() if isinstance(stream, gzip.GzipFile) else stream.seek(0, io.SEEK_END)


def records(stream: io.BufferedIOBase, tests: list[ds.Filter], payloads: bool) -> Iterator[dict]:
    """Records that pass, as dicts of READ_SCHEMA's columns.

    A record that is cut off, read or skipped, and one without a whole Content-Length are errors that name the record. A
    block that states to be HTTP but has no end of its header is a payload as a whole.
    """
    skipped, last = 0, {}  # where the last block that was not read should end
    while True:
        line = stream.readline()
        if not line:
            if skipped > _end(stream):
                raise _cut_off(last)
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers, _ = _header_lines(stream)
        stated = headers.get("content-length", "")
        if not (stated.isascii() and stated.isdigit()):
            raise ValueError(f"WARC record {headers.get('warc-record-id', 'without id')} has no Content-Length: {stated!r}")
        length = int(stated)
        record = {column: headers.get(header) for column, header in HEADERS.items()}
        record["content_length"] = length
        record["payload_digest"] = _hex_digest(record["payload_digest"])
        if not all(_holds(t, record) for t in tests):
            skipped, last = stream.tell() + length, headers
            stream.seek(length, io.SEEK_CUR)
            continue
        http, read = ({}, 0)
        if (record["content_type"] or "").startswith("application/http") and length:
            http, read = _header_lines(stream)
            if read > length:
                stream.seek(-read, io.SEEK_CUR)
                http, read = {}, 0
        rest = length - read
        revisit = record["record_type"] == "revisit"
        stated = http.get("content-length", "")
        record["payload_length"] = (int(stated) if stated.isdigit() else None) if revisit else rest
        record["headers"] = list(headers.items())
        if payloads and not revisit:
            record["payload"] = stream.read(rest)
            if len(record["payload"]) < rest:
                raise _cut_off(headers)
        else:
            record["payload"] = None
            skipped, last = stream.tell() + rest, headers
            stream.seek(rest, io.SEEK_CUR)
        yield record


@dataclass
class _Files(ds.InputPartition):
    names: list[str]


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, path: str, split: int) -> None:
        self.schema, self.path, self.split, self.tests = schema, path, split, []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for test in filters:
            if _pushable(test):
                self.tests.append(test)
            else:
                yield test

    def partitions(self) -> list[ds.InputPartition]:
        """Files in order of their names, small ones together up to ``splitBytes``."""
        system, root = _opened(self.path)
        entries = system.get_file_info(pafs.FileSelector(root, recursive=False)) if system.get_file_info(root).type == pafs.FileType.Directory else []
        known = {f.base_name: f.size or 0 for f in entries if f.is_file}
        manifests = [n for n in known if n.startswith(MANIFEST)]
        if manifests:
            names = []
            for name in manifests:
                with system.open_input_stream(f"{root}/{name}") as stream:
                    names += stream.read().decode().splitlines()
        else:
            names = [n for n in known if n.endswith((".warc", ".warc.gz"))]
        packs, size = [_Files([])], 0
        for name in sorted(names):
            if packs[-1].names and size + known.get(name, 0) > self.split:
                packs.append(_Files([]))
                size = 0
            packs[-1].names.append(name)
            size += known.get(name, 0)
        return packs

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, root = _opened(self.path)
        kind = to_arrow_schema(self.schema)
        names = self.schema.fieldNames()
        held, size = [], 0
        for name in partition.names:
            with system.open_input_file(f"{root}/{name}") as raw, io.BufferedReader(raw, 1 << 20) as buffered:
                stream = gzip.GzipFile(fileobj=buffered) if name.endswith(".gz") else buffered
                for record in records(stream, self.tests, "payload" in names):
                    held.append(record)
                    size += len(record["payload"] or b"") + 500
                    if size >= _BATCH_BYTES or len(held) >= _BATCH_ROWS:
                        yield pa.RecordBatch.from_pydict({n: [r[n] for r in held] for n in names}, schema=kind)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({n: [r[n] for r in held] for n in names}, schema=kind)


def _clean(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record_bytes(record_type: str, record_id: str, target_uri: str | None, date: str | None, payload_digest: str | None, refers_to: str | None,
                 payload_length: int | None, payload: bytes | None) -> bytes:
    """One record; responses and revisits hold an HTTP header, and a revisit no payload."""
    payload = payload or b""
    http = record_type in ("response", "revisit")
    stated = len(payload) if payload_length is None else payload_length
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {stated}\r\n\r\n".encode() if http else b""
    block = head + (b"" if record_type == "revisit" else payload)
    lines = [("WARC-Type", record_type), ("WARC-Record-ID", record_id), ("WARC-Date", date or "1970-01-01T00:00:00Z"), ("WARC-Target-URI", target_uri),
             ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(payload_digest)).decode() if payload_digest else None),
             ("WARC-Refers-To", refers_to), ("WARC-Profile", REVISIT_PROFILE if record_type == "revisit" else None),
             ("Content-Type", HTTP_RESPONSE if http else "application/octet-stream"), ("Content-Length", str(len(block)))]
    header = VERSION + "\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in lines if v is not None) + "\r\n"
    return header.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


@dataclass
class _Written(ds.WriterCommitMessage):
    names: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, most: int, packed: bool) -> None:
        self.path, self.overwrite, self.most, self.packed = path, overwrite, most, packed

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        place, run, names, out, size = TaskContext.get().partitionId(), uuid.uuid4().hex, [], None, 0
        try:
            for batch in iterator:
                columns = [batch.column(n) for n in (f.split()[0] for f in WRITE_SCHEMA.split(", "))]
                for i in range(batch.num_rows):
                    if out is None:
                        names.append(f"part-{place:05d}-{run}-{len(names)}.warc" + ".gz" * self.packed)
                        out, size = system.open_output_stream(f"{root}/{names[-1]}", compression=None, buffer_size=1 << 20), 0
                    record = record_bytes(*(c[i].as_py() for c in columns))
                    out.write(gzip.compress(record, 6) if self.packed else record)
                    size += len(record)
                    if size >= self.most:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def _listed(self, system: pafs.FileSystem, root: str) -> list[str]:
        if system.get_file_info(root).type != pafs.FileType.Directory:
            return []
        return [f.path for f in system.get_file_info(pafs.FileSelector(root)) if f.base_name.startswith(MANIFEST) or f.base_name.startswith("part-")]

    def commit(self, messages: list[_Written | None]) -> None:
        """The manifest makes the files of this write, and of no failed attempt, part of the archive."""
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        names = [n for m in messages if m for n in m.names]
        stale = [p for p in self._listed(system, root) if p.rpartition("/")[2] not in names] if self.overwrite else []
        with system.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}") as out:
            out.write("\n".join(names).encode())
        for path in stale:
            system.delete_file(path)

    def abort(self, messages: list[_Written | None]) -> None:
        system, root = _opened(self.path)
        for name in (n for m in messages if m for n in m.names):
            system.delete_file(f"{root}/{name}")


class WarcSource(ds.DataSource):
    """Options: path; ``splitBytes`` (files read in one task, 128 MB), ``maxFileBytes`` (256 MB), ``gzip`` (each record)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options["path"], int(self.options.get("splitBytes", 128 << 20)))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite, int(self.options.get("maxFileBytes", 256 << 20)),
                          str(self.options.get("gzip", "false")).lower() == "true")


def read(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Records of an archive; only the named columns are parsed out of them, all without names."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    kinds = {f.strip().split()[0]: f.strip() for f in READ_SCHEMA.replace("map<string,string>", "map<string;string>").split(",")}
    schema = ", ".join(kinds[c] for c in columns or kinds).replace(";", ",")
    return spark.read.format("warc").schema(schema).load(path)


def write(frame: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    """``frame`` holds the columns of WRITE_SCHEMA; other columns are left out."""
    frame.sparkSession.dataSource.register(WarcSource)
    frame.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in WRITE_SCHEMA.split(", ")]).write.format("warc").mode(mode).options(**options).save(path)


LEAST_REVISIT = 1000
_PAGE_ID = "<urn:page:"


def page_archive(pages: DataFrame, path: str, least: int = LEAST_REVISIT, most_groups: int = BROADCAST_ROWS, **options: str) -> None:
    """Write a record per row of ``pages`` (page_id, url, html): of rows with equal payloads of ``least`` bytes or more
    that with the largest page_id is the response and the others revisit it; all others are responses.

    The payload is the html in UTF-8, empty for null. Rows that repeat the largest page_id are all responses; a null
    page_id revisits any that is not null; line breaks in a url are percent-encoded; an empty table gives an archive
    without records; other columns are not read. Payloads meet by SHA-256 and length; a payload that fills a third of
    the table is spread over all tasks. Up to ``most_groups`` payloads that repeat are sent to every executor, so that the
    pages need no shuffle; more of them are joined in one, but for the most frequent.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("target_uri"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    facts = rows.withColumns({"payload_length": F.length("payload").cast("bigint"), "_sha": F.sha2("payload", 256)})
    several = materialise(facts.where(F.col("payload_length") >= least).groupBy("_sha").agg(
        F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "warc-several")
    if several.limit(most_groups + 1).count() <= most_groups:
        joined = facts.join(F.broadcast(several), "_sha", "left")
    else:
        joined = hot_join(facts, several, "_sha", "_n", F.xxhash64("page_id", "target_uri"))
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))

    def name(column: str):
        return F.concat(F.lit(_PAGE_ID), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    write(joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"), "target_uri",
        F.lit(None).cast("string").alias("date"), F.sha1("payload").alias("payload_digest"), F.when(revisit, name("_first")).alias("refers_to"),
        "payload_length", F.when(~revisit, F.col("payload")).alias("payload")), path, **options)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page of an archive: of responses from the
    payload that was read, of revisits from their headers alone."""
    def page(column: str):
        return F.regexp_extract(column, "^<urn:page:(.*)>$", 1).try_cast("bigint")

    responses = read(spark, path, "record_type", "record_id", "payload").where("record_type = 'response'")
    revisits = read(spark, path, "record_type", "record_id", "refers_to", "payload_digest", "payload_length").where("record_type = 'revisit'")
    return responses.select(
        page("record_id").alias("page_id"), F.length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", F.lit(None).cast("bigint").alias("refers_to")).unionByName(revisits.select(
            page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", page("refers_to").alias("refers_to")))
