import gzip
import hashlib
import io

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from stratavault.llm import warc

PAGES = "page_id bigint, url string, html string"
BIG = "<p>é</p>" * 200
ROWS = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, "http://c/\r\nX: y", BIG + "x"), (4, None, None), (5, "", ""), (6, "u", "s" * 999), (7, "u", "s" * 999),
        (8, "u", "t" * 1000), (9, "u", "t" * 1000), (9, "u", "t" * 1000), (None, "u", "t" * 1000), (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50),
        (11, "u", "\r\n\r\n"), (12, "u", "long " * 100_000), (None, "u", "q" * 1200)]


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(data) >= 1000 and ids and page != max(ids)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(ids) if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"gzip": "true", "maxFileBytes": "2000", "most_groups": 0}])
def test_round_trip(spark, clashing, tmp_path, options):
    pages = clashing(spark.createDataFrame(ROWS, PAGES)).repartition(3)
    path = str(tmp_path / "archive")
    warc.page_archive(pages, path, **options)
    found = [tuple(r) for r in warc.archived_pages(spark, path).collect()]
    assert sorted(found, key=repr) == expected(ROWS)
    warc.page_archive(pages.where("page_id = 4"), path)  # replaces the archive
    assert warc.read(spark, path).count() == 1
    warc.page_archive(pages.where("page_id = 5"), path)
    assert [r.record_id for r in warc.read(spark, path, "record_id").collect()] == ["<urn:page:5>"]


def test_predicates_are_pushed_down_and_agree_with_spark(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.page_archive(spark.createDataFrame(ROWS, PAGES), path, maxFileBytes="3000")
    every = warc.read(spark, path).cache()
    for test in ("record_type = 'revisit'", "record_type IN ('revisit', 'x')", "target_uri IS NULL", "target_uri LIKE 'http://%'", "NOT (record_type = 'revisit')",
                 "content_length > 5000", "refers_to <=> NULL", "payload_length = 999", "record_type = 'response' AND target_uri > 'http://b'"):
        assert warc.read(spark, path).where(test).count() == every.where(test).count(), test
    plan = warc.read(spark, path, "record_type").where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]


def test_unwanted_payloads_are_not_read():
    class Counting(io.BytesIO):
        longest = 0

        def read(self, size=-1):
            Counting.longest = max(Counting.longest, size)
            return super().read(size)

    data = b"".join(warc.record_bytes(kind, f"<urn:page:{i}>", None, None, None, None, None, b"z" * 50_000) for i, kind in enumerate(["response", "resource", "response"]))
    passed = list(warc.records(Counting(data), [ds.EqualTo(("record_type",), "resource")], True))
    assert [r["record_id"] for r in passed] == ["<urn:page:1>"] and Counting.longest == 50_000
    Counting.longest = 0
    assert [r["payload_length"] for r in warc.records(Counting(data), [], False)] == [50_000] * 3 and Counting.longest == 0


def _record(block, length=None, kind="resource", content="application/octet-stream"):
    stated = f"Content-Length: {len(block) if length is None else length}\r\n"
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x>\r\nContent-Type: {content}\r\n{stated}\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("payloads", [True, False])
@pytest.mark.parametrize("tests", [[], [ds.EqualTo(("record_type",), "other")]])
def test_records_that_are_cut_off_are_errors(payloads, tests):
    whole = _record(b"a" * 10) + _record(b"b" * 5000)
    found = list(warc.records(io.BufferedReader(io.BytesIO(whole[:-4])), [], True))  # only the blank lines behind it are missing
    assert [len(r["payload"]) for r in found] == [10, 5000]
    for cut in (5, 3000, 5004):
        for stream in (io.BufferedReader(io.BytesIO(whole[:-cut])), gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(whole[:-cut])))):
            with pytest.raises(ValueError, match="<urn:x> is cut off"):
                list(warc.records(stream, tests, payloads))


@pytest.mark.parametrize("length", ["", "-4", "ten"])
def test_records_without_a_length_are_errors(length):
    with pytest.raises(ValueError, match="<urn:x> has no Content-Length"):
        list(warc.records(io.BytesIO(_record(b"abcd", length)), [], True))
    headless = _record(b"abcd").replace(b"Content-Length: 4\r\n", b"")
    with pytest.raises(ValueError, match="<urn:x> has no Content-Length"):
        list(warc.records(io.BytesIO(headless), [], False))


def test_http_block_without_end_of_header_is_a_payload():
    stream = io.BufferedReader(io.BytesIO(_record(b"HTTP/1.1 200 OK", content="application/http") + _record(b"next")))
    assert [r["payload"] for r in warc.records(stream, [], True)] == [b"HTTP/1.1 200 OK", b"next"]


def test_foreign_archive(spark, tmp_path):
    """Line feeds, folded headers, an unknown digest and a record without HTTP, in a folder without a manifest."""
    (tmp_path / "x.warc").write_bytes(
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\nX-Long: a\r\n b\r\n\r\nabcde\r\n\r\n"
        b"WARC/1.0\nWARC-Type: response\nContent-Type: application/http;msgtype=response\nWARC-Payload-Digest: md5:00\nContent-Length: 30\n\n"
        b"HTTP/1.0 200 OK\nA: b\n\npay\r\n...\r\n\r\n")
    (tmp_path / "note.txt").write_text("no archive")
    rows = warc.read(spark, str(tmp_path)).orderBy("record_type").collect()
    assert [(r.record_type, r.payload_digest, bytes(r.payload)) for r in rows] == [("response", "md5:00", b"pay\r\n..."), ("warcinfo", None, b"abcde")]
    assert rows[1].headers["x-long"] == "a b"


def test_failed_attempts_are_not_read(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.page_archive(spark.createDataFrame(ROWS[:3], PAGES), path)
    (tmp_path / "archive" / "part-99999-left.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nConte")
    assert warc.read(spark, path).count() == 3


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.page_archive(spark.createDataFrame([], PAGES), path)
    assert warc.archived_pages(spark, path).collect() == []
    assert warc.read(spark, str(tmp_path / "nothing")).where(F.col("record_type") == "x").count() == 0
