"""Round trips through archives, pushed-down predicates, payloads that are stepped over."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, record_type int"


@pytest.fixture()
def make_pages(spark):
    return lambda rows: spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


ROWS = [
    (1, "http://a/ b", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, "http://a", "same"), (3, None, "same"), (5, "u", None), (4, "u", ""),
    (6, "u", "x" * 300_000), (7, "u\r\nX: 1", "same"),
]


def expected(rows, least=0):
    out = []
    for i, _, text in rows:
        data = (text or "").encode()
        same = [j for j, _, t in rows if (t or "") == (text or "") and j is not None]
        first = min(same) if same else None
        revisit = len(data) >= least and first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4, 5])
def test_pages_come_back(make_pages, least):
    found = warc.archive_pages(make_pages(ROWS), least).collect()
    assert sorted(map(tuple, found), key=str) == expected(ROWS, least)


def test_repeated_rows_null_ids_and_empty_table(make_pages):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, "u", "b")]
    found = sorted(((r[0], r[3], r[4]) for r in warc.archive_pages(make_pages(rows)).collect()), key=str)
    assert found == sorted([(1, "response", None), (1, "response", None), (None, "revisit", 1), (None, "response", None)], key=str)
    assert warc.archive_pages(make_pages([])).collect() == []


def test_payloads_equal_the_pages(spark, make_pages, tmp_path):
    path = f"file://{tmp_path}/archive"
    warc.write_archives(warc.page_records(make_pages(ROWS)), path)
    found = {r["record_id"]: r["payload"] for r in warc.read_archives(spark, path, verify=True).collect()}
    for i, _, text in ROWS:
        held = found[f"<urn:x-page:{i}>"]
        assert held is None if i in (3, 5, 7) else bytes(held) == (text or "").encode()


def test_filters_reach_the_reader(spark, make_pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(warc.page_records(make_pages(ROWS)), path)
    df = warc.read_archives(spark, path).where("record_type = 'revisit' and target_uri is not null and payload_bytes > 0")
    assert {r["record_id"] for r in df.collect()} == {"<urn:x-page:7>"}
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [" in plan and "revisit" in plan.split("PushedFilters")[1][:200]
    one_of = warc.read_archives(spark, path).where(F.col("record_id").isin("<urn:x-page:1>", "<urn:x-page:2>", "none"))
    assert one_of.count() == 2


def test_unwanted_payloads_are_not_read():
    records = [warc._member(warc._record({
        "record_type": kind, "record_id": f"<r:{n}>", "target_uri": "u", "payload_digest": "sha1:x", "refers_to": None,
        "payload_bytes": 400_000, "payload": bytes(hashlib.sha512(f"{n}{k}".encode()).digest()[0] for k in range(50_000)),
    })) for n, kind in enumerate(["response", "revisit", "response"])]

    class Counting:
        def __init__(self, data):
            self.data, self.at, self.read_bytes = data, 0, 0

        def size(self):
            return len(self.data)

        def seek(self, at):
            self.at = at

        def tell(self):
            return self.at

        def read(self, n):
            out = self.data[self.at : self.at + n]
            self.at += len(out)
            self.read_bytes += len(out)
            return out

    file = Counting(b"".join(records))
    rows = list(warc._records(file, lambda row: row["record_type"] == "revisit", False))
    assert [r["record_id"] for r, _ in rows] == ["<r:1>"]
    assert file.read_bytes < 20_000 < len(file.data)


def test_foreign_archives(spark, tmp_path):
    """Plain records, and members that do not tell their length."""
    row = {"record_type": "response", "record_id": "<a>", "target_uri": "u", "payload_digest": None, "refers_to": None, "payload_bytes": 3, "payload": b"abc"}
    two = [warc._record(row), warc._record({**row, "record_id": "<b>", "payload": b"z" * 70_000})]
    (tmp_path / "plain.warc").write_bytes(b"".join(two))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in two))
    found = warc.read_archives(spark, str(tmp_path)).where("record_id = '<b>'").collect()
    assert [len(r["payload"]) for r in found] == [70_000, 70_000]
    assert gzip.decompress(warc._member(two[0])) == two[0]


def test_wrong_digest_stops(spark, tmp_path):
    row = {"record_type": "response", "record_id": "<a>", "target_uri": "u", "payload_digest": "sha1:AAAA", "refers_to": None, "payload_bytes": 3, "payload": b"abc"}
    (tmp_path / "bad.warc").write_bytes(warc._record(row))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(spark, str(tmp_path), verify=True).collect()


def test_base32(spark):
    data = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(50)] + ["0" * 40, "f" * 40]
    df = spark.createDataFrame([(x,) for x in data], "x string").select("x", warc.with_base32(F.col("x")).alias("y"))
    assert all(r["y"] == base64.b32encode(bytes.fromhex(r["x"])).decode() for r in df.collect())
