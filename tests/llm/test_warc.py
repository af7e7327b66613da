import base64
import hashlib
import re

import pytest

from termloom.llm.queries import op1_warc
from termloom.llm.warc import read_warc, write_warc
from termloom.sinks import shared_folder

SF_DIR = "/root/testdata/sf0.001"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows):
    payloads = {}
    for key, data in rows:
        payloads.setdefault(data, []).append(key)
    out = []
    for key, data in rows:
        latest = max(payloads[data])
        out.append((key, len(data), digest(data), "response" if key == latest else "revisit", None if key == latest else latest))
    return sorted(out)


def test_query_equals_brute_force(spark):
    rows = [(r[0], (r[1] or "").encode()) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect()]
    assert sorted((tuple(r) for r in op1_warc(spark, SF_DIR).collect()), key=lambda r: r[0]) == expected(rows)


FAKE = b"\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ODD = [
    (1, b""), (2, b"\r\n\r\n"), (3, b"WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (4, FAKE), (5, FAKE * 40),
    (6, b"\n" * 999 + b"WARC/1."), (7, b"\r\n\r\nWARC/1.1"), (8, b"\nWARC/1.\nWARC/1."), (9, bytes(range(256)) * 500),
    (10, b"x" * 300_000 + FAKE * 3000), (11, b""), (12, b"\xef\xbb\xbf\r"), (13, b"\r\n"), (14, b"x" * 65_000 + b"\r\n\r\n"),
]


@pytest.mark.parametrize("split", ["1k", "7k", "128m"])
def test_magic_inside_payloads(spark, split):
    docs = spark.createDataFrame([(k, f"http://a/{k}\r\nWARC/1.1", bytearray(d)) for k, d in ODD], "id int, uri string, payload binary")
    folder = shared_folder(spark)
    write_warc(docs.coalesce(1), folder)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, split)
    try:
        records = read_warc(spark, folder).collect()
    finally:
        spark.conf.set(key, before)
    contents = dict(ODD)
    assert sorted(int(r["record_id"]) for r in records) == sorted(contents)
    for r in records:
        assert r["intact"] and r["uri"] == f"http://a/{r['record_id']}%0D%0AWARC/1.1"
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == contents[int(r["record_id"])]
    got = [(int(r["record_id"]), r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"] and int(r["refers_to"])) for r in records]
    assert sorted(got) == expected(ODD)
    offsets = sorted(r["offset"] for r in records)
    text = b"".join(spark.read.format("binaryFile").load(folder).select("content").first())
    assert all(text[o : o + 7] == b"WARC/1." for o in offsets) and offsets[0] == 0


def test_nulls_files_and_damage(spark, tmp_path):
    docs = spark.createDataFrame([(None, None, None, 1), (5, None, "é", 2), (5, "u", "é", 3), (3, "u", "é", 4)], "id int, uri string, payload string, digest int")
    folder = shared_folder(spark)
    write_warc(docs, folder, records_per_file=1, min_bytes=1)
    got = sorted((r["record_id"] or "", r["record_type"], r["refers_to"], r["payload_bytes"]) for r in read_warc(spark, folder).collect())
    assert got == [("", "response", None, 0), ("3", "revisit", "5", 2), ("5", "response", None, 2), ("5", "response", None, 2)]
    write_warc(docs.limit(0), folder + "-none")
    assert read_warc(spark, folder + "-none").count() == 0
    good = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n"
    (tmp_path / "cut.warc").write_bytes(good + good[:-6])
    (tmp_path / "bad.warc").write_bytes(b"junk" + good)
    records = read_warc(spark, f"file://{tmp_path}").collect()
    assert all(r["file"].endswith("cut.warc") for r in records)
    rows = {r["offset"]: r for r in records}
    assert re.search("body", bytes(rows[0]["payload"]).decode()) and rows[0]["intact"]
    assert not rows[len(good)]["intact"]
