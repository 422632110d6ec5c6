import hashlib
import base64
import os
import random
import zlib

import pytest

from check_oracle import compare, connect
from thermowatt.llm.warc import read_warc, record, warc_round_trip, write_warc

SF = "/root/testdata/sf0.001"
KIND = "page_id long, url string, html string, record_id int"


def pages():
    rng = random.Random(6)
    rows = [(i, f"http://x.example/{i} ü\n", "".join(rng.choice("abc <>\r\né") for _ in range(rng.randrange(3000))), 0) for i in range(60)]
    rows += [(100 + i, None, "same text", 0) for i in range(7)] + [(105, "u", "same text", 0)]
    return rows + [(200, "u", None, 0), (201, "u", "", 0), (None, "u", "same text", 0), (None, "u", "own", 0), (300, "u", "long " * 200_000, 0)]


def expected(rows, min_bytes=0):
    newest = {}
    for i, _, html, _ in rows:
        newest[html or ""] = max(newest.get(html or "", -1), -1 if i is None else i)
    out = []
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        to = newest[html or ""]
        revisit = len(raw) >= min_bytes and i != to and to >= 0
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def found(df):
    rows = df.select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("range_bytes", [97, 1000, 16 << 20])
@pytest.mark.parametrize("min_bytes", [0, 10])
def test_round_trip(spark, tmp_path, range_bytes, min_bytes):
    rows = pages()[:: 3 if range_bytes < 1000 else 1][:40] + pages()[60:70] if range_bytes < 1000 else pages()
    files = write_warc(spark.createDataFrame(rows, KIND), str(tmp_path / "w"), min_bytes)
    read = read_warc(files, range_bytes)
    assert found(read) == expected(rows, min_bytes)
    assert read.where("NOT intact").count() == 0
    texts = {r.record_id: bytes(r.payload).decode() for r in read.where("record_type = 'response' AND record_id < 60").collect()}
    assert texts == {i: html for i, _, html, _ in rows if i is not None and i < 60}


def test_records_inside_a_record_are_left_out(spark, tmp_path):
    inner = b"".join(record(i, "u", os.urandom(300), None) for i in range(900, 906))
    outer = [record(1, "u", b"first", None), record(2, "u", os.urandom(50) + inner + os.urandom(700), None), record(3, "u", b"last", None)]
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so that the inner magic shows
    head = zlib.decompress(outer[1], 31)
    outer[1] = stored.compress(head) + stored.flush()
    (tmp_path / "a.warc.gz").write_bytes(b"".join(outer))
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"), sum(map(len, outer)))], "path string, length long")
    for size in (64, 300, 1 << 20):
        assert [r[0] for r in found(read_warc(files, size))] == [1, 2, 3]


def test_damage_costs_the_damaged_record_only(spark, tmp_path):
    members = [record(i, "u", f"payload {i}".encode() * 20, None) for i in range(6)]
    members[2] = members[2][:40] + b"\0\0\0" + members[2][43:]
    members.insert(4, b"noise \x1f\x8b\x08 noise")
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members) + members[0][:50])
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"), len(b"".join(members)) + 50)], "path string, length long")
    assert [r[0] for r in found(read_warc(files, 100))] == [0, 1, 3, 4, 5]


def test_no_rows(spark, tmp_path):
    assert read_warc(write_warc(spark.createDataFrame([], KIND), str(tmp_path / "w"))).collect() == []


def test_same_rows_as_sql(spark):
    assert compare(spark, connect(SF), "op4_warc", SF) is None


def test_headers_of_any_length(spark):
    urls = {1: "http://a.example/" + "x" * 100_000, 2: "data:text/html," + "é" * 40_000, 3: "http://a.example/"}
    df = spark.createDataFrame([(i, u, f"page {i % 2}") for i, u in urls.items()], "page_id long, url string, html string")
    found = {r.record_id: r for r in warc_round_trip(spark, df).collect()}
    assert found.keys() == urls.keys()
    assert {i: len(r.target) for i, r in found.items()} == {1: 100_017, 2: 15 + 6 * 40_000, 3: 17}
    assert all(r.intact for r in found.values()) and found[1].refers_to == 3
