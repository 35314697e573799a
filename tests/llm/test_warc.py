import gzip
import hashlib
import os

import pytest

from tidemark.llm import warc as W
from tidemark.llm.common import scratch

SCHEMA = "page_id long, url string, html string, row long, payload string, first string, n int"
LONG = "x" * 150
ROWS = [(5, "http://a", LONG), (3, "http://b", LONG), (4, None, LONG), (None, "http://n", LONG), (3, "http://b", LONG),
        (6, "http://c", "short"), (7, "http://d", "short"), (8, "u\r\nWARC-Type: x", None), (9, "", ""), (None, None, None),
        (10, "http://e", "é" * 50), (11, "http://f", "é" * 50), (12, "http://g", "é" * 49), (13, "http://h", "é" * 49),
        (14, "x", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20), (15, "x", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20), (16, "x", "\r\n" * 300),
        (17, "x", "\n\r\n\r" * 40 + "\r"), (18, "x", "y" * 3_000_000), (19, "x", "y" * 3_000_000)]


def brute(rows):
    out, seen = [], {}
    for n, (i, _, html) in enumerate(rows):
        data = (html or "").encode()
        seen.setdefault(data, []).append((i is None, i or 0, n))
        out.append((i, len(data), hashlib.sha256(data).hexdigest()))
    result = []
    for n, (i, size, digest) in enumerate(out):
        first = min(seen[(rows[n][2] or "").encode()])
        again = size >= 100 and first[2] != n
        result.append((i, size, digest, "revisit" if again else "response", rows[first[2]][0] if again else None))
    return result


def key(row):
    return tuple((v is None, v) if v is None or not isinstance(v, str) else (False, v) for v in row)


def round_trip(spark, rows, **options):
    path = scratch(spark, "archives")
    df = spark.createDataFrame([(*r, 1, "p", "f", 2) for r in rows], SCHEMA)
    W.write_archives(df, path, **options)
    return path, W.resolved_records(W.read_archives(spark, path))


def test_records_equal_brute_force(spark):
    path, got = round_trip(spark, ROWS)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == sorted(brute(ROWS), key=str)


def test_files_are_warc(spark):
    path, _ = round_trip(spark, ROWS, records_per_file=3)
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".gz")]
    assert len(files) > 4
    data = b"".join(gzip.open(f"{path.removeprefix('file:')}/{f}").read() for f in files)
    records = list(W.parse_records(iter([data])))
    assert len(records) == len(ROWS)
    ids = {f["WARC-Record-ID"]: f for f, _ in records}
    assert len(ids) == len(ROWS)
    for fields, block in records:
        assert int(fields["Content-Length"]) == len(block)
        if fields["WARC-Type"] == "revisit":
            to = ids[fields["WARC-Refers-To"]]
            assert to["WARC-Type"] == "response" and to["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
            assert block.endswith(b"\r\n\r\n"), "a revisit holds headers and no payload"
            assert fields.get("WARC-Refers-To-Target-URI") == to.get("WARC-Target-URI")
        else:
            assert "sha256:" + hashlib.sha256(block.split(b"\r\n\r\n", 1)[1]).hexdigest() == fields["WARC-Payload-Digest"]
    assert sum(f["WARC-Type"] == "revisit" for f, _ in records) == 7


def test_payloads_come_back(spark):
    path, _ = round_trip(spark, ROWS)
    got = {bytes(r.payload) for r in W.read_archives(spark, path, payloads=True).collect() if r.payload is not None}
    assert got == {(r[2] or "").encode() for r in ROWS}


@pytest.mark.parametrize("cut", [1, 7, 64])
def test_parser_does_not_depend_on_the_cuts(cut):
    block = b"HTTP/1.1 200 OK\r\n\r\nbody\r\n"
    one = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    stream = one * 3
    pieces = [p for p in stream.split(b"\r\n\r\n")]
    assert [b for _, b in W.parse_records(iter(pieces))] == [block] * 3
    with pytest.raises(ValueError):
        list(W.parse_records(iter([stream[:len(stream) - 40 - cut]])))


def test_hot_digest_is_spread(spark):
    rows = [(i, "u", "z" * 200 if i % 3 == 0 else f"{i} " * 60) for i in range(3000)]
    _, got = round_trip(spark, rows)
    assert got.where("record_type = 'revisit' and refers_to = 0").count() == 999
    assert got.where("payload_bytes is null").count() == 0 and got.count() == 3000


def test_empty_and_text_ids(spark):
    _, got = round_trip(spark, [])
    assert got.count() == 0
    path = scratch(spark, "archives")
    W.write_archives(spark.createDataFrame([("p2", "u", LONG), ("p1", "u", LONG)], "page_id string, url string, html string"), path)
    got = {r.page_id: r.refers_to for r in W.resolved_records(W.read_archives(spark, path, id_type="string")).collect()}
    assert got == {"p1": None, "p2": "p1"}


def test_missing_response_stays_open(spark):
    path, _ = round_trip(spark, ROWS)
    lost = W.resolved_records(W.read_archives(spark, path).where("record_type = 'revisit'"))
    assert lost.count() == 7 and lost.where("payload_bytes is null and refers_to is null").count() == 7
