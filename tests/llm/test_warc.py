import base64
import gzip
import hashlib
import io
import re

import pytest

from basketlab.llm.warc import archive_round_trip, read_records, record, write_warc


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_record_round_trip():
    payloads = [b"", b"x", "é\r\n\r\nWARC/1.1\r\n".encode() * 50, bytes(range(256)) * 4000]
    raw = b"".join(record(i, f"http://a/{i} b", p) for i, p in enumerate(payloads))
    raw += record(9, None, payloads[2], 2, "http://a/2", True)
    got = list(read_records(io.BytesIO(raw), keep_payload=True))
    assert [r["payload"] for r in got] == [*payloads, b""]
    assert [r.get("payload_digest") for r in got[:4]] == [sha(p) for p in payloads]
    assert [r.get("payload_bytes") for r in got[:4]] == [len(p) for p in payloads]
    assert got[4]["warc-type"] == "revisit" and got[4]["warc-refers-to"] == record_id(payloads[2])
    assert got[0]["warc-target-uri"] == "http://a/0%20b"
    # every record is a gzip member of its own
    assert gzip.decompress(record(0, "u", b"abc")).startswith(b"WARC/1.1\r\n")


def record_id(payload):
    raw = gzip.decompress(record(2, "http://a/2", payload)).decode("utf-8", "replace")
    return raw.split("WARC-Record-ID: ")[1].split("\r\n")[0]


def test_damage_is_found():
    good = gzip.decompress(record(1, "u", b"payload here"))
    for bad in (good.replace(b"payload here", b"payload HERE"), re.sub(rb"(Content-Type: application[^\r]*\r\nContent-Length: )\d+", rb"\g<1>7", good),
                good[:-3], good[:40], b"junk\r\n\r\n" + good):
        with pytest.raises((ValueError, KeyError)):
            list(read_records(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(record(1, "u", b"payload here")[:-9])))
    assert list(read_records(io.BytesIO(b""))) == []


ROWS = [(4, "u4", "same"), (2, "u2", "same"), (7, "u7", "same"), (1, None, None), (3, "é\n", ""), (5, "u", "long " * 50000),
        (6, "u", "long " * 50000), (8, "u8", "only"), (None, "n", "same"), (9, "t", "twice"), (9, "t", "twice")]


@pytest.mark.parametrize("least", [0, 5])
def test_against_brute_force(spark, least):
    df = spark.createDataFrame([(*r, "c") for r in ROWS], "page_id long, url string, html string, refers_to string")
    got = archive_round_trip(df, min_payload=least).collect()
    want = []
    for i, u, h in ROWS:
        b = (h or "").encode()
        first = min(((j is None, j or 0, v or "") for j, v, x in ROWS if (x or "").encode() == b))
        response = len(b) < least or (i is None, i or 0, u or "") == first
        want.append((i, len(b), sha(b), "response" if response else "revisit", None if response else first[1]))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)


def test_files_and_empty(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    table = write_warc(df, str(tmp_path / "w"))
    assert table.selectExpr("sum(records) AS n").first().n == len(ROWS)
    found = [r for p in (tmp_path / "w").glob("*.warc.gz") for r in read_records(p.open("rb"))]
    assert len(found) == len(ROWS)
    assert archive_round_trip(df.limit(0)).count() == 0
