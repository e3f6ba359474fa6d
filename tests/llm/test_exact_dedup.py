import hashlib
import re

import pytest

from basketlab.llm.exact_dedup import exact_dedup, filter_bits

ROWS = [(5, "a  b"), (3, "a b"), (9, "a\t\nb"), (7, "a b "), (1, None), (2, ""), (4, "x"), (4, "x"), (None, "x"), (8, "é "),
        (10, " a b"), (11, "a b")]


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [4096, 1 << 20])  # a filter of one page lets more rows shuffle, with the same result
def test_against_brute_force(spark, size):
    rows = ROWS + [(100 + i, f"text {i % 70} {'y' * (i % 3)}") for i in range(300)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, keep_id string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(
        df, max_filter_bytes=size).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filter_size():
    assert filter_bits(0, 24, 1 << 20) == 4096 * 8
    assert filter_bits(10 ** 9, 24, 1 << 20) == (1 << 20) * 8
