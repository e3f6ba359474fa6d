"""Packing of tokenised documents into sequences by minimum bin slack.

The pieces are reduced to a histogram of their lengths, which has at most
``capacity`` entries whatever the size of the corpus.  Minimum bin slack runs
on that histogram: each bin is seeded with the longest length left, a subset
sum over the available lengths (a bitset in one integer) finds the fullest
feasible combination, and the combination is removed as often as the
histogram allows.  Each pattern uses up a length, so the number of patterns
is bounded by the histogram too.  Spark then numbers the pieces of each
length, and a piece's number decides its sequence and offset.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from basketlab.llm.common import id_and_text, text_slices, written

BUCKET_PIECES = 1 << 15  # pieces expected in one bucket, the unit that is numbered in one task


# ---------------------------------------------------------------- tokens
def word_encoder(path: str, max_words: int = 1_000_000) -> Callable[[str], bytes]:
    """Function from a text to its ids, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words.  Words are encoded once per task (the table of
    known words is emptied when it holds ``max_words``).  Words of Latin
    letters followed by plain punctuation go straight to the BPE model; all
    others take the tokenizer's whole path, where the strings of special
    tokens get their ids as in the library.
    """
    import re
    from array import array

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tokenize = tok.model.tokenize
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: these stand for themselves
    others = [b for b in range(256) if b not in set(printable)]
    letters = {b: chr(256 + i) for i, b in enumerate(others)}
    plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
    controls = re.compile("[\x1c-\x1f]").search  # white space for str.split but not for the tokenizer
    spaces = re.compile("[ \t\n\r\x0b\x0c]+")

    class Parts(dict):
        def __missing__(self, s: str) -> bytes:
            own = s if s.isascii() else s.encode().decode("latin-1").translate(letters)  # printable ASCII stands for itself
            self[s] = raw = array("I", [t.id for t in tokenize(own)]).tobytes()
            return raw

    class Words(dict):
        def __missing__(self, w: str) -> bytes:
            if m := plain(w):
                a, b = m.groups()
                raw = parts[a.lower()] + parts[b] if b else parts[a.lower()]
            else:
                raw = array("I", tok.encode(w, add_special_tokens=False).ids).tobytes()
            self[w] = raw
            return raw

    parts, words = Parts(), Words()
    if array("I").itemsize != 4 or sys.byteorder != "little":
        raise RuntimeError("ids need little-endian 32-bit integers")

    def encode(text: str) -> bytes:
        if len(words) >= max_words:
            words.clear()
        if len(parts) >= max_words:
            parts.clear()
        of = [w for w in spaces.split(text) if w] if controls(text) else text.split()
        return b"".join(map(words.__getitem__, of))

    return encode


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
           end_id: int | None = 1, with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    ``tokenizer`` is the path of the vocabulary file.  A document is its ids
    followed by ``end_id``; only longer ones than ``capacity`` are cut.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = id_and_text(docs, id_col, text_col)

    def cut(batches):
        import struct
        import zlib

        import numpy as np
        import pyarrow as pa

        encode = word_encoder(tokenizer)
        tail = b"" if end_id is None else struct.pack("<I", end_id)
        names = [c.split()[0] for c in schema.split(", ")]
        for ids, texts in text_slices(batches):
            out = [[] for _ in names]
            for doc, text in zip(ids, texts):
                raw = encode(text) + tail
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at:at + 4 * capacity]
                    row = [doc, k, at // 4, len(own) // 4, zlib.crc32(own)]
                    for col, v in zip(out, row + [np.frombuffer(own, "<u4").astype(np.int32)] * with_ids):
                        col.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return rows.mapInArrow(cut, schema)


# ---------------------------------------------------------------- minimum bin slack
def fullest(room: int, available: Counter) -> Counter:
    """The combination of available lengths with the largest sum within ``room``.

    Subset sum on a bitset: bit s of ``reach`` says that some combination has
    the sum s.  Long lengths go first and the search ends when ``room`` itself
    is reached.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in available if 0 < x <= room), reverse=True):
        left, unit = min(available[length], room // length), 1
        while left:
            unit = min(unit, left)
            steps.append((length, unit, reach))
            reach |= (reach << (length * unit)) & mask
            left, unit = left - unit, unit * 2
        if reach >> room & 1:
            break
    best, used = reach.bit_length() - 1, Counter()
    for length, unit, before in reversed(steps):
        if not before >> best & 1:
            used[length] += unit
            best -= length * unit
    return used


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(times, [(length, count), ...])`` that together use up the histogram."""
    left = Counter({k: v for k, v in histogram.items() if v > 0})
    out = []
    while left:
        seed = max(left)
        left[seed] -= 1
        used = fullest(capacity - seed, +left)
        left[seed] += 1
        used[seed] += 1
        times = min(left[x] // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * times
        left = +left
        out.append((times, sorted(used.items(), reverse=True)))
    return out


def slots(patterns) -> dict[int, tuple[list[int], list[int], list[int], list[int]]]:
    """Per length: first piece number, pieces per sequence, first sequence and offset of each pattern."""
    out: dict[int, tuple] = {}
    taken, base = Counter(), 0
    for times, items in patterns:
        offset = 0
        for length, count in items:
            own = out.setdefault(length, ([], [], [], []))
            for col, v in zip(own, (taken[length], count, base, offset)):
                col.append(v)
            taken[length] += count * times
            offset += count * length
        base += times
    return out


def number_within_length(cut: DataFrame) -> DataFrame:
    """Adds ``number``: 0, 1, ... for the pieces of each length.

    One length may hold most pieces, so they are numbered in hash buckets of
    bounded expected size and shifted by the counts of the buckets before.
    """
    buckets = max(1, -(-cut.count() // BUCKET_PIECES))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    counts = dealt.groupBy(F.col("length").alias("of_length"), F.col("bucket").alias("of_bucket")).agg(
        F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("of_length").orderBy("of_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("of_length", "of_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (dealt.withColumn("own", F.row_number().over(own) - 1)
            .join(shift, (F.col("length") == F.col("of_length")) & (F.col("bucket") == F.col("of_bucket")))
            .withColumn("number", F.col("own") + F.col("shift")).drop("own", "shift", "bucket", "of_length", "of_bucket"))


def best_fit_packing(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = 4096, end_id: int | None = 1) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    The pieces fill ``sequence_id`` 0, 1, ... without gaps from offset 0.
    Defined cases: a null or empty text has the ``end_id`` only; repeated rows
    and null ids are pieces like all others; an empty table gives no rows.
    """
    cut = written(pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces")
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(slots(minimum_bin_slack(histogram, capacity)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            length, number = (b.column(c).to_numpy() for c in ("length", "number"))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                first, count, base, offset = (np.asarray(c, np.int64) for c in plan.value[int(x)])
                at = np.flatnonzero(length == x)
                k = np.searchsorted(first, number[at], side="right") - 1
                nth = number[at] - first[k]
                seq[at], off[at] = base[k] + nth // count[k], offset[k] + nth % count[k] * x
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(seq), pa.array(off)],
                                             names=[*kept, "sequence_id", "offset"])

    return number_within_length(cut).mapInArrow(place, schema)


def packed_sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, id_col: str = "doc_id",
                     text_col: str = "text", capacity: int = 4096, end_id: int | None = 1) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids`` (at most ``capacity`` ids each).

    For documents with unique ids; ``packed`` is :func:`best_fit_packing` of the same documents.
    """
    ids = pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids=True)
    return (packed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
            .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids")))
