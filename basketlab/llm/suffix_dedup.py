"""Removal of long repeated byte strings with a logarithmic family of fingerprint indexes.

Every string of ``match`` bytes holds anchors: the position whose ``gram``
bytes have the smallest hash.  Equal strings have equal anchors, so it is
enough to index the suffixes at anchors instead of all suffixes.  Consecutive
strings with the same anchor form a *run*; an entry of an index stands
for one run and is ordered by two 64-bit fingerprints: of the anchor's gram
(``k0``) and of all bytes of the run (``k1``), not by the bytes themselves, so
this is no suffix array in the strict sense.

Batches of documents get an index each, built where the texts are read.
The entries are dealt to shards by their gram.  A shard keeps a family of
indexes: a new batch's entries are looked up in the levels present, and
levels of equal size merge, so n batches leave at most log2(n) levels.  An
entry found in a level repeats an earlier run byte for byte.  Runs that share
only their gram with other runs may still hold equal strings: their strings
are taken one by one through a second family, whose entries are single
strings.  The result is exact (up to collisions of 128-bit fingerprints).

Skew: a batch passes on each distinct run once, so copies reach a shard at most
once per batch; a gram with more than ``HOT`` different runs in one batch is
dealt by the whole entry instead, with a marker that tells the gram's own
shard that its runs are shared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from basketlab.llm.common import release, written

MATCH = 100  # bytes of a repeated string
GRAM = 40  # bytes of an anchor
HOT = 8  # different runs of one gram in one batch
SHARD_BYTES = 64 << 20  # text indexed by one shard
BATCH_BYTES = 24 << 20  # text of one suffix array
SLICE_BYTES = 1 << 19  # text hashed at once, so that the arrays stay in the cache

ENTRY, REPEAT, SHARED, MARK = range(4)  # kinds of row
ROW = "k0 long, k1 long, doc long, meta long"  # meta: start << 12 | strings of the run << 2 | kind
FOUND = "doc long, start long, n long, repeat boolean"


# ---------------------------------------------------------------- fingerprints
class Hasher:
    """Polynomial fingerprints modulo 2**64 of substrings, from prefix sums."""

    def __init__(self, seed: int):
        import numpy as np
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.size = 0

    def load(self, data) -> None:
        """Take the bytes whose substrings are asked for."""
        import numpy as np
        if len(data) >= self.size:
            self.size = max(2 * len(data), SLICE_BYTES * 2)
            for name, b in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                f = np.full(self.size, b % (1 << 64), np.uint64)
                f[0] = 1
                setattr(self, name, np.multiply.accumulate(f))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=self.sums[1:])

    def every(self, length: int):
        """Fingerprints of all substrings of one length."""
        d = self.sums[length:] - self.sums[:-length]
        d *= self.down[:len(d)]
        return mixed(d)

    def some(self, start, length):
        """Fingerprints of the substrings at ``start``; ``length`` may differ."""
        return mixed((self.sums[start + length] - self.sums[start]) * self.down[start])


def mixed(x):
    import numpy as np
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def runs_of(raw: list[bytes], hasher: Hasher, match: int, gram: int):
    """Runs of the texts of at least ``match`` bytes: text number, start, strings, k0, k1."""
    import numpy as np
    data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(x) for x in raw])
    ends = np.cumsum(sizes)
    hasher.load(data)
    grams = hasher.every(gram)
    bits = np.uint64(len(data).bit_length())
    keys = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)  # the leftmost of equal hashes wins
    width, have = match - gram + 1, 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    strings = len(data) - match + 1
    anchor = np.minimum(keys[:strings], keys[width - have:width - have + strings]) & ((np.uint64(1) << bits) - np.uint64(1))
    inside = np.ones(strings, bool)
    for e in ends[:-1].tolist():  # strings never cross texts
        inside[e - match + 1:e] = False
    at = np.flatnonzero(inside)
    anchor = anchor[at].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    n = np.diff(np.append(first, len(at)))
    start, anchor = at[first], anchor[first]
    shape = (n.astype(np.uint64) << np.uint64(20)) + (anchor - start).astype(np.uint64)
    k1 = hasher.some(start, match + n - 1) + shape * np.uint64(0x9E3779B97F4A7C15)
    text = np.searchsorted(ends, start, side="right")
    return text, start - (ends - sizes)[text], n, grams[anchor], k1


# ---------------------------------------------------------------- suffix arrays
def first_of(*sorted_columns):
    """Whether each row of sorted columns differs from the row before."""
    import numpy as np
    out = np.ones(len(sorted_columns[0]), bool)
    if len(out) > 1:
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return out


def suffix_array(k0, k1, doc, meta):
    """Sort entries; of equal ones the first (by document and start) stands, the others repeat it.

    Returns the sorted array, the mask of entries that stand, and the order.
    """
    import numpy as np
    order = np.lexsort((meta, doc, k1, k0))
    a = [c[order] for c in (k0, k1, doc, meta)]
    return a, first_of(a[0], a[1]), order


def batch_rows(k0, k1, doc, meta):
    """What a batch passes on, as columns of ``ROW``; ``meta`` of the input has kind ENTRY."""
    import numpy as np
    (k0, k1, doc, meta), stands, _ = suffix_array(k0, k1, doc, meta)
    group = np.cumsum(first_of(k0)) - 1
    hot = (np.bincount(group, weights=stands) > HOT)[group] if len(group) else stands
    meta = meta | np.where(stands, np.where(hot, SHARED, ENTRY), REPEAT)
    mark = hot & first_of(k0)
    return [np.concatenate([c, c[mark]]) for c in (k0, k1, doc)] + [np.concatenate([meta, np.full(mark.sum(), MARK)])]


class Family:
    """Levels of suffix arrays (k0, k1, doc, meta), each about twice as large as the next."""

    def __init__(self):
        self.levels: list[tuple[int, list]] = []  # (batches merged, sorted columns)

    def known(self, k0, k1):
        """Merge scan: which of the sorted keys are in a level."""
        import numpy as np
        found = np.zeros(len(k0), bool)
        for _, (a0, a1, _, _) in self.levels:
            lo, end = np.searchsorted(a0, k0, "left"), np.searchsorted(a0, k0, "right")
            # the entries of a gram are sorted by k1: halve all stretches together, so that many runs of one gram
            # (up to HOT of every batch) cost the logarithm of their number
            hi = end.copy()
            live = np.flatnonzero((lo < hi) & ~found)
            while len(live):
                mid = (lo[live] + hi[live]) // 2
                below = a1[mid] < k1[live]
                lo[live[below]], hi[live[~below]] = mid[below] + 1, mid[~below]
                live = live[lo[live] < hi[live]]
            at = np.flatnonzero((lo < end) & ~found)
            found[at] = a1[lo[at]] == k1[at]
        return found

    def add(self, array: list) -> None:
        """New lowest level; levels of equal rank merge."""
        import numpy as np
        rank = 1
        while self.levels and self.levels[-1][0] <= rank:
            r, other = self.levels.pop()
            array = [np.concatenate(c) for c in zip(other, array)]
            order = np.lexsort((array[1], array[0]))
            array = [c[order] for c in array]
            rank += r
        self.levels.append((rank, array))

    def all(self) -> list:
        import numpy as np
        array = [np.concatenate(c) for c in zip(*(a for _, a in self.levels))]
        order = np.lexsort((array[1], array[0]))
        return [c[order] for c in array]


def scan_shard(batches, rows: int = 1 << 16):
    """One shard: repeats as they are found, and at the end the entries that share their gram.

    ``batches`` are Arrow batches of ``ROW`` in the order of documents.
    """
    import numpy as np
    import pyarrow as pa

    def out(doc, meta, repeat):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(meta >> 12), pa.array(meta >> 2 & 1023), pa.array(np.full(len(doc), repeat))],
            names=["doc", "start", "n", "repeat"])

    family, marked, held = Family(), [], []

    def take():
        k0, k1, doc, meta = (np.concatenate(c) for c in zip(*held))
        held.clear()
        kind = meta & 3
        marked.append(np.unique(k0[kind == MARK]))
        told = kind == REPEAT
        own = (kind == ENTRY) | (kind == SHARED)
        a, stands, _ = suffix_array(k0[own], k1[own], doc[own], meta[own])
        new = stands.copy()
        new[stands] = ~family.known(a[0][stands], a[1][stands])
        family.add([c[new] for c in a])
        return out(np.concatenate([doc[told], a[2][~new]]), np.concatenate([meta[told], a[3][~new]]), True)

    count = 0
    for b in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
        count += b.num_rows
        if count >= rows:
            yield take()
            count = 0
    if held:
        yield take()
    if family.levels:
        k0, _, doc, meta = family.all()
        group = np.cumsum(first_of(k0)) - 1
        shared = (np.bincount(group) > 1)[group] if len(group) else np.zeros(0, bool)
        shared |= (meta & 3) == SHARED
        shared |= np.isin(k0, np.concatenate(marked))
        yield out(doc[shared], meta[shared], False)


# ---------------------------------------------------------------- operator
def scanned(rows: DataFrame, shards: int) -> DataFrame:
    """Deal rows of ``ROW`` to shards and scan each shard's family: ``FOUND``."""
    kind: Column = F.col("meta").bitwiseAND(3)
    key = F.when(kind == REPEAT, F.col("doc")).when(kind == SHARED, F.xxhash64("k0", "k1")).otherwise(F.col("k0"))
    return rows.repartition(shards, key).sortWithinPartitions("doc", "meta").mapInArrow(scan_shard, FOUND)


def with_unique_ids(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with ``doc``, which orders them and is unique, and the ids of ``doc`` if they differ.

    Usually ``doc`` is the id itself.  Only where ids repeat or are null the rows
    are sorted (null ids first, then by text) and numbered.
    """
    ids = rows.select(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if ids.n == ids.d:
        return rows.withColumnRenamed("doc_id", "doc").filter("doc IS NOT NULL"), None
    numbered = written(rows.orderBy("doc_id", "text").withColumn("doc", F.monotonically_increasing_id()), "numbered")
    return numbered.drop("doc_id").filter("doc IS NOT NULL"), numbered.select(F.col("doc").alias("of"), "doc_id")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH,
                   gram: int = GRAM, carry: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, spans, kept``.

    Removes each byte (UTF-8) covered by a string of ``match`` bytes that also
    starts earlier, in a document with a smaller id or further ahead in the
    same one.  ``spans`` are the maximal removed runs as (start, end), ``kept``
    the other bytes; with ``as_text`` it is a string, without the bytes that a
    cut inside a character has left of it.  The columns named in ``carry`` come
    back in the struct ``row``.  Defined cases: a null text counts as empty; texts
    shorter than ``match`` stay whole; rows with equal or null ids are
    separate documents, ordered by their texts, null ids first; an empty table
    gives no rows.
    """
    if not 0 < gram < match or match - gram + 1 > 1023:
        raise ValueError("gram must be shorter than match, by less than 1023")
    row = [F.struct(*carry).alias("row")] if carry else []
    texts, ids_of = with_unique_ids(docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *row))
    rest = texts.select("row").schema.fields if carry else []
    total = texts.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))

    def arrays(columns_of):
        """Task function: pass on the suffix array of every BATCH_BYTES of text."""
        def run(batches):
            import numpy as np
            import pyarrow as pa
            held, size = [], 0
            for columns, n_bytes in columns_of(batches):
                held.append(columns)
                size += n_bytes
                if size >= BATCH_BYTES:
                    yield rows_of(held, np, pa)
                    held, size = [], 0
            if held:
                yield rows_of(held, np, pa)

        def rows_of(held, np, pa):
            cols = batch_rows(*(np.concatenate(c) for c in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], names=["k0", "k1", "doc", "meta"])
        return run

    def run_columns(batches):
        import numpy as np

        from basketlab.llm.common import text_slices
        hasher = Hasher(1)
        for ids, own in text_slices(batches, SLICE_BYTES):
            raw = [t.encode() for t in own]
            long = [i for i, t in enumerate(raw) if len(t) >= match]
            if long:
                text, start, n, k0, k1 = runs_of([raw[i] for i in long], hasher, match, gram)
                doc = np.array([ids[i] for i in long], np.int64)[text]
                yield [k0.view(np.int64), k1.view(np.int64), doc, (start << 12) | (n << 2)], sum(map(len, raw))

    def string_columns(batches):
        """Single strings of the runs listed with each text."""
        import numpy as np
        one, two = Hasher(2), Hasher(3)
        for b in batches:
            for doc, text, own in zip(*(b.column(c).to_pylist() for c in ("doc", "text", "own"))):
                data = np.frombuffer(text.encode(), np.uint8)
                start = np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in own])
                one.load(data)
                two.load(data)
                # 96 bits tell single strings apart; the shorter second column compresses better
                yield [one.some(start, match).view(np.int64), (two.some(start, match) >> np.uint64(32)).view(np.int64),
                       np.full(len(start), doc), (start << 12) | 4], 24 * len(start)

    runs = written(scanned(texts.select("doc", "text").mapInArrow(arrays(run_columns), ROW), shards), "runs")
    release(docs.sparkSession)
    shared = (runs.filter(~F.col("repeat")).groupBy(F.col("doc").alias("of")).agg(
        F.collect_list(F.struct("start", "n")).alias("own")))
    strings = (texts.join(shared, F.col("doc") == F.col("of")).drop("of")
               .mapInArrow(arrays(string_columns), ROW))
    repeats = runs.filter("repeat").select("doc", "start", "n").unionByName(
        scanned(strings, shards).filter("repeat").select("doc", "start", "n"))
    spans = repeats.groupBy(F.col("doc").alias("of")).agg(F.collect_list(F.struct("start", "n")).alias("own"))

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            out = [[], [], [], []]
            for text, own in zip(b.column("text").to_pylist(), b.column("own").to_pylist()):
                raw, merged, kept, end = text.encode(), [], [], 0
                if own:
                    start = np.array([r["start"] for r in own])
                    stop = start + np.array([r["n"] for r in own]) + match - 1
                    order = np.argsort(start, kind="stable")
                    start, stop = start[order], np.maximum.accumulate(stop[order])
                    new = np.concatenate([[True], start[1:] > stop[:-1]])
                    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])
                    merged = list(zip(start[new].tolist(), stop[last].tolist()))
                for s, e in merged:
                    kept.append(raw[end:s])
                    end = e
                kept.append(raw[end:])
                left = b"".join(kept)
                for col, v in zip(out, (len(raw), sum(e - s for s, e in merged), [{"start": s, "end": e} for s, e in merged],
                                        left.decode("utf-8", "ignore") if as_text else left)):
                    col.append(v)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(span)),
                 pa.array(out[3], pa.string() if as_text else pa.binary()), *([b.column("row")] if carry else [])],
                names=["doc", "n_bytes", "n_removed", "spans", "kept", *(["row"] if carry else [])])

    schema = T.StructType([
        T.StructField("doc", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.StringType() if as_text else T.BinaryType()), *rest])
    # the same columns of the texts as above, so that one exchange of them serves both joins
    out = texts.join(spans, F.col("doc") == F.col("of"), "left").drop("of").mapInArrow(cut, schema)
    if ids_of is None:
        return out.withColumnRenamed("doc", "doc_id")
    return out.join(ids_of, F.col("doc") == F.col("of")).select("doc_id", *schema.names[1:])
