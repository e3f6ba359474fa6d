"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

A document is the weighted set of its word shingles (a weight is the number of
times the shingle occurs).  Each shingle emits arrivals of a Poisson process
whose rate is its weight; an arrival lands in a random register, which keeps the
earliest arrival and the shingle it came from.  A shingle stops as soon as its
next arrival is later than all registers of its document.  Two documents agree
in a register with probability equal to their probability Jaccard likeness J_P.

Bands of registers make buckets.  A pair in a common bucket is a candidate; four
bits of each register give an estimate that drops pairs far below the
threshold, and the others are verified with the exact J_P of their whole texts.
No bucket is expanded into all its pairs: in a few rounds its members are
compared with one leader (the member that meets most others first, then another
one), and linked documents become one component.  What then still lies in
different components of a bucket meets in *block tasks*: a bucket is dealt into
blocks, and one task compares two blocks and sends links only, no pairs.  A first
set of tasks compares signatures and names the members that have a candidate; only
their texts go to a second set, which verifies the candidates and skips those that
its own links have joined already.  A pair is looked at in the lowest of its common buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlab.llm.common import id_and_text, text_slices, written
from basketlab.llm.suffix_dedup import Hasher, first_of, mixed

WORDS = 5
THRESHOLD = 0.8
BANDS = 28  # with 6 registers each: a pair of likeness 0.8 shares a band with probability 0.9998
BAND_ROWS = 6
ROUNDS = 2  # leaders per bucket before the rest is compared pair by pair
BLOCK_ROWS = 2048  # members of a bucket that meet in one task, about
BLOCK_BYTES = 32 << 20  # their text, about
SLACK = 0.12  # nearly four standard deviations of the estimate at the threshold
FINE_REGISTERS = 510  # of the signatures made for the documents that are compared pair by pair
FINE_SLACK = 0.07  # the same for their estimate
FIELDS = 15  # four-bit fields of a long; the top bits stay 0, so that sums don't overflow


# ---------------------------------------------------------------- weighted shingles
def weighted_shingles(texts: list[str], hasher: Hasher, words: int = WORDS):
    """Text number, hash and weight of every distinct shingle, sorted by text and hash.

    Words end at ASCII white space.  A text of fewer words is one shingle, a
    blank one none.
    """
    import numpy as np
    raw = [t.encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(x) for x in raw])
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # the last byte is a space
    hasher.load(data)
    word = hasher.some(start, stop - start) + (stop - start).astype(np.uint64)
    text = np.searchsorted(ends, start, side="right")
    n_words = np.bincount(text, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    total = np.zeros(len(word), np.uint64)
    inside = np.arange(len(word)) - first[text]
    for k in range(words):  # words beyond the text's end count as 0
        live = np.flatnonzero(inside + k < n_words[text])
        total[live] += mixed(word[live + k] + np.uint64(k)) * np.uint64(2 * k + 1)
    own = inside <= np.maximum(n_words[text] - words, 0)
    text, total = text[own], mixed(total[own])
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    new = np.flatnonzero(first_of(text, total))
    return text[new], total[new], np.diff(np.append(new, len(text))).astype(float)


def likeness(a, wa, b, wb) -> float:
    """Probability Jaccard of two weighted sets (sorted distinct hashes and weights); 1 for two empty sets.

    J_P = sum over common d of 1 / sum over e of max(wa[e] / wa[d], wb[e] / wb[d]).
    For a given d the first term is the larger one exactly for the e whose
    ratio wa[e] / wb[e] is at least that of d, so prefix sums over the sorted
    ratios give every inner sum.
    """
    import numpy as np
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    every = np.union1d(a, b)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a)] = wa
    y[np.searchsorted(every, b)] = wb
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    from_x = np.append(np.cumsum(x[::-1])[::-1], 0)
    upto_y = np.concatenate([[0], np.cumsum(y)])
    d = np.flatnonzero((x > 0) & (y > 0))
    at = np.searchsorted(ratio, ratio[d], side="left")
    return float((1 / (from_x[at] / x[d] + upto_y[at] / y[d])).sum())


# ---------------------------------------------------------------- signatures
def prob_minhash(text, shingle, weight, n_texts: int, registers: int):
    """Signatures: per text and register the shingle whose arrival came first (0 where there is none)."""
    import numpy as np
    earliest = np.full(n_texts * registers, np.inf)
    winner = np.zeros(n_texts * registers, np.uint64)
    time, step = np.zeros(len(text)), 0
    while len(text):
        step += 1
        draw = mixed(shingle + np.uint64(0x9E3779B97F4A7C15 * step % (1 << 64)))
        # 40 bits for the waiting time, 24 others for the register
        time = time - np.log(((draw >> np.uint64(24)).astype(float) + 1) / float(1 << 40)) / weight
        slot = text * registers + ((draw & np.uint64(0xFFFFFF)) % np.uint64(registers)).astype(np.int64)
        won = np.flatnonzero(time < earliest[slot])
        np.minimum.at(earliest, slot[won], time[won])
        won = won[earliest[slot[won]] == time[won]]
        winner[slot[won]] = shingle[won]
        latest = earliest.reshape(n_texts, registers).max(axis=1)
        live = time < latest[text]
        text, shingle, weight, time = text[live], shingle[live], weight[live], time[live]
    return winner.reshape(n_texts, registers)


def signatures(rows: DataFrame, words: int, bands: int, band_rows: int) -> DataFrame:
    """``doc_id, sha, bands, bits``: digest of the text, band hashes and four bits per register.

    Blank texts have null bands.
    """
    registers = bands * band_rows

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        hasher = Hasher(5)
        for ids, texts in text_slices(batches, 1 << 20):
            text, shingle, weight = weighted_shingles(texts, hasher, words)
            won = prob_minhash(text, shingle, weight, len(texts), registers)
            band = np.zeros((len(texts), bands), np.uint64)
            for k in range(band_rows):
                band = mixed(band * np.uint64(0xD6E8FEB86659FD93) + won[:, k * bands:(k + 1) * bands])
            four = mixed(won + np.uint64(9)) & np.uint64(15)
            four = np.pad(four, ((0, 0), (0, -registers % FIELDS))).reshape(len(texts), -1, FIELDS)
            bit = (four << (np.uint64(4) * np.arange(FIELDS, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)
            full = np.bincount(text, minlength=len(texts)) > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()),
                 pa.array([b.view(np.int64) if f else None for b, f in zip(band, full)], pa.list_(pa.int64())),
                 pa.array(list(bit), pa.list_(pa.int64()))], names=["doc_id", "sha", "bands", "bits"])

    return rows.mapInArrow(run, "doc_id long, sha binary, bands array<long>, bits array<long>")


def estimate(a: str, b: str, registers: int):
    """Likeness estimated from four bits per register: unrelated registers agree once in 16 times."""
    low, high = (int(d * FIELDS, 16) for d in "78")

    def unequal(i: int):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        return F.bit_count((x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(high))  # a bit per field that isn't 0

    differ = sum((unequal(i) for i in range(-(-registers // FIELDS))), F.lit(0))
    return 1 - differ / registers * 16 / 15


def verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose whole texts have a likeness of ``threshold`` or more, written."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")

    def run(batches):
        import numpy as np
        import pyarrow as pa
        hasher = Hasher(5)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                own = batch.slice(at, 256)
                flat = [t for x in zip(own.column("text_a").to_pylist(), own.column("text_b").to_pylist()) for t in x]
                text, shingle, weight = weighted_shingles(flat, hasher, words)
                ends = np.searchsorted(text, np.arange(len(flat) + 1))
                part = lambda i: (shingle[ends[i]:ends[i + 1]], weight[ends[i]:ends[i + 1]])
                good = [likeness(*part(2 * i), *part(2 * i + 1)) >= threshold for i in range(own.num_rows)]
                yield pa.RecordBatch.from_arrays([own.column("a"), own.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return written(both.mapInArrow(run, "a long, b long"), "links")


# ---------------------------------------------------------------- components
def components(links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable by links ``a, b``, for every id in a link.

    Each round takes the smallest label among the neighbours and then the
    label of that label; the labels are written every round.
    """
    ends = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "ends")
    labels = written(ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                     .select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = (ends.join(labels, ends.b == labels.id).groupBy(F.col("a").alias("of")).agg(F.min("component").alias("m")))
        step = labels.join(near, labels.id == F.col("of")).select("id", F.col("component").alias("old"),
                                                                  F.least("component", "m").alias("new"))
        jump = labels.select(F.col("id").alias("at"), F.col("component").alias("further"))
        moved = written(step.join(jump, step.new == jump["at"], "left")
                        .select("id", "old", F.least("new", F.coalesce("further", "new")).alias("component")), "labels")
        labels = moved.select("id", "component")
        if moved.filter("old <> component").isEmpty():
            return labels


def with_component(rows: DataFrame, found: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the component of ``column``; an id without links is its own."""
    of = found.select(F.col("id").alias("id_"), F.col("component").alias("component_"))
    return (rows.join(of, F.col(column) == F.col("id_"), "left")
            .withColumn(name, F.coalesce("component_", column)).drop("id_", "component_"))


def merged_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` after more links: the graph of the linked components only is searched."""
    ends = with_component(with_component(links, found, "a", "of_a"), found, "b", "of_b")
    further = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct())
    known = found.unionByName(ends.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("of_a").alias("component")),
                                                            F.struct(F.col("b").alias("id"), F.col("of_b").alias("component"))))
                                          .alias("x")).select("x.*")).distinct()
    new = further.select(F.col("id").alias("old_"), F.col("component").alias("new_"))
    return written(known.join(new, F.col("component") == F.col("old_"), "left")
                   .select("id", F.coalesce("new_", "component").alias("component")), "components")


# ---------------------------------------------------------------- operator
def members(buckets: DataFrame) -> DataFrame:
    """``key, id, n`` of the buckets that hold two ids or more; written."""
    sizes = buckets.groupBy(F.col("key").alias("of")).agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return written(buckets.join(sizes, F.col("key") == F.col("of")).select("key", "id", "n"), "buckets")


def undecided(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """The buckets that hold several components."""
    keys = (with_component(buckets, found, "id", "component").groupBy(F.col("key").alias("of"))
            .agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("of"))
    return written(buckets.join(keys, F.col("key") == F.col("of"), "left_semi"), "undecided")


def differing(a, b):
    """Number of four-bit fields in which each row of ``b`` differs from the row ``a``."""
    import numpy as np
    low, high = (np.uint64(int(d * FIELDS, 16)) for d in "78")
    x = a ^ b
    return np.bitwise_count((((x & low) + low) | x) & high).sum(axis=1, dtype=np.int64)


def block_keys(still: DataFrame, found: DataFrame, sizes: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """``key, i, j, left, id, component, keys``: the members of each block task, i <= j; written.

    A bucket is dealt into blocks of about ``block_rows`` / 2 members and ``block_bytes`` / 2 of text,
    and each two of its blocks, also a block and itself, meet in a task of their own: the
    rows of block i are on its left side, those of block j on its right.  Tasks that
    hold one component only are left out.  ``keys`` are all undecided buckets of a member.
    """
    own = still.join(sizes, "id")
    total = own.groupBy(F.col("key").alias("of")).agg(F.sum("size").alias("bytes"))
    keys = still.groupBy(F.col("id").alias("member")).agg(F.sort_array(F.collect_set("key")).alias("keys"))  # at most one a band
    count = F.greatest(F.ceil(F.col("n") * 2 / block_rows), F.ceil(F.col("bytes") * 2 / block_bytes))
    dealt = (with_component(own.join(total, F.col("key") == F.col("of")).join(keys, F.col("id") == F.col("member")), found, "id", "component")
             .withColumn("count", count).withColumn("own", F.pmod(F.xxhash64("id", F.lit(11)), "count"))
             .select("key", "count", "own", "id", "component", "keys"))
    left = dealt.select("key", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("count") - 1)).alias("j"),
                        F.lit(True).alias("left"), "id", "component", "keys")
    right = (dealt.filter("own > 0").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("own") - 1)).alias("i"), F.col("own").alias("j"),
                                            F.lit(False).alias("left"), "id", "component", "keys"))
    both = written(left.unionByName(right), "block_members")
    several = (both.groupBy("key", "i", "j").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
               .select("key", "i", "j"))
    return written(both.join(several, ["key", "i", "j"], "left_semi"), "blocks")


def close_pairs(table, registers: int, fine_registers: int, threshold: float):
    """Row numbers and finer estimate of the pairs of a block task that are candidates, nearest first.

    They are of different components, have this bucket as the lowest of their
    common ones, and neither estimate is far below the threshold.
    """
    import numpy as np
    key = table.column("key")[0].as_py()
    same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    left = table.column("left").to_numpy(zero_copy_only=False)
    component = table.column("component").to_numpy()
    bits, fine = (np.array(table.column(c).to_pylist(), np.int64).view(np.uint64) for c in ("bits", "fine"))
    before = [set(k[:k.index(key)]) for k in table.column("keys").to_pylist()]
    one, two = (np.arange(len(left)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
    out = []
    for k, a in enumerate(one.tolist()):
        other = two[k + 1:] if same else two
        other = other[component[other] != component[a]]
        other = other[1 - differing(bits[a], bits[other]) / registers * 16 / 15 >= threshold - SLACK]
        estimate = 1 - differing(fine[a], fine[other]) / fine_registers * 16 / 15
        near = estimate >= threshold - FINE_SLACK
        out += [(-e, a, b) for e, b in zip(estimate[near].tolist(), other[near].tolist()) if before[a].isdisjoint(before[b])]
    return sorted(out)


def block_links(members: DataFrame, marks: DataFrame, texts: DataFrame, words: int, threshold: float, registers: int) -> DataFrame:
    """The links ``a, b`` that the block tasks find; written.

    ``marks`` has the signatures ``bits`` and ``fine`` of every member.
    """
    signed = members.join(marks, "id").select("key", "i", "j", "left", "id", "component", "keys", "bits", "fine")

    def named(table):
        import pyarrow as pa
        rows = sorted({k for _, a, b in close_pairs(table, registers, FINE_REGISTERS, threshold) for k in (a, b)})
        return table.select(["key", "i", "j", "id"]).take(pa.array(rows, pa.int64()))

    chosen = written(signed.groupBy("key", "i", "j").applyInArrow(named, "key long, i long, j long, id long"), "named")
    full = signed.join(chosen, ["key", "i", "j", "id"], "left_semi").join(texts, "id")

    def links(table):
        import numpy as np
        import pyarrow as pa
        hasher, ids = Hasher(5), table.column("id").to_pylist()
        column, sets = table.column("text"), []
        for at in range(0, len(ids), 64):
            text, shingle, weight = weighted_shingles(column.slice(at, 64).to_pylist(), hasher, words)
            ends = np.searchsorted(text, np.arange(min(64, len(ids) - at) + 1))
            sets += [(shingle[a:b], weight[a:b]) for a, b in zip(ends, ends[1:])]
        group = dict.fromkeys(range(len(ids)))
        first: dict[int, int] = {}
        for k, c in enumerate(table.column("component").to_pylist()):
            group[k] = first.setdefault(c, k)

        def root(k: int) -> int:
            while group[k] != k:
                group[k] = k = group[group[k]]
            return k

        out = []
        for _, a, b in close_pairs(table, registers, FINE_REGISTERS, threshold):
            if root(a) != root(b) and likeness(*sets[a], *sets[b]) >= threshold:
                group[root(a)] = root(b)
                out.append((ids[a], ids[b]))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    columns = ["key", "i", "j", "left", "id", "component", "keys", "bits", "fine", "text"]
    return written(full.select(*columns).groupBy("key", "i", "j").applyInArrow(links, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    words: int = WORDS, bands: int = BANDS, band_rows: int = BAND_ROWS, block_rows: int = BLOCK_ROWS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, class_id, kept, text_sha256``.

    Texts are in one class if a chain of pairs with a likeness of
    ``threshold`` or more links them; ``class_id`` is the smallest id of the
    class, whose row is kept.  Defined cases: a null text counts as
    empty; equal texts are always in one class, blank texts in one only if
    they are equal; rows that repeat an id are rows of their own, so an id may
    stand in several classes; a null id is larger than all others: a class
    without any other id has a null ``class_id`` and keeps its rows; an empty table gives no rows.
    ``text_sha256`` (hexadecimal) tells the rows of an id apart.
    """
    registers = bands * band_rows
    rows = id_and_text(docs, id_col, text_col)
    signed = written(signatures(rows, words, bands, band_rows), "signatures")
    # nodes: one per distinct text, numbered by its smallest id; further texts of an id, or of none, by their digest
    groups = signed.groupBy("sha").agg(F.min("doc_id").alias("rep"))
    firsts = groups.filter("rep IS NOT NULL").groupBy(F.col("rep").alias("of")).agg(F.min("sha").alias("first"))
    own = F.when(F.col("sha") == F.col("first"), F.col("rep")).otherwise(F.xxhash64("sha"))
    numbered = written(groups.join(firsts, F.col("rep") == F.col("of"), "left").select(F.col("sha").alias("of_sha"), "rep", own.alias("id")), "numbered")
    copies = written(signed.select("doc_id", "sha").join(numbered, F.col("sha") == F.col("of_sha")).select("doc_id", "sha", "rep", "id"), "copies")
    nodes = written(signed.filter("bands IS NOT NULL").groupBy("sha").agg(F.min(F.struct("bands", "bits")).alias("m"))
                    .join(numbered, F.col("sha") == F.col("of_sha")).select("id", "m.bands", "m.bits", "sha"), "nodes")
    buckets = members(nodes.select("id", F.posexplode("bands").alias("band", "value"))
                      .select(F.xxhash64("band", "value").alias("key"), "id"))
    bits = nodes.select("id", "bits")
    chosen = nodes.join(buckets.select("id").distinct(), "id", "left_semi").select("id", F.col("sha").alias("of_sha"))
    texts = written(rows.withColumn("sha", F.unhex(F.sha2("text", 256))).join(chosen, F.col("sha") == F.col("of_sha"))
                    .groupBy("id").agg(F.first("text").alias("text")), "texts")  # equal texts
    one, two = (bits.select(F.col("id").alias(f"id_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
    close = estimate("bits_a", "bits_b", registers) >= threshold - SLACK
    found = copies.select("id", F.col("id").alias("component")).limit(0)

    still = buckets
    for r in range(ROUNDS):
        if still.isEmpty():
            break
        if r == 0:  # the member that meets most others: the text that a group's copies were made from
            degree = still.groupBy(F.col("id").alias("member")).agg(F.sum("n").alias("degree"))
            ranked = still.join(degree, F.col("id") == F.col("member"))
            order = F.struct(-F.col("degree"), F.col("id"))
        else:
            ranked, order = still, F.struct(F.xxhash64("id", F.lit(r)), F.col("id"))
        leaders = ranked.groupBy(F.col("key").alias("of")).agg(F.min_by("id", order).alias("leader"))
        stars = (still.join(leaders, F.col("key") == F.col("of")).filter("id <> leader")
                 .select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct())
        across = with_component(with_component(stars, found, "a", "of_a"), found, "b", "of_b").filter("of_a <> of_b")
        pairs = written(across.join(two, F.col("b") == F.col("id_b")).join(one, F.col("a") == F.col("id_a"))
                        .filter(close).select("a", "b"), "pairs")
        found = merged_components(found, verified(pairs, texts, words, threshold))
        still = undecided(still, found)

    if not still.isEmpty():
        left = texts.join(still.select("id").distinct(), "id", "left_semi")
        # signatures of more registers: a group whose likenesses lie just below the threshold has no links to tell it apart by
        fine = signatures(left.select("id", "text"), words, FINE_REGISTERS, 1).select(F.col("doc_id").alias("id"), F.col("bits").alias("fine"))
        marks = written(fine.join(bits, "id"), "marks")
        dealt = block_keys(still, found, texts.select("id", F.octet_length("text").alias("size")), block_rows, block_bytes)
        found = merged_components(found, block_links(dealt, marks, texts, words, threshold, registers))

    # ids are attached at the end: a class is named by the smallest id of its texts
    classes = written(with_component(copies, found, "id", "component"), "classes")
    names = classes.groupBy(F.col("component").alias("of")).agg(F.min("rep").alias("class_id"))
    return classes.join(names, F.col("component") == F.col("of")).select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
