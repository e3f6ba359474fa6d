"""Phrase collocations by Toivonen's sampling algorithm.

A phrase is frequent if it occurs ``support`` times or more, and all parts of
a frequent phrase are frequent.  A sample of the documents proposes words and
pairs.  One pass over all documents then counts
the proposed phrases and their negative border, the phrases that
aren't proposed though all their parts are: every word, every pair of proposed
words, every triple of two proposed pairs.  Where the border holds frequent
phrases the proposal was too small: they join it, and a further pass counts
what the larger proposal and its border have in addition.  The proposal is
closed when no pass finds another frequent phrase in the border.

These passes shuffle 64-bit hashes of phrases with their counts, as nearly all
phrases of the border are rare.  Phrases of one hash are counted together, so
no frequent phrase is missed.  A last pass counts the phrases of the frequent
hashes themselves, by their letters, which makes set and counts exact.

Proposals and frequent hashes are sent to the tasks as bit arrays of bounded
size.  A bit that is set by chance adds candidates
and loses nothing: a phrase is counted in the first pass whose bits admit
all its parts, whole, and in no other.  Tasks number their words and send one
row per phrase and task; no list of phrases passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from basketlab.functions.joins import sized_for_broadcast
from basketlab.llm.common import text_slices, written
from basketlab.llm.exact_dedup import PAGE_BITS, filter_bits
from basketlab.llm.suffix_dedup import Hasher, mixed

WORD_BITS = 21  # of a word's number in a task; three words fit one long
MAX_WORDS = 3
TOTAL = ""  # the phrase of no words: all words of a language
SALTS = 16  # parts into which a hot key or a language is split
COUNTS = "lang string, phrase string, n long"
HASHED = "h long, n long"  # the two lowest bits of h are the number of words


def breaks() -> bytes:
    """Byte table: A-Z become lower case, tabs spaces, and the ends of pieces full stops."""
    return bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + b".,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"." * 10)


def bit_of(first, second=None):
    """Hash of a word, or of a pair, from the hashes of its words."""
    import numpy as np
    x = first.copy() if second is None else first * np.uint64(0x9E3779B97F4A7C15) + second
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def admitted(bits, hashed):
    """Mask of the hashes whose bit is set in a bit array of a power of two of bits."""
    import numpy as np
    at = hashed & np.uint64(len(bits) * 8 - 1)  # the low bits: the shuffled hashes have lost their two highest
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def salts(langs: list[str]):
    """A number per language, so that equal words of two languages differ."""
    import numpy as np
    import xxhash
    known = {g: xxhash.xxh3_64_intdigest(g.encode()) for g in set(langs)}
    return np.array([known[g] for g in langs], np.uint64)


def hashes_of(hasher: Hasher, data: bytes, start, length, salt):
    """Hashes of the words at ``start`` in ``data``."""
    import numpy as np
    hasher.load(np.frombuffer(data, np.uint8))
    return mixed(hasher.some(start, length) + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt)


def hashed_words(hasher: Hasher, langs: list[str], texts: list[str]):
    """Hash and number of the piece of every word of the texts."""
    import numpy as np
    raw = [t.encode() for t in texts]
    data = (b"\n".join(raw) + b"\n").translate(breaks())
    array = np.frombuffer(data, np.uint8)
    end = array == 46
    edge = np.diff(np.concatenate([[True], (array == 32) | end]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # the last byte ends a piece
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), start, side="right")
    return hashes_of(hasher, data, start, stop - start, salts(langs)[text]), np.cumsum(end)[start]


class HashCounter:
    """Counts of one task's phrases by their hashes; the two lowest bits of a key are the number of words."""

    def __init__(self, longest: int):
        self.longest, self.hasher = longest, Hasher(12)
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple] = []
        self.held = 0

    def add(self, level: int, hashed) -> None:
        import numpy as np
        key, n = np.unique(hashed << np.uint64(2) | np.uint64(level), return_counts=True)
        self.parts.append((key, n))
        self.held += len(key)

    def count(self, langs: list[str], texts: list[str], new, old, with_words: bool) -> None:
        """Count the words if asked, and the pairs and triples that the bit arrays ``new`` of words and pairs
        admit and ``old`` (None: nothing) don't.

        Without ``new`` every pair counts and no triple does (the sample).
        """
        import numpy as np
        h, piece = hashed_words(self.hasher, langs, texts)
        if with_words:
            self.add(1, bit_of(h))
        inside = piece[1:] == piece[:-1]
        pair = bit_of(h[:-1], h[1:])

        def places(bits):
            """Masks of the places where a pair is admitted by its words, and where also by itself."""
            if bits is None:
                return inside, np.zeros_like(inside)
            ok = admitted(bits[0], bit_of(h))
            by_words = inside & ok[:-1] & ok[1:]
            return by_words, by_words & admitted(bits[1], pair)

        by_words, now = places(new)
        known, before = places(old) if old is not None else (np.zeros_like(inside), np.zeros_like(inside))
        self.add(2, pair[by_words & ~known])
        if self.longest > 2:
            at = np.flatnonzero(now[:-1] & now[1:] & ~(before[:-1] & before[1:]))
            self.add(3, bit_of(pair[at], h[at + 2]))

    def rows(self):
        """A record batch ``h, n`` of everything counted."""
        import numpy as np
        import pyarrow as pa
        if self.parts:
            key, inverse = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([n for _, n in self.parts]), len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["h", "n"])


class Numbers(dict):
    """Numbers of one language's words; an unknown word gets the next number."""

    def __init__(self, code: int, counter: Counter):
        super().__init__({b".": 0})
        # the counter's lists, not the counter, so that neither keeps the other alive
        self.code, self.words, self.lang_of = code, counter.words, counter.lang_of

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        self.lang_of.append(self.code)
        return n


class Counter:
    """Exact counts of one task's chosen phrases; words are numbered per language, number 0 ends a piece."""

    def __init__(self, longest: int):
        self.longest, self.hasher = longest, Hasher(12)
        self.clear()

    def clear(self) -> None:
        import numpy as np
        self.words, self.lang_of, self.langs = [b""], [0], []
        self.numbers: dict[str, Numbers] = {}
        self.hashes, self.single = np.zeros(1, np.uint64), np.zeros(1, np.int64)
        self.keys = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] for _ in range(2, self.longest + 1)]
        self.held = 0

    def numbers_of(self, lang: str) -> Numbers:
        if lang not in self.numbers:
            self.numbers[lang] = Numbers(len(self.langs), self)
            self.langs.append(lang)
        return self.numbers[lang]

    def numbered(self, langs: list[str], texts: list[str]):
        """The numbers of all words of the texts, pieces ended by 0."""
        import numpy as np
        table, out = breaks(), []
        for lang, text in zip(langs, texts):
            find = self.numbers_of(lang).__getitem__
            out.extend(map(find, text.encode().translate(table).replace(b".", b" . ").split()))
            out.append(0)
        if new := self.words[len(self.hashes):]:
            size = np.array([len(w) for w in new])
            salt = salts(self.langs)[np.array(self.lang_of[len(self.hashes):])]
            self.hashes = np.concatenate([self.hashes, hashes_of(self.hasher, b"".join(new), np.cumsum(size) - size, size, salt)])
        return np.array(out, np.int64)

    def add(self, length: int, keys, counts) -> None:
        self.keys[length - 2].append((keys, counts))
        self.held += len(keys)

    def count(self, langs: list[str], texts: list[str], chosen) -> None:
        """Count the words, pairs and triples whose hashes' bits are set in ``chosen``."""
        import numpy as np
        tokens = self.numbered(langs, texts)
        seen = np.bincount(tokens, minlength=len(self.words))
        seen[:len(self.single)] += self.single
        self.single = seen
        key, full, hashed = tokens, tokens > 0, self.hashes[tokens]
        for level in range(2, self.longest + 1):
            full = full[:-1] & (tokens[level - 1:] > 0)
            key = key[:-1] << WORD_BITS | tokens[level - 1:]
            hashed = bit_of(hashed[:-1], self.hashes[tokens[level - 1:]])
            self.add(level, *np.unique(key[full & admitted(chosen[level - 1], hashed)], return_counts=True))

    def merge(self) -> None:
        """One sum per phrase."""
        import numpy as np
        for own in self.keys:
            key, inverse = np.unique(np.concatenate([k for k, _ in own]), return_inverse=True)
            total = np.bincount(inverse, np.concatenate([n for _, n in own]), len(key)).astype(np.int64)
            self.held += len(key) - sum(len(k) for k, _ in own)
            own[:] = [(key, total)]

    def rows(self, chosen):
        """Record batches ``lang, phrase, n`` of everything counted, words by ``chosen`` only, and of all words."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not self.langs:
            return
        names = pa.array(self.langs, pa.string())
        lang_of = np.array(self.lang_of)
        words = pa.array(self.words, pa.binary())

        def batch(parts, n):
            for i in range(0, len(n), 1 << 16):
                own = [p[i:i + (1 << 16)] for p in parts]
                text = pc.binary_join_element_wise(*[words.take(pa.array(p)) for p in own], pa.scalar(b" ", pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(lang_of[own[0]])), text.cast(pa.string()), pa.array(n[i:i + (1 << 16)], pa.int64())],
                    names=["lang", "phrase", "n"])

        seen = np.flatnonzero(self.single[1:]) + 1
        seen = seen[admitted(chosen[0], bit_of(self.hashes[seen]))]
        yield from batch([seen], self.single[seen])
        total = np.bincount(lang_of[1:], self.single[1:], len(self.langs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([names, pa.array([TOTAL] * len(names)), pa.array(total)], names=["lang", "phrase", "n"])
        mask = (1 << WORD_BITS) - 1
        for length, own in enumerate(self.keys, 2):
            for key, n in own:
                yield from batch([key >> (WORD_BITS * k) & mask for k in range(length - 1, -1, -1)], n)


def counted(rows: DataFrame, longest: int, new=None, old=None, with_words: bool = True, chosen=None, max_held: int = 2_000_000,
            max_words: int = 200_000) -> DataFrame:
    """``h, n``: the hashes of this pass's phrases; ``lang, phrase, n`` of the ``chosen`` ones if given.

    ``new``, ``old`` and ``chosen`` are broadcast bit arrays or None.
    """
    def run(batches):
        import numpy as np
        new_bits, old_bits, chosen_bits = (None if b is None else [np.frombuffer(x, np.uint8) for x in b.value] for b in (new, old, chosen))
        counter = HashCounter(longest) if chosen is None else Counter(longest)

        def out():
            if chosen is None:
                return counter.rows()
            counter.merge()
            return counter.rows(chosen_bits)

        for langs, texts in text_slices(batches, 2 << 20):
            if chosen is None:
                counter.count(langs, texts, new_bits, old_bits, with_words)
            else:
                counter.count(langs, texts, chosen_bits)
            if counter.held > max_held or chosen is not None and len(counter.words) > max_words:  # sums of sums are exact
                yield from out()
                counter.clear()
        yield from out()

    keys = ["h"] if chosen is None else ["lang", "phrase"]
    schema = HASHED if chosen is None else COUNTS
    # tasks have summed their own phrases, so the rows are dealt as they are and summed once
    found = rows.select("lang", "text").mapInArrow(run, schema)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts, *keys).groupBy(*keys).agg(F.sum("n").alias("n"))


def positions(hashes: DataFrame, bits, known=None) -> DataFrame:
    """``level, pos``: the bit of every hash whose bit isn't set in ``known``, for the levels that have an array.

    ``bits`` are the sizes of the arrays.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        arrays = None if known is None else [np.frombuffer(x, np.uint8) for x in known.value]
        for b in batches:
            h = b.column("h").to_numpy().view(np.uint64)
            for k, size in enumerate(bits, 1):
                own = h[h & np.uint64(3) == k] >> np.uint64(2)
                if arrays is not None:
                    own = own[~admitted(arrays[k - 1], own)]
                pos = np.unique(own & np.uint64(size - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pos), k, np.int32)), pa.array(pos)], names=["level", "pos"])

    return hashes.select("h").mapInArrow(run, "level int, pos long")


def with_bits(arrays: list[bytes], places: DataFrame) -> tuple[list[bytes], int]:
    """The bit arrays with further bits set, and the number of pages that changed.

    The driver receives pages of 4 KB, at most the arrays as a whole.
    """
    out = [bytearray(a) for a in arrays]
    pages = (places.distinct().groupBy("level", F.shiftright("pos", 15).alias("page"))
             .agg(F.bitmap_construct_agg(F.col("pos") % PAGE_BITS).alias("bits")))
    changed = 0
    for r in pages.toLocalIterator():
        own = slice(r.page * 4096, (r.page + 1) * 4096)
        both = int.from_bytes(out[r.level - 1][own], "little") | int.from_bytes(r.bits, "little")
        out[r.level - 1][own] = both.to_bytes(4096, "little")
        changed += 1
    return [bytes(x) for x in out], changed


def array_sizes(hashes: DataFrame, levels: int, max_filter_bytes: int) -> list[int]:
    """Bits of the arrays for the hashes of each level: 64 per hash, within the bound."""
    rows = {r.level: r.n for r in hashes.groupBy(F.col("h").bitwiseAND(3).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return [filter_bits(rows.get(k, 0), 64, max_filter_bytes) for k in range(1, levels + 1)]


def frequent_phrases(docs: DataFrame, support: int = 10, longest: int = MAX_WORDS, sample: float = 0.1, proposing: int = 3,
                     id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_filter_bytes: int = 16 << 20,
                     passes: list | None = None) -> DataFrame:
    """``lang, phrase, n``: every phrase of up to ``longest`` words that occurs ``support`` times or
    more in its language, and as the phrase ``TOTAL`` the number of all words of the language.

    ``sample`` is the share of documents that proposes phrases: those that it
    holds ``proposing`` times.  Both change the number and the size of the passes, never the
    result.  The pages of bits that each pass added are appended to ``passes``.
    """
    if not 2 <= longest <= MAX_WORDS:
        raise ValueError(f"longest must be 2 to {MAX_WORDS}")
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.col(id_col).alias("doc_id"))
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit(12)), F.lit(1 << 20)) < int(sample * (1 << 20)))
    proposed = written(counted(drawn, 2).filter(F.col("n") >= proposing).select("h"), "proposed")
    bits = array_sizes(proposed, 2, max_filter_bytes)
    arrays, _ = with_bits([bytes(b // 8) for b in bits], positions(proposed, bits))
    frequent, old, new = None, None, sc.broadcast(arrays)
    while True:
        own = written(counted(rows, longest, new, old, with_words=old is None).filter(F.col("n") >= support).select("h"), "frequent")
        frequent = own if frequent is None else frequent.unionByName(own)
        arrays, failures = with_bits(arrays, positions(own, bits, new))  # frequent in the border: not admitted yet
        if passes is not None:
            passes.append(failures)
        if not failures:
            break
        old, new = new, sc.broadcast(arrays)
    bits = array_sizes(frequent, longest, max_filter_bytes)
    arrays, _ = with_bits([bytes(b // 8) for b in bits], positions(frequent, bits))
    return counted(rows, longest, chosen=sc.broadcast(arrays)).filter((F.col("n") >= support) | (F.col("phrase") == TOTAL))


def salted_lookup(rows: DataFrame, counts: DataFrame, part: str, name: str) -> DataFrame:
    """Adds the count of the phrase in column ``part`` as ``name``; hot parts are dealt over ``SALTS`` keys."""
    other = counts.select(F.col("lang").alias("lang_"), F.col("phrase").alias("part_"), F.col("n").alias(name))
    small = sized_for_broadcast(other)
    if small is not other:
        return rows.join(small, (F.col("lang") == F.col("lang_")) & (F.col(part) == F.col("part_"))).drop("lang_", "part_")
    other = other.withColumn("salt_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS).cast("long"))
    return rows.join(other, (F.col("lang") == F.col("lang_")) & (F.col(part) == F.col("part_")) & (salt == F.col("salt_"))).drop(
        "lang_", "part_", "salt_")


def collocations(docs: DataFrame, support: int = 10, longest: int = MAX_WORDS, contained: int = 50, top: int = 2000,
                 **options) -> DataFrame:
    """The ``top`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Pieces of text end at ``. , ; : ! ?`` and line ends, words at spaces and tabs;
    A-Z count as a-z; a null text counts as empty and a null language as ``und``.  A candidate is a phrase
    of 2 to ``longest`` words that occurs a >= ``support`` times.  Of its cuts
    into two parts, with l and r occurrences, the one with the lowest score
    floor(1000000 a a / (l r)) counts (ties: the shortest first part), in exact
    decimal arithmetic up to 10**15 occurrences.  Candidates that lie in a longer candidate with at least
    ``contained`` percent of their occurrences are dropped.  Rank 1 has the
    highest score (ties: the most occurrences, then the phrase's bytes).

    Defined cases: rows are counted one by one, also those that repeat an id
    or text or have no id; a text without words adds nothing; an empty table or one
    without candidates gives no rows; other columns are not read.  ``options`` go to :func:`frequent_phrases`.
    """
    known = written(frequent_phrases(docs, support, longest, **options), "frequent")
    counts = known.filter(F.col("phrase") != TOTAL)
    candidates = counts.withColumn("w", F.split("phrase", " ")).filter(F.size("w") >= 2)
    cuts = (candidates.select("lang", "phrase", F.col("n").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
            .withColumn("head", F.array_join(F.slice("w", F.lit(1), F.col("k")), " "))
            .withColumn("rest", F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ")).drop("w"))
    both = salted_lookup(salted_lookup(cuts, counts, "head", "l"), counts, "rest", "r")
    exact = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
                   " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = (both.withColumn("score", exact).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))))
    longer = (candidates.filter(F.size("w") > 2).select(F.col("lang").alias("lang_"), F.explode(parts).alias("part_"), "n")
              .groupBy("lang_", "part_").agg(F.max("n").alias("most")))
    left = (scored.join(longer, (F.col("lang") == F.col("lang_")) & (F.col("phrase") == F.col("part_")), "left")
            .filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * contained)).drop("lang_", "part_", "most"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # one language may hold most candidates: the best of each part first
    best = (left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
            .withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .filter(F.col("place") <= top).drop("salt", "place"))
    ranked = (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
              .filter(F.col("rank") <= top))
    total = known.filter(F.col("phrase") == TOTAL).select(F.col("lang").alias("of"), F.col("n").alias("all_words"))
    return ranked.join(total, F.col("lang") == F.col("of")).select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")
