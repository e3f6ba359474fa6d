"""Runs of periodically repeated words, by difference-cover longest common extensions.

A run is a stretch of words with a period (words ``q`` apart are identical)
that no neighbouring word extends.  Every run of period ``q`` that holds two
periods meets the harmonic grid 0, q, 2q, ... in two neighbouring points i and
i + q, which have the same word; how far the words agree behind and ahead of
the two points gives the whole run.  All grids together have about n ln n points.

The words on which two places agree are counted by a longest-common-extension
index (:class:`Extensions`).  It sorts only the suffixes at the places whose
remainder lies in a difference cover; for any two places there is one distance
below the cover's modulus at which both are such samples.  A query compares
the words up to there, most often one or two, and then takes the minimum of
the sorted samples' common prefixes from a sparse table.

The texts of a slice are laid behind each other, with a word of its own behind
each text, so one index and one walk over the periods serve all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlab.llm.common import id_and_text, text_slices

COVER = (1, 5, 11, 24, 25, 27)  # every remainder but 0 is the difference of exactly one pair of these
MODULUS = 31
RUN = "array<struct<start:long,length:long,period:long>>"


def reach_table():
    """``at[r][s]``: words from places with remainders r and s to the next two samples."""
    import numpy as np
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for r in range(MODULUS):
        for s in range(MODULUS):
            out[r, s] = min(k for k in range(MODULUS) if (r + k) % MODULUS in COVER and (s + k) % MODULUS in COVER)
    return out


class Extensions:
    """Longest common extensions to the right between places of one text.

    ``words`` are small numbers; ``text`` is the number, rising, of the text
    that a place belongs to.  Each text must end with a word that occurs
    nowhere else.
    """

    def __init__(self, words, text):
        import numpy as np
        n = len(words)
        top = int(words.max()) + 1 if n else 1
        self.words = np.concatenate([words.astype(np.int64), top + np.arange(MODULUS + 1)])
        self.reach = reach_table()
        place = (np.arange(0, n, MODULUS)[:, None] + np.array(COVER)).ravel()
        place = place[place < n]
        self.index = np.full(MODULUS, -1)  # of a remainder in the cover: its number there
        self.index[list(COVER)] = np.arange(len(COVER))
        bits = int(top + MODULUS).bit_length()
        levels = self._sorted(place, text[place], bits)
        self._table(place, levels)

    def _refined(self, rank, tied, key):
        """Ranks after ordering the tied samples of each rank by ``key``; the samples that are still tied."""
        import numpy as np
        order = np.lexsort((key, rank[tied]))
        tied, key = tied[order], key[order]
        old = rank[tied]
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new = new_old.copy()
        new[1:] |= key[1:] != key[:-1]
        at = np.arange(len(tied))
        first_old, first = at[new_old][np.cumsum(new_old) - 1], at[new][np.cumsum(new) - 1]
        rank[tied] = old + first - first_old
        alone = new & np.append(new[1:], True)
        return tied[~alone]

    def _sorted(self, place, text, bits):
        """Ranks by the first ``MODULUS`` words, by twice as many, ..., until no two samples are tied."""
        import numpy as np
        new = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
        rank = np.flatnonzero(new)[np.cumsum(new) - 1] if len(text) else np.zeros(0, np.int64)  # a text's samples stay together
        tied, per = np.arange(len(place)), max(1, 62 // bits)
        for c in range(0, MODULUS, per):
            if not len(tied):
                break
            key = np.zeros(len(tied), np.int64)
            for k in range(c, min(c + per, MODULUS)):
                key = (key << bits) | self.words[place[tied] + k]
            tied = self._refined(rank, tied, key)
        levels, shift = [rank.copy()], len(COVER)
        while len(tied):
            tied = self._refined(rank, tied, levels[-1][tied + shift])
            levels.append(rank.copy())
            shift *= 2
        self.rank = rank
        return levels

    def _table(self, place, levels):
        """Sparse table of the common prefixes of neighbours in the order of the samples."""
        import numpy as np
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        live = np.flatnonzero(levels[0][a] == levels[0][b])
        for k in range(len(levels) - 1, -1, -1):
            same = live[levels[k][a[live]] == levels[k][b[live]]]
            common[same] += MODULUS << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        a, b, live = place[a], place[b], np.arange(len(a))
        for k in range(MODULUS):
            live = live[self.words[a[live] + k] == self.words[b[live] + k]]
            if not len(live):
                break
            common[live] += 1
        self.table, width = [common], 1
        while 2 * width <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def common(self, i, j):
        """Number of words on which the places ``i`` and ``j``, different ones of one text, agree."""
        import numpy as np
        far = self.reach[i % MODULUS, j % MODULUS]
        out, live = np.zeros(len(i), np.int64), np.arange(len(i))
        for k in range(MODULUS):
            live = live[self.words[i[live] + k] == self.words[j[live] + k]]
            at = far[live] == k
            synchronised, live = live[at], live[~at]
            if len(synchronised):
                a, b = (self.rank[(p // MODULUS) * len(COVER) + self.index[p % MODULUS]]
                        for p in (i[synchronised] + k, j[synchronised] + k))
                low, high = np.minimum(a, b), np.maximum(a, b)
                level = np.frexp((high - low).astype(float))[1] - 1
                least = np.empty(len(low), np.int64)
                for w in np.unique(level):
                    own = np.flatnonzero(level == w)
                    t = self.table[w]
                    least[own] = np.minimum(t[low[own]], t[high[own] - (1 << int(w))])
                out[synchronised] = k + least
            out[live] = k + 1
            if not len(live):
                break
        return out


def runs_of(words, sizes, min_length: int, min_periods: int):
    """``text, start, length, period`` of all runs, by text, start and period.

    ``words`` are the numbered words of texts of ``sizes`` words behind each
    other, the longest text first.  A run has its smallest period and at least
    ``max(min_length, min_periods * period)`` words, ``min_periods`` >= 2.
    """
    import numpy as np
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not len(words):
        return none
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    starts = np.cumsum(sizes + 1) - sizes - 1
    laid = np.empty(len(text), np.int64)
    laid[:] = int(words.max()) + 1 + text  # a text's end
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    laid[inside] = words

    long_enough = np.cumsum(sizes + 1)  # places of the texts up to each
    place, period = [], []
    for q in range(1, int(sizes[0]) // min_periods + 1):
        need = max(min_length, min_periods * q)
        count = int(np.searchsorted(-sizes, -need, side="right"))
        if not count:
            break
        grid = laid[:long_enough[count - 1]:q]
        at = np.flatnonzero(grid[1:] == grid[:-1])
        if len(at):
            place.append(at * q)
            period.append(np.full(len(at), q))
    if not place:
        return none
    i, q = np.concatenate(place), np.concatenate(period)
    ahead = Extensions(laid, text).common(i, i + q)
    # agreement behind two places is agreement ahead of their mirror images; the first text's start is its end there
    mirror = np.append(laid[::-1], int(laid.max()) + 1)
    back = Extensions(mirror, np.append(len(sizes) - 1 - text[::-1], len(sizes)))
    behind = back.common(len(laid) - i, len(laid) - i - q)
    length = ahead + behind + q
    good = length >= np.maximum(min_length, min_periods * q)
    start, length, q = (i - behind)[good], length[good], q[good]
    # a run shows up at each of its grid points, and again for the multiples of its period
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[first], length[first], q[first]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    of = text[start]
    return of, start - starts[of], length, q


def repeated_words(start, length, period, n: int):
    """Mask of the ``n`` words that lie in a run behind its first period."""
    import numpy as np
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 24,
                  min_periods: int = 3, slice_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, strongest, collapsed``.

    Words end at ASCII white space.  ``runs`` has the start (word number),
    length and smallest period of every run of at least ``max(min_length,
    min_periods * period)`` words, by start and period; ``strongest`` is the
    run with the greatest length / period (then the smallest start and
    period), null without a run; ``collapsed`` is the text without the words that lie in a run
    behind its first period, joined by single spaces.

    Defined cases: a null or blank text has no words, no runs and an empty
    ``collapsed``; rows are treated one by one, whatever their id (null and
    repeated ids included); an empty table gives no rows; further columns are
    not read.  Memory follows ``slice_bytes`` or the longest single text.
    """
    if min_periods < 2:
        raise ValueError("min_periods must be 2 or more")

    def find(batches):
        from functools import reduce

        import numpy as np
        import pyarrow as pa
        run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        for ids, texts in text_slices(batches, slice_bytes):
            words = [t.encode().split() for t in texts]
            number: dict[bytes, int] = {}
            for own in words:
                for w in own:
                    number.setdefault(w, len(number))
            sizes = np.array([len(x) for x in words], np.int64)
            order = np.argsort(-sizes, kind="stable")
            flat = np.fromiter((number[w] for k in order for w in words[k]), np.int64, int(sizes.sum()))
            of, start, length, period = runs_of(flat, sizes[order], min_length, min_periods)
            bounds = np.searchsorted(of, np.arange(len(order) + 1))
            runs, best, kept = [[] for _ in ids], [None] * len(ids), [None] * len(ids)
            for k, row in enumerate(order):
                own = slice(bounds[k], bounds[k + 1])
                if own.start < own.stop:
                    runs[row] = [dict(zip(("start", "length", "period"), r))
                                 for r in zip(*(x[own].tolist() for x in (start, length, period)))]
                    best[row] = reduce(lambda a, b: b if b["length"] * a["period"] > a["length"] * b["period"] else a, runs[row])
                    gone = repeated_words(start[own], length[own], period[own], len(words[row]))
                    kept[row] = b" ".join([w for w, g in zip(words[row], gone.tolist()) if not g])
                else:
                    kept[row] = b" ".join(words[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(runs, pa.list_(run_type)), pa.array(best, run_type),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        find, f"doc_id long, n_words long, runs {RUN}, strongest {RUN[6:-1]}, collapsed string")


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: one document in ten with its last words replaced by a repeated stretch.

    With h the CRC-32 of the decimal id, g = h div 10 and n words, the words
    from g mod n on repeat those of one period where h is divisible by 10; these words are
    then joined by single spaces.  Other texts, and those without an id, are unchanged.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size("words"), F.lit(1))
    a = F.pmod(F.col("g"), n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(F.col("g"), F.lit(8))))
    chosen = (F.col("h") % 10 == 0) & F.col("text").isNotNull()
    # the words are null, so never split, for the nine in ten texts that stay as they are
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.element_at("words", (F.col("a") + F.pmod(i - F.col("a"), F.col("p")) + 1).cast("int"))))
    return (rows.withColumn("words", F.when(chosen, words))
            .withColumn("a", F.when(F.size("words") > 0, a)).withColumn("p", F.when(F.size("words") > 0, p))
            .select("doc_id", F.when(F.col("a").isNotNull(), F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text")))
