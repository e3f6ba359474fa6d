"""Byte-level BPE with DuckDB recursive queries inside each partition.

A task splits its texts into words by the vocabulary's pattern and encodes
each distinct word once.  The words become rows (word, position, token); one
step of a recursive query joins neighbouring tokens with the merge table,
finds each word's leftmost pair of minimum rank and contracts it; words
without a pair leave the recursion.  An ordered aggregation turns the rows
into the word's ids.  Decoding joins the rows (text, position, id) of a text's
ids with the vocabulary and aggregates the pieces in order.

The recursion keeps the rows of all its steps, about half the square of a
word's bytes.  Words of over ``LONG`` bytes are contracted in the same order
by queues of positions, one per rank, instead: their time grows with the length
and its logarithm, and their memory with the length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlab.llm.common import id_and_text, text_slices

LONG = 64  # bytes of the longest word that goes through the recursive query, whose positions have 20 bits
MAX_ROWS = 1_500_000  # of one recursive query, in all its steps
LATIN = 0x100  # bytes travel through SQL strings as the characters from here on, which hold no NUL

# step: the tokens of the words still being merged, each with its right neighbour.  best packs the rank, the
# position of the pair and the position of its right token, 20 bits per position (words of up to LONG bytes only).
ENCODE = """
WITH RECURSIVE step(word, pos, tok, next, nextpos, n) AS (
    SELECT word, pos, tok, next, nextpos, 0 FROM start
  UNION ALL
    (WITH best AS (
        SELECT word, min((rank::BIGINT << 40) | (pos::BIGINT << 20) | nextpos) AS best
        FROM step JOIN merges ON merges.a = step.tok AND merges.b = step.next GROUP BY word),
     pair AS (
        SELECT word, (best >> 40)::INTEGER AS tok, (best >> 20) & 1048575 AS head, best & 1048575 AS gone FROM best)
    SELECT s.word, s.pos, CASE WHEN s.pos = head THEN pair.tok ELSE s.tok END,
           CASE WHEN s.pos = head THEN d.next WHEN s.nextpos = head THEN pair.tok ELSE s.next END,
           CASE WHEN s.pos = head THEN d.nextpos ELSE s.nextpos END, s.n + 1
    FROM step s JOIN pair ON s.word = pair.word JOIN step d ON d.word = pair.word AND d.pos = gone
    WHERE s.pos <> gone)
),
last AS (SELECT word, max(n) AS n FROM step GROUP BY word)
SELECT word, string_agg(tok, ',' ORDER BY pos) AS ids FROM step JOIN last USING (word, n) GROUP BY word
"""

DECODE = """
SELECT seq, string_agg(piece, '' ORDER BY pos) AS text FROM tokens JOIN vocab ON vocab.id = tokens.id GROUP BY seq
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    import base64
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_table(ranks: dict[bytes, int]):
    """Columns a, b, rank: the pairs of tokens whose bytes together are a token, which is its own rank."""
    import numpy as np
    pairs = [(a, b, r) for t, r in ranks.items() for i in range(1, len(t))
             if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None]
    return np.array(pairs, np.int32).reshape(-1, 3).T.copy()


def raw_bytes(text: str) -> bytes:
    """The bytes that characters from ``LATIN`` on stand for."""
    return text.encode("utf-16-le")[::2]


class WordCodec:
    """Encoder and decoder of one task: a DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], merges, memory: str = "400MB"):
        import duckdb
        import pyarrow as pa

        self.ranks, self.pieces = ranks, {r: t for t, r in ranks.items()}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        self._table("merges", dict(zip(("a", "b", "rank"), map(pa.array, merges))))
        pieces = ["".join(chr(LATIN + x) for x in t) for t in ranks]
        self._table("vocab", {"id": pa.array(list(ranks.values()), pa.int32()), "piece": pa.array(pieces, pa.string())})

    def _table(self, name: str, columns: dict) -> None:
        import pyarrow as pa
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def encode(self, words: list[bytes], step: int = 20_000) -> list[str]:
        """The ids of each word as decimal numbers joined by commas."""
        import numpy as np
        import pyarrow as pa

        out = [str(r) if (r := self.ranks.get(w)) is not None else "" for w in words]
        todo = [i for i, w in enumerate(words) if not out[i] and w]
        for i in todo:
            if len(words[i]) > LONG:
                out[i] = ",".join(map(str, self.contracted(words[i])))
        todo = [i for i in todo if len(words[i]) <= LONG]
        rows = np.cumsum([len(words[i]) * (len(words[i]) + 1) // 2 for i in todo])
        single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        at = 0
        while at < len(todo):
            fit = int(np.searchsorted(rows, MAX_ROWS + (rows[at - 1] if at else 0), side="right"))
            own = todo[at:min(at + step, max(at + 1, fit))]
            at += len(own)
            sizes = np.array([len(words[i]) for i in own])
            tok = single[np.frombuffer(b"".join(words[i] for i in own), np.uint8)]
            word = np.repeat(np.array(own, np.int32), sizes)
            pos = (np.arange(len(tok)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            ends = np.append(word[1:] != word[:-1], True)  # the last rows of their words have no neighbour
            self._table("start", {"word": pa.array(word), "pos": pa.array(pos), "tok": pa.array(tok),
                                  "next": pa.array(np.roll(tok, -1), mask=ends),
                                  "nextpos": pa.array(np.roll(pos, -1), mask=ends)})
            for i, ids in self.db.execute(ENCODE).fetchall():
                out[i] = ids
        return out

    def contracted(self, word: bytes) -> list[int]:
        """Ids of one word of any length."""
        from array import array
        from heapq import heapify, heappop, heappush

        rank, pieces, n = self.ranks.get, self.pieces, len(word)
        tok = array("q", [self.ranks[word[i:i + 1]] for i in range(n)])  # by first byte; -1: part of a token before
        left, right = array("q", range(-1, n - 1)), array("q", range(1, n + 1))
        places: dict[int, list[int]] = {}  # of each rank the pairs, by position; some are gone when their turn comes
        for i in range(n - 1):
            if (r := rank(word[i:i + 2])) is not None:
                places.setdefault(r, []).append(i)
        lowest = list(places)
        heapify(lowest)
        while lowest:
            r = lowest[0]
            if not places[r]:
                del places[heappop(lowest)]
                continue
            i = heappop(places[r])
            j = right[i]
            if tok[i] < 0 or j == n or rank(pieces[tok[i]] + pieces[tok[j]]) != r:
                continue
            tok[i], tok[j], right[i] = r, -1, right[j]
            if right[j] < n:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (new := rank(pieces[tok[a]] + pieces[tok[b]])) is not None:
                    if new not in places:
                        places[new] = []
                        heappush(lowest, new)
                    heappush(places[new], a)
        return [t for t in tok if t >= 0]

    def decode(self, sequences: list[str], rows: int = 500_000) -> list[bytes]:
        """Bytes of each sequence of ids (decimal, joined by commas), in queries of at most ``rows`` ids."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out: list[list[bytes]] = [[] for _ in sequences]
        lists = pc.split_pattern(pa.array(sequences, pa.large_string()), ",")
        sizes = np.where([not s for s in sequences], 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        flat = pc.list_flatten(lists)
        ids = pc.cast(flat.filter(pc.not_equal(flat, "")), pa.int32())  # an empty sequence has one empty entry
        seq = np.repeat(np.arange(len(sequences)), sizes)
        for at in range(0, len(ids), rows):  # a sequence over several queries comes in order
            own = seq[at:at + rows]
            self._table("tokens", {"seq": pa.array(own), "pos": pa.array(np.arange(len(own))), "id": ids.slice(at, rows)})
            for i, text in self.db.execute(DECODE).fetchall():
                out[i].append(raw_bytes(text))
        return list(map(b"".join, out))


class TextCodec:
    """Ids of whole texts by way of their words.

    Known words are kept, up to ``max_words`` of them and those of one block of
    ``block`` words or one slice of texts, so memory is bounded.
    """

    def __init__(self, ranks: dict[bytes, int], merges, pattern: str, max_words: int = 900_000, block: int = 500_000):
        import regex

        self.codec = WordCodec(ranks, merges)
        self.split = regex.compile(pattern)
        self.max_words, self.block = max_words, block
        self.words: dict[str, str] = {}

    def learn(self, words: set[str]) -> None:
        """Encode the words that aren't known."""
        if len(self.words) + len(words) > self.max_words:
            self.words.clear()
        new = [w for w in words if w not in self.words]
        self.words.update(zip(new, self.codec.encode([w.encode() for w in new])))

    def joined(self, words: list[str]) -> str:
        return ",".join(map(self.words.__getitem__, words))

    def encode(self, texts: list[str]) -> list[str]:
        """The ids of each text as decimal numbers joined by commas."""
        from itertools import islice

        if sum(map(len, texts)) <= 10 * self.block:
            split = [self.split.findall(t) for t in texts]
            self.learn(set().union(*split))
            return list(map(self.joined, split))
        out = []
        for t in texts:
            matches, parts = self.split.finditer(t), []
            while words := [m[0] for m in islice(matches, self.block)]:
                self.learn(set(words))
                parts.append(self.joined(words))
            out.append(",".join(parts))
        return out


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  slice_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the ids of every whole text (decimal,
    joined by commas) and the bytes that these ids decode to.

    Defined cases: a null or empty text has no ids (an empty string, 0 tokens,
    no bytes); one row per input row, whatever its id.
    """
    ranks = load_ranks(ranks_path)
    model = docs.sparkSession.sparkContext.broadcast({"model": (ranks, merge_table(ranks))})  # as large as the vocabulary

    def run(batches):
        import pyarrow as pa
        # a Python worker keeps its copy of the broadcast value, so its next task finds the words of the one before
        codec = model.value.get("codec") or model.value.setdefault("codec", TextCodec(*model.value["model"], pattern))
        for ids, texts in text_slices(batches, slice_bytes):
            coded = codec.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([c.count(",") + bool(c) for c in coded], pa.int64()),
                 pa.array(coded, pa.string()), pa.array(codec.codec.decode(coded), pa.binary())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded binary")


def decode_ids(coded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded``: the bytes of any sequences of ids (decimal, joined by commas; null: none)."""
    ranks = load_ranks(ranks_path)
    model = coded.sparkSession.sparkContext.broadcast((ranks, merge_table(ranks)))

    def run(batches):
        import pyarrow as pa
        codec = WordCodec(*model.value)
        for ids, texts in text_slices(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(codec.decode(texts), pa.binary())],
                                             names=["doc_id", "decoded"])

    return id_and_text(coded, id_col, ids_col).mapInArrow(run, "doc_id long, decoded binary")
