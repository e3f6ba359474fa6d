"""Token counts of a unigram tokenizer by trie-shared dynamic programming.

A task gathers the distinct pre-tokens of a slice of texts and inserts them in
a trie.  A trie node is a prefix; its forward score is the score of the
prefix's best segmentation into pieces, which depends on nothing behind it, so
it is computed once however many pre-tokens share the prefix.  Nodes where a
pre-token ends store its token count, and a text's count is the sum over its
pre-tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from basketlab.llm.common import id_and_text, text_slices

SPACE = "▁"  # fixed value: stands for the white space before a word in the vocabulary's pieces


def load_pieces(path: str) -> dict[str, float]:
    """Pieces and log probabilities from a sentencepiece file.

    The public vocabulary orders its pieces by merge rank and has no
    probabilities; rank r counts as probable as 1 / (r + 2) (Zipf's law,
    normalised).  Control, byte and unknown pieces are left out.
    """
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [m.id_to_piece(i) for i in range(m.get_piece_size())
             if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i))]
    total = math.log(sum(1 / (r + 2) for r in range(len(plain))))
    return {p: -math.log(r + 2) - total for r, p in enumerate(plain)}


class Trie:
    """Forward scores of prefixes, kept in the nodes; ``counts`` maps the pre-tokens that end at a node to its token count.

    A character that no piece covers falls back to its UTF-8 bytes, each a
    token with the score of an unseen piece.  Of segmentations with equal
    scores the one whose last piece is the longest counts.
    """

    def __init__(self, pieces: dict[str, float], max_nodes: int = 1_500_000):
        # every suffix of a piece, with the score of those that are pieces themselves
        self.suffixes = {p[i:]: pieces.get(p[i:]) for p in pieces for i in range(len(p))}
        self.unseen = min(pieces.values(), default=0.0) - 10.0
        self.max_nodes = max_nodes
        self.clear()

    def clear(self) -> None:
        from array import array
        self.counts: dict[str, int] = {}
        self.child: dict[int, int] = {}  # node and character to node; the root is 0
        self.score, self.tokens = array("d", [0.0]), array("q", [0])  # of each node's prefix

    @property
    def nodes(self) -> int:
        return len(self.score) - 1

    def insert(self, words: list[str]) -> None:
        """Add pre-tokens; a prefix that any of them shares with one added before is not scored again."""
        if self.nodes > self.max_nodes:
            self.clear()
        suffixes, unseen, child, score, tokens = self.suffixes, self.unseen, self.child, self.score, self.tokens
        for w in words:
            path = [0]  # nodes of the prefixes of w
            for c in w:
                at = child.get(path[-1] << 21 | ord(c))
                if at is None:
                    break
                path.append(at)
            for end in range(len(path), len(w) + 1):
                n_bytes = len(w[end - 1].encode())
                best, count = score[path[-1]] + n_bytes * unseen, tokens[path[-1]] + n_bytes
                start = end - 1
                while start >= 0 and (own := w[start:end]) in suffixes:
                    s = suffixes[own]
                    if s is not None and score[path[start]] + s >= best:
                        best, count = score[path[start]] + s, tokens[path[start]] + 1
                    start -= 1
                child[path[-1] << 21 | ord(w[end - 1])] = len(score)
                path.append(len(score))
                score.append(best)
                tokens.append(count)
            self.counts[w] = tokens[path[-1]]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_pretokens`` of every whole text.

    Pre-tokens are the words between white space, each with the space mark
    before it, as the vocabulary's pieces never cross white space.  Defined
    cases: a null, empty or blank text has 0 tokens; very long texts and words
    are counted whole; other columns, also of clashing names, are not read; one
    row per input row, whatever its id; an empty table gives none.
    """
    def run(batches):
        import pyarrow as pa
        trie = Trie(load_pieces(model_path))
        for ids, texts in text_slices(batches):
            cut = [t.split() for t in texts]
            new = {w for x in cut for w in x}
            if trie.nodes > trie.max_nodes:
                trie.clear()
            trie.insert([SPACE + w for w in new if SPACE + w not in trie.counts])
            known = {w: trie.counts[SPACE + w] for w in new}
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([sum(map(known.__getitem__, x)) for x in cut], pa.int64()),
                 pa.array([len(x) for x in cut], pa.int64())], names=["doc_id", "n_tokens", "n_pretokens"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, n_pretokens long")
