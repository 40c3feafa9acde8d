"""Token counts under a unigram model, by dynamic programming shared in a trie.

The model's pieces are the tokens of a rank file; a piece of rank r gets the
Zipf-Mandelbrot log-probability -ln(r + SHIFT) less the logarithm of the sum.
A pre-token's segmentation is the one of highest total log-probability; of
equal ones the one with fewest pieces counts.

Distinct pre-tokens are sorted and inserted in a trie level by level. A node
stands for a prefix; its forward score and count come once from the nodes of
its shorter prefixes: every node carries the places from which a piece is still
being read, as states of the vocabulary's own trie, and hands them to its
children. Terminal nodes store the counts of whole pre-tokens, which the texts
then add up. Pre-tokens above ``LONGEST`` bytes are scored one at a time by
the same recurrence.

Defined results: null text counts as empty and has 0 tokens; rows are
independent, so repeated rows and ids stay; texts are counted whole; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tslake.llm.common import held, row_blocks, share, text_buffer
from tslake.llm.pretokens import HashTable, PieceCodes, flatten, ragged, read_ranks

RANKS = "byte_bpe_50k.tiktoken"
SHIFT = 2.7
LONGEST = 128
#: Pre-tokens in one trie; bounds its arrays.
TRIE_PIECES = 40_000


class Unigram:
    """The vocabulary's trie and the log-probabilities of its tokens."""

    def __init__(self, tokens: list[bytes]):
        weights = 1.0 / (np.arange(len(tokens)) + SHIFT)
        self.scores = np.log(weights) - np.log(weights.sum())
        children: dict[int, int] = {}
        token_at = [-1]
        for rank, token in enumerate(tokens):
            state = 0
            for byte in token:
                key = state << 8 | byte
                if key not in children:
                    children[key] = len(token_at)
                    token_at.append(-1)
                state = children[key]
            token_at[state] = rank
        self.token_at = np.array(token_at, np.int32)
        self.children = HashTable(np.fromiter(children, np.int64, len(children)), np.fromiter(children.values(), np.int32, len(children)), -1)
        if any(self.token_at[self.children.look_up(np.arange(256))] < 0):
            raise ValueError("the vocabulary must hold all single bytes")

    def count_one(self, piece: bytes) -> tuple[int, float]:
        """(tokens, score) of a single pre-token."""
        best = [(0.0, 0)] + [(-np.inf, 0)] * len(piece)
        states: list[tuple[int, int]] = []
        for end, byte in enumerate(piece, 1):
            keys = np.array([s << 8 | byte for _, s in states] + [byte], np.int64)
            states = [(start, int(s)) for start, s in zip([b for b, _ in states] + [end - 1], self.children.look_up(keys)) if s >= 0]
            for start, state in states:
                rank = self.token_at[state]
                if rank >= 0:
                    score, n = best[start]
                    new = (score + self.scores[rank], n + 1)
                    if (new[0], -new[1]) > (best[end][0], -best[end][1]):
                        best[end] = new
        return best[-1][1], float(best[-1][0])

    def count_sorted(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, score) of distinct pre-tokens in ascending order."""
        data, offsets = flatten(pieces)
        lengths = np.diff(offsets)
        counts, scores = np.zeros(len(pieces), np.int64), np.zeros(len(pieces))
        rows = np.arange(len(pieces))  # pre-tokens that go on below the current level
        node = np.zeros(len(pieces), np.int64)  # and the node each has reached
        node_score, node_count = np.zeros(1), np.zeros(1, np.int64)
        # places being read at each node: start's score and count, state of the vocabulary's trie
        open_at = np.zeros(2, np.int64)
        open_score, open_count, open_state = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for depth in range(1, int(lengths.max(initial=0)) + 1):
            going = lengths[rows] >= depth
            rows, node = rows[going], node[going]
            byte = data[offsets[rows] + depth - 1].astype(np.int64)
            first = np.ones(len(rows), bool)
            first[1:] = (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])
            parent, letter = node[first], byte[first]
            node = np.cumsum(first) - 1
            n = len(parent)
            # what the parents were reading, and the place that begins at each parent
            inherited, at = ragged(np.arange(len(open_state)), open_at, parent)
            sizes = np.diff(at) + 1
            ends = np.cumsum(sizes)
            last = np.zeros(int(ends[-1]), bool)
            last[ends - 1] = True
            score, count, state = np.empty(len(last)), np.empty(len(last), np.int64), np.zeros(len(last), np.int64)
            score[~last], score[last] = open_score[inherited], node_score[parent]
            count[~last], count[last] = open_count[inherited], node_count[parent]
            state[~last] = open_state[inherited]
            owner = np.repeat(np.arange(n), sizes)
            state = self.children.look_up(state << 8 | letter[owner]).astype(np.int64)
            alive = state >= 0
            score, count, state, owner = score[alive], count[alive], state[alive], owner[alive]
            rank = self.token_at[state]
            ended = np.flatnonzero(rank >= 0)
            total, begin = score[ended] + self.scores[rank[ended]], np.searchsorted(owner[ended], np.arange(n))
            node_score = np.maximum.reduceat(total, begin)
            best = total == node_score[owner[ended]]
            node_count = np.minimum.reduceat(np.where(best, count[ended] + 1, np.iinfo(np.int64).max), begin)
            open_score, open_count, open_state = score, count, state
            open_at = np.searchsorted(owner, np.arange(n + 1))
            terminal = lengths[rows] == depth
            counts[rows[terminal]], scores[rows[terminal]] = node_count[node[terminal]], node_score[node[terminal]]
        return counts, scores

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of distinct pre-tokens in any order."""
        order = sorted(range(len(pieces)), key=pieces.__getitem__)
        out = np.zeros(len(pieces), np.int64)
        short = [i for i in order if len(pieces[i]) <= LONGEST]
        for lo in range(0, len(short), TRIE_PIECES):
            some = short[lo : lo + TRIE_PIECES]
            out[some] = self.count_sorted([pieces[i] for i in some])[0]
        for i in order:
            if len(pieces[i]) > LONGEST:
                out[i] = self.count_one(pieces[i])[0]
        return out


class Counter(PieceCodes):
    """Stored counts of the pre-tokens seen so far."""

    def __init__(self, model: Unigram, pattern: str):
        super().__init__(regex.compile(pattern).findall)
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.stored = np.zeros(0, np.int64)

    def add(self, pieces: list[str]) -> None:
        self.stored = np.concatenate([self.stored, self.model.count([p.encode() for p in pieces])])
        self.number(pieces)

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pre-tokens, tokens) of each text."""
        codes, begins = self.of(texts)
        total = np.concatenate([[0], np.cumsum(self.stored[codes])])
        return np.diff(begins), np.diff(total[begins])


def model(path: str | None = None) -> Unigram:
    return Unigram(read_ranks(path or public_tokenizers.path(RANKS)))


def count(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every whole text. The model (bounded by
    its file) is built once and broadcast."""
    shared = share(docs.sparkSession, model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(held(shared), pattern)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for lo, hi in row_blocks(offsets):
                pretokens, tokens = counter.count([t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(pretokens), pa.array(tokens)], names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
