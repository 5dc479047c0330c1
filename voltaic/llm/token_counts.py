"""Token counts under a unigram vocabulary, by dynamic programming shared through a trie.

A text's pre-tokens are its white-space-separated words, each with the word
mark in front. Distinct pre-tokens are inserted in a trie; a node's best score
(the largest sum of piece scores over the splits of the prefix it stands for)
and the token count of that split are computed once, when the node is made,
from the scores of the nodes above it. Pre-tokens that share a prefix share its
work; a terminal's count is the pre-token's. A document's count is the sum over
its words.

Piece scores follow the rank of the piece in the vocabulary file by Zipf's law,
``-log(rank + 2)``; a character that no piece covers costs its UTF-8 bytes, one
token each, at the score of the rarest piece less ten. Of splits with equal
scores the one whose last piece is longest is taken.

Null, empty and blank texts have no words and no tokens. Words of usual length
go through a trie that is built level by level in numpy, longer ones through a
linked trie of at most ``MAX_NODES`` nodes. A worker remembers counts in a cache
of bounded size, which changes none. No shuffle takes place.
"""
from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame

from voltaic.llm.byte_bpe import Cache
from voltaic.llm.common import LONG, map_text

WORD_MARK = "▁"
#: Nodes of a worker's trie of long words (about 250 bytes each).
MAX_NODES = 100_000
#: Longer words go through the trie one by one.
MAX_BATCH_WORD = 48
#: Distinct words of a level-by-level trie.
BATCH_WORDS = 100_000
#: Counts a worker remembers per generation; two are held.
CACHE_ENTRIES = 300_000
#: Base of the rolling hash by which pieces are looked up, one table per piece length.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STATES: dict = {}


def read_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model in rank order, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [model.id_to_piece(i) for i in plain]


def piece_scores(pieces: list[str]) -> dict[str, float]:
    return {p: -math.log(rank + 2) for rank, p in reversed(list(enumerate(pieces)))}


class Trie:
    """Trie of pre-tokens; ``children[node]`` maps a character to a node."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.floor = min(scores.values(), default=0.0) - 10
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.best, self.tokens = [0.0], [0]
        self.terminals: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of a pre-token; its missing nodes are made."""
        known = self.terminals.get(word)
        if known is not None:
            return known
        if len(self.children) + len(word) > MAX_NODES:
            self.clear()
        text = WORD_MARK + word
        path, node = [0], 0
        for depth, ch in enumerate(text, 1):
            below = self.children[node].get(ch)
            if below is None:
                below = self._node(text, depth, path)
                self.children[node][ch] = below
            node = below
            path.append(node)
        self.terminals[word] = self.tokens[node]
        return self.tokens[node]

    def _node(self, text: str, depth: int, path: list[int]) -> int:
        """A node for ``text[:depth]`` from the nodes on ``path``."""
        get, best, tokens = self.scores.get, self.best, self.tokens
        top, count = -math.inf, 0
        for start in range(max(0, depth - self.longest), depth):
            score = get(text[start:depth])
            if score is not None and best[path[start]] + score > top:
                top, count = best[path[start]] + score, tokens[path[start]] + 1
        if get(text[depth - 1]) is None:
            size = len(text[depth - 1].encode("utf-8", "surrogatepass"))
            if best[path[-1]] + size * self.floor > top:
                top, count = best[path[-1]] + size * self.floor, tokens[path[-1]] + size
        self.children.append({})
        best.append(top)
        tokens.append(count)
        return len(best) - 1


def _powers(count: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(count, _BASE, np.uint64)), dtype=np.uint64)


class BatchCounter:
    """The same dynamic program for many words at once: one trie level after the other.

    A node is a distinct (node above, character); its score is worked out once,
    from one of the words that run through it.
    """

    def __init__(self, scores: dict[str, float]):
        self.scalar = Trie(scores)
        self.longest, self.floor = self.scalar.longest, self.scalar.floor
        self.cache = Cache(CACHE_ENTRIES)
        self.powers = _powers(max(MAX_BATCH_WORD + 1, self.longest))
        by_length: dict[int, list] = {}
        for piece, score in scores.items():
            value = 0
            for ch in piece:
                value = (value * int(_BASE) + ord(ch)) % 2**64
            by_length.setdefault(len(piece), []).append((value, score))
        self.tables = {}
        for length, pairs in by_length.items():
            pairs.sort()
            self.tables[length] = (np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs]))

    def _score(self, length: int, hashes: np.ndarray) -> np.ndarray:
        if length not in self.tables:
            return np.full(len(hashes), -np.inf)
        keys, scores = self.tables[length]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, scores[at], -np.inf)

    def count_new(self, words: list[str]) -> np.ndarray:
        """Tokens of words of at most ``MAX_BATCH_WORD`` characters."""
        sizes = np.array([len(w) + 1 for w in words])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        deepest = int(sizes[0])
        codes = np.zeros((deepest, len(words)), np.uint64)
        flat = np.frombuffer("".join(WORD_MARK + words[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
        column = np.repeat(np.arange(len(words)), sizes)
        depth = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        codes[depth, column] = flat
        hashes = [np.zeros(len(words), np.uint64)]
        node, best, tokens = [np.zeros(len(words), np.int64)], [np.zeros(1)], [np.zeros(1, np.int64)]
        result = np.zeros(len(words), np.int64)
        for d in range(1, deepest + 1):
            # Words are in descending length: those of at least d characters come first.
            live = int(np.searchsorted(-sizes, -d, side="right"))
            char = codes[d - 1, :live]
            hashes.append(hashes[-1][:live] * _BASE + char)
            _, first, inverse = np.unique(
                node[-1][:live] << 21 | char.astype(np.int64), return_index=True, return_inverse=True
            )
            node.append(inverse)
            top, count = np.full(len(first), -np.inf), np.zeros(len(first), np.int64)
            for length in range(min(d, self.longest), 0, -1):
                own = hashes[d][first] - hashes[d - length][first] * self.powers[length]
                above = node[d - length][first]
                score = best[d - length][above] + self._score(length, own)
                better = score > top
                top = np.where(better, score, top)
                count = np.where(better, tokens[d - length][above] + 1, count)
                if length == 1:
                    ch = char[first]
                    size = 1 + (ch > 0x7F).astype(np.int64) + (ch > 0x7FF) + (ch > 0xFFFF)
                    score = best[d - 1][above] + size * self.floor
                    spelled = (self._score(1, own) == -np.inf) & (score > top)
                    top = np.where(spelled, score, top)
                    count = np.where(spelled, tokens[d - 1][above] + size, count)
            best.append(top)
            tokens.append(count)
            ended = sizes[:live] == d
            result[order[:live][ended]] = count[inverse[ended]]
        return result

    def count(self, distinct: set[str]) -> dict[str, int]:
        """Tokens of each word."""
        out, new = self.cache.split(distinct)
        made = {w: self.scalar.count(w) for w in new if len(w) > MAX_BATCH_WORD}
        new = sorted(w for w in new if len(w) <= MAX_BATCH_WORD)
        for i in range(0, len(new), BATCH_WORDS):
            part = new[i : i + BATCH_WORDS]
            made.update(zip(part, self.count_new(part).tolist(), strict=True))
        self.cache.update(made)
        out.update(made)
        return out


def _setup(pieces):
    content = pieces.value
    key = hash(tuple(content))
    if key not in _STATES:
        _STATES.clear()
        _STATES[key] = BatchCounter(piece_scores(content))
    counter = _STATES[key]

    def fn(texts: list) -> list:
        split = [(t or "").split() for t in texts]
        counts = counter.count(set().union(*split))
        return [[len(s) for s in split], [sum(map(counts.__getitem__, s)) for s in split]]

    return fn


def count_tokens(docs: DataFrame, *, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens``; input columns of these names are replaced."""
    pieces = docs.sparkSession.sparkContext.broadcast(read_pieces(path))
    return map_text(docs, text_col, {"n_words": LONG, "n_tokens": LONG}, functools.partial(_setup, pieces))
