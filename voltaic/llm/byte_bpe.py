"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A text is split by a pattern; each match is merged on its own. A segment tree
over the match's byte positions holds, at each leaf, the rank of the pair that
starts there (live neighbours only) and, above, the smallest rank below. The
leftmost smallest pair is found by one descent; a merge updates the merged
pair, its left neighbour and the swallowed leaf, each in logarithmic time. A
match of n bytes costs O(n log n), also a run of a million equal characters.

Short matches are merged many at a time: one tree a row of a numpy matrix, all
rows one merge a step. Matches repeat a lot, so each Python worker remembers
encoded runs of non-space text in a cache of bounded size; a hit and a miss
give the same ids. Cutting a text into such runs first is right for
``CUT_PATTERN``, which begins a match at every space between two other
characters and never takes white space after other characters into a match;
with any other pattern each text's own matches are taken one by one.

Null and empty texts have no ids and decode to no bytes. Repeated rows, ties
and further columns are kept as they are; every row is handled by itself.
"""
from __future__ import annotations

import base64
import functools
import re

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm.common import BINARY, LONG, map_text, worker_state

#: Fixed value: the pattern for which runs may be cut first.
CUT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Above every rank of a vocabulary.
NO_PAIR = 1 << 40
#: Entries of a worker's cache per generation (about 200 bytes each); two generations are held.
CACHE_ENTRIES = 200_000


def read_ranks(path: str) -> bytes:
    """The rank file's content, read on the driver (about 1 MB) to be broadcast."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line)}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one match: its own rank, or the merges in rank order, leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    size = 1 << max(1, (n - 1).bit_length())
    tree = [NO_PAIR] * (2 * size)
    for i in range(n - 1):
        tree[size + i] = get(piece[i : i + 2], NO_PAIR)
    for i in range(size - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left <= right else right
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(leaf: int, value: int) -> None:
        i = size + leaf
        tree[i] = value
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            least = left if left <= right else right
            if tree[i] == least:
                return
            tree[i] = least
            i >>= 1

    def pair(start: int, stop: int) -> int:
        return get(piece[start:stop], NO_PAIR) if stop - start <= longest else NO_PAIR

    while tree[1] != NO_PAIR:
        i = 1
        while i < size:
            i *= 2
            if tree[i] > tree[i + 1]:
                i += 1
        i -= size
        swallowed = after[i]
        stop = after[swallowed]
        after[i] = stop
        put(swallowed, NO_PAIR)
        if stop < n:
            before[stop] = i
            put(i, pair(i, after[stop]))
        else:
            put(i, NO_PAIR)
        if before[i] >= 0:
            put(before[i], pair(before[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Cache:
    """Two generations of a dict: when the young one is full, the old one is forgotten."""

    #: Longer keys are not kept.
    LONGEST = 64

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def split(self, keys: set) -> tuple[dict, list]:
        """Known values by key, and the other keys."""
        young, old = self.young, self.old
        known = {k: young[k] for k in keys if k in young}
        again = {k: old[k] for k in keys if k in old and k not in known}
        known.update(again)
        young.update(again)
        return known, [k for k in keys if k not in known]

    def update(self, values: dict) -> None:
        self.young.update((k, v) for k, v in values.items() if len(k) <= self.LONGEST)
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}


class PairTable:
    """Rank of the token that two adjacent tokens make, by binary search over their packed ids."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(-1 << 40))
        self.values = np.append(np.array(values, np.int64)[order], NO_PAIR)
        self.sorted = self.keys[:-1]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.sorted, keys)
        return np.where(self.keys[at] == keys, self.values[at], NO_PAIR)


def merge_batch(pieces: list[bytes], size: int, byte_ids: np.ndarray, pairs: PairTable) -> list[bytes]:
    """``merge`` for many pieces of 2 to ``size`` bytes (a power of two): one segment tree a row, all rows in step."""
    count, levels = len(pieces), size.bit_length() - 1
    lengths = np.array([len(p) for p in pieces], np.int64)
    flat = byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    row = np.repeat(np.arange(count), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    token = np.zeros((count, size + 1), np.int64)
    token[row, column] = flat
    tree = np.full((count, 2 * size), NO_PAIR, np.int64)
    first = column < lengths[row] - 1
    tree[row[first], size + column[first]] = pairs(flat[first], flat[np.flatnonzero(first) + 1])
    for level in range(levels, 0, -1):
        low = 1 << (level - 1)
        tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
    after = np.tile(np.arange(1, size + 2), (count, 1))
    before = np.tile(np.arange(-1, size), (count, 1))
    rows = np.flatnonzero(tree[:, 1] != NO_PAIR)
    while len(rows):
        at = np.ones(len(rows), np.int64)
        for _ in range(levels):
            at *= 2
            at += tree[rows, at] > tree[rows, at + 1]
        at -= size
        made = tree[rows, 1]
        swallowed = after[rows, at]
        stop = after[rows, swallowed]
        after[rows, at] = stop
        token[rows, at] = made
        before[rows, stop] = at
        left = before[rows, at]
        has_left, has_right = left >= 0, stop < lengths[rows]
        tree[rows, size + swallowed] = NO_PAIR
        tree[rows, size + at] = np.where(has_right, pairs(made, token[rows, stop]), NO_PAIR)
        inner = np.where(has_left, left, at)
        r = rows[has_left]
        tree[r, size + left[has_left]] = pairs(token[r, left[has_left]], made[has_left])
        paths = [size + swallowed, size + at, size + inner]
        for _ in range(levels):
            paths = [i >> 1 for i in paths]
            for i in paths:
                tree[rows, i] = np.minimum(tree[rows, 2 * i], tree[rows, 2 * i + 1])
        rows = rows[tree[rows, 1] != NO_PAIR]
    live = np.zeros((count, size + 1), bool)
    at, rows = np.zeros(count, np.int64), np.arange(count)
    while len(rows):
        live[rows, at] = True
        at = after[rows, at]
        go = at < lengths[rows]
        rows, at = rows[go], at[go]
    ids = token[live].astype("<u4").tobytes()
    edges = np.concatenate([[0], np.cumsum(live.sum(axis=1))]) * 4
    return [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


class Codec:
    """Encoder and decoder of one vocabulary; lives as long as its Python worker."""

    #: Runs of non-space text with the space before them, and white space as the pattern splits it.
    RUNS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
    #: White space for ``re`` alone: texts with these are split by the pattern itself.
    ODD = re.compile("[\x1c-\x1f]")
    #: Sizes of the trees that are merged many at a time; longer matches get a tree of their own.
    SIZES = (4, 8, 16, 32, 64)
    #: Pieces merged at a time.
    ROWS = 20_000

    def __init__(self, content: bytes, pattern: str):
        self.ranks = parse_ranks(content)
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self.cuts_runs = pattern == CUT_PATTERN
        self.runs = Cache(CACHE_ENTRIES)
        self.pairs = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int32)
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def matches(self, text: str) -> list[str]:
        """Whole matches of the pattern, groups or not."""
        return [m.group() for m in self.pattern.finditer(text)] if self.pattern.groups else self.pattern.findall(text)

    def merged(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of each match."""
        out: dict[str, bytes] = {}
        by_size: dict[int, tuple[list, list]] = {s: ([], []) for s in self.SIZES}
        for piece in pieces:
            raw = piece.encode("utf-8")
            whole = self.ranks.get(raw)
            if whole is not None:
                out[piece] = whole.to_bytes(4, "little")
                continue
            size = 1 << max(2, (len(raw) - 1).bit_length())
            if size > self.SIZES[-1]:
                out[piece] = np.array(merge(raw, self.ranks, self.longest), "<u4").tobytes()
            else:
                by_size[size][0].append(piece)
                by_size[size][1].append(raw)
        for size, (names, raws) in by_size.items():
            for i in range(0, len(raws), self.ROWS):
                out.update(zip(names[i : i + self.ROWS], merge_batch(raws[i : i + self.ROWS], size, self.byte_ids, self.pairs)))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [
            [] if not t else self.RUNS.findall(t) if self.cuts_runs and not self.ODD.search(t) else self.matches(t)
            for t in texts
        ]
        known, new = self.runs.split(set().union(*split))
        matches = [self.matches(run) if self.cuts_runs else [run] for run in new]
        pieces = self.merged(set().union(*matches))
        made = {
            run: pieces[own[0]] if len(own) == 1 else b"".join([pieces[m] for m in own])
            for run, own in zip(new, matches, strict=True)
        }
        known.update(made)
        self.runs.update(made)
        return [b"".join(map(known.__getitem__, runs)) for runs in split]

    def decode(self, ids: list[bytes | None]) -> list[bytes]:
        """Bytes of each id string; one gather over the vocabulary's bytes for all."""
        flat = np.frombuffer(b"".join([x or b"" for x in ids]), "<u4").astype(np.int32)
        lengths = self.lengths[flat]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        gather = np.repeat((self.starts[flat] - (ends - lengths)).astype(np.int32), lengths)
        gather += np.arange(total, dtype=np.int32)
        data = self.bytes[gather].tobytes()
        edges = np.concatenate([[0], ends])[np.cumsum([0] + [len(x or b"") // 4 for x in ids])].tolist()
        return [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def codec(content: bytes, pattern: str) -> Codec:
    return worker_state(__name__, (hash(content), pattern), lambda: Codec(content, pattern))


def _encode_setup(vocabulary, pattern: str, decode: bool):
    own = codec(vocabulary.value, pattern)

    def fn(texts: list) -> list:
        ids = own.encode(texts)
        counts = [len(x) // 4 for x in ids]
        return [counts, ids, own.decode(ids)] if decode else [counts, ids]

    return fn


def _decode_setup(vocabulary, pattern: str):
    own = codec(vocabulary.value, pattern)
    return lambda ids: [own.decode(ids)]


def load_vocabulary(spark: SparkSession, path: str):
    """Broadcast of the rank file at ``path`` on the driver."""
    return spark.sparkContext.broadcast(read_ranks(path))


def encode(
    docs: DataFrame, *, path: str, pattern: str, text_col: str = "text", decode: bool = False, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit), without a shuffle.

    ``decode=True`` also decodes the ids in the same pass (``decoded``, bytes).
    Columns of these names in the input are replaced; ``keep_text=False`` leaves
    out the texts.
    """
    columns = {"n_tokens": LONG, "ids": BINARY} | ({"decoded": BINARY} if decode else {})
    vocabulary = load_vocabulary(docs.sparkSession, path)
    return map_text(docs, text_col, columns, functools.partial(_encode_setup, vocabulary, pattern, decode), keep_text)


def decode(encoded: DataFrame, *, path: str, pattern: str = r"\S+|\s+", ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the bytes of ``ids_col`` as ``decoded``; null ids give no bytes."""
    vocabulary = load_vocabulary(encoded.sparkSession, path)
    return map_text(encoded, ids_col, {"decoded": BINARY}, functools.partial(_decode_setup, vocabulary, pattern))


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of an encoded and decoded table."""
    return encoded.select(
        id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
