"""Benchmark decontamination with one FM-index per training shard.

A shard is a slice of documents inside a task. Its words become symbols: the
vocabulary of the test windows, and 0 for any other word. Stretches of
vocabulary words shorter than the shortest window cannot hold one and are left
out; the others are joined by separators and indexed: suffix order by prefix
doubling, Burrows-Wheeler transform in a wavelet matrix with cumulative ranks,
suffix positions sampled at every 16th word and every stretch start. All
windows are searched backwards at once; rows found are located by stepping back
to a sampled position. Occurrences become merged word spans by document.

Windows go to the tasks in blocks of at most ``block_windows`` distinct windows
(the number of blocks follows from a count, each block is broadcast); results
of several blocks are merged by row.

A window is ``size`` consecutive words of a benchmark item, an item of fewer
words is one window, an item without words has none. Null and empty texts have
no words, no spans and no items. Items with equal ids count as one; a null item
id is written as ``null``. Repeated documents are handled row by row.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.llm.common import LONG, STRINGS, Scratch, map_text, ship, words

#: Distance of sampled suffix positions.
SAMPLE = 16
SPANS = (
    T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])),
    pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``text`` in order (prefix doubling)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        changed = np.append(False, key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed)
        if not n or rank[order[-1]] == n - 1:
            return order
        width *= 2


class Wavelet:
    """Rank of a symbol before a position: one bit vector with cumulative counts per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.bits = max(1, int(most).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol[i]`` before ``position[i]``."""
        start, stop = np.zeros(len(position), np.int64), position.astype(np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            start = np.where(bit, zeros + ones[start], start - ones[start])
            stop = np.where(bit, zeros + ones[stop], stop - ones[stop])
        return stop - start


class FMIndex:
    """Index of stretches of symbols (1 to ``most``); 0 stands for every separator."""

    def __init__(self, stretches: list[np.ndarray], most: int):
        """``stretches`` hold symbols; suffixes end at their stretch's separator."""
        count = len(stretches)
        lengths = np.array([len(s) for s in stretches], np.int64)
        self.starts = np.cumsum(lengths + 1) - (lengths + 1)
        n = int(lengths.sum()) + count
        text = np.zeros(n, np.int64)
        ends = self.starts + lengths
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = np.concatenate(stretches) if count else []
        # For the order alone, separators differ and come before all symbols: no comparison runs past a stretch.
        ordered = text + count
        ordered[ends] = np.arange(count)
        order = suffix_order(ordered)
        self.text = text
        last = np.where(order > 0, text[order - 1], 0) if n else text
        self.last = last
        self.wavelet = Wavelet(last, most)
        counts = np.bincount(text, minlength=most + 2)
        self.before = np.cumsum(counts) - counts
        sampled = np.zeros(n, bool)
        sampled[::SAMPLE] = True
        sampled[self.starts] = True
        marked = sampled[order] if n else sampled
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.samples = order[marked]

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that start with each window (right-aligned in ``windows``)."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.text), np.int64)
        live = np.arange(len(windows))
        for back in range(1, windows.shape[1] + 1):
            live = live[(lengths[live] >= back) & (high[live] > low[live])]
            symbol = windows[live, -back]
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row, by steps back to a sampled position."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            hit = self.marks[at + 1] > self.marks[at]
            out[open_[hit]] = self.samples[self.marks[at[hit]]] + steps[open_[hit]]
            open_, at = open_[~hit], at[~hit]
            symbol = self.last[at]
            rows[open_] = self.before[symbol] + self.wavelet.rank(symbol, at)
            steps[open_] += 1
        return out


class Windows:
    """Distinct windows of benchmark items as symbols, with the items that hold each."""

    def __init__(self, by_window: dict[tuple[bytes, ...], list[str]]):
        self.items = list(by_window.values())
        self.symbols = {w: i + 1 for i, w in enumerate(sorted({w for key in by_window for w in key}))}
        longest = max(map(len, by_window), default=1)
        self.lengths = np.array([len(key) for key in by_window], np.int64)
        self.array = np.zeros((len(by_window), longest), np.int64)
        for i, key in enumerate(by_window):
            self.array[i, longest - len(key) :] = [self.symbols[w] for w in key]
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 1


def find(windows: Windows, texts: list[str | None]) -> list:
    """Number of words, merged spans, number of hit words and items of each text of a shard."""
    get = windows.symbols.get
    parts, n_words = [], []
    for text in texts:
        own = words(text)
        n_words.append(len(own))
        parts.append(np.fromiter((get(w, 0) for w in own), np.int32, len(own)))
    # One symbol stream with a foreign word between documents.
    bounds = np.concatenate([[0], np.cumsum(np.array(n_words, np.int64) + 1)])
    stream = np.zeros(bounds[-1], np.int32)
    for start, part in zip(bounds[:-1], parts, strict=True):
        stream[start : start + len(part)] = part
    known = np.flatnonzero(np.diff(np.concatenate([[0], (stream > 0).view(np.int8), [0]])))
    begin, end = known[::2], known[1::2]
    long = end - begin >= windows.shortest
    begin, end = begin[long], end[long]
    empty: list = [[] for _ in texts]
    if not len(begin) or not len(windows.lengths):
        return [n_words, empty, [0] * len(texts), [[] for _ in texts]]
    index = FMIndex([stream[a:b].astype(np.int64) for a, b in zip(begin, end, strict=True)], len(windows.symbols))
    low, high = index.search(windows.array, windows.lengths)
    counts = high - low
    window = np.repeat(np.arange(len(low)), counts)
    rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    place = index.locate(rows)
    stretch = np.searchsorted(index.starts, place, side="right") - 1
    start = begin[stretch] + place - index.starts[stretch]
    doc = np.searchsorted(bounds, start, side="right") - 1
    cover = np.zeros(len(stream) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + windows.lengths[window], -1)
    hit = np.cumsum(cover)[:-1] > 0
    n_hit = np.add.reduceat(hit, bounds[:-1]) if len(texts) else np.zeros(0, np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    spans: list[list] = [[] for _ in texts]
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        d = int(np.searchsorted(bounds, a, side="right")) - 1
        spans[d].append({"start": int(a - bounds[d]), "stop": int(b - bounds[d])})
    items: list[set] = [set() for _ in texts]
    for pair in np.unique(doc * len(windows.items) + window):
        items[pair // len(windows.items)].update(windows.items[pair % len(windows.items)])
    return [n_words, spans, n_hit.tolist(), [sorted(i) for i in items]]


def _windows_of(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = [], []
        for item, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            own = words(text)
            for i in range(max(1, len(own) - size + 1) if own else 0):
                ids.append(item)
                out.append(b" ".join(own[i : i + size]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.binary())], ["item", "window"])


def window_blocks(benchmark: DataFrame, *, size: int, id_col: str, text_col: str, block_windows: int) -> Iterator[Windows]:
    """Distinct windows in blocks of about ``block_windows``; one block is on the driver at a time."""
    ship(benchmark.sparkSession)
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col))
    made = items.mapInArrow(functools.partial(_windows_of, size), "item string, window binary").distinct()
    count = made.count()
    blocks = max(1, -(-count // block_windows))
    for block in range(blocks):
        own = made.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block) if blocks > 1 else made
        by_window: dict[tuple[bytes, ...], list[str]] = {}
        table = own.toArrow()
        for item, window in zip(table.column("item").to_pylist(), table.column("window").to_pylist(), strict=True):
            by_window.setdefault(tuple(window.split(b" ")), []).append(item)
        yield Windows(by_window)


def _find_setup(windows):
    return functools.partial(find, windows.value)


def find_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    block_windows: int = 200_000,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (merged word ranges), ``n_hit`` (words in them) and ``items`` (their ids as text).

    One map over the documents per block of windows; no shuffle. With several
    blocks the rows are stored in the shared folder after each but the last, so
    one block's windows are alive at a time. Input columns named like the appended ones are replaced.
    """
    columns = {"n_words": LONG, "spans": SPANS, "n_hit": LONG, "items": STRINGS}
    out = shared = None
    scratch = Scratch(docs.sparkSession, "windows")
    for windows in window_blocks(
        benchmark, size=size, id_col=item_col, text_col=item_text_col, block_windows=block_windows
    ):
        before = shared
        shared = docs.sparkSession.sparkContext.broadcast(windows)
        if out is None:
            out = map_text(docs, text_col, columns, functools.partial(_find_setup, shared))
            continue
        stored = scratch.store(out, "block")
        before.unpersist()
        out = stored
        renamed = {c: f"{c}_before" for c in columns}
        out = map_text(out.withColumnsRenamed(renamed), text_col, columns, functools.partial(_find_setup, shared))
        out = out.withColumn("spans", _merged(F.concat("spans_before", "spans")))
        out = out.withColumn("items", F.array_sort(F.array_union("items_before", "items")))
        length = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["stop"] - x["start"])
        out = out.withColumn("n_hit", length).drop(*renamed.values())
    return out


def _merged(spans):
    """Overlapping or touching spans of a row joined."""

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= span["start"])
        head = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(touches, F.concat(head, F.array(joined))).otherwise(F.concat(done, F.array(span)))

    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return F.aggregate(F.array_sort(spans), empty, add)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and the digest of the item list of each row of ``find_spans``."""
    return found.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
