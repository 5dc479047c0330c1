"""Token ids in Arrow IPC files with fixed-size rows.

Documents are dealt into shards by ranges of the id and sorted inside. A
shard's ids, each document ending with ``end_id``, form one stream that is cut
into rows of ``length`` ids (``fixed_size_list``, 16 bits an id where the vocabulary
allows, else 32) with a bit mask of the same shape;
only a file's last row is padded. Each row also lists the documents that start
in it. Every record batch but a file's last has ``BATCH_ROWS`` rows, so a row's
batch follows from its number; ``Rows`` memory-maps a file and gives any row
without a copy.

The tokenizer works on the distinct white-space-separated runs of a slice of
rows, remembered in a cache of bounded size: the vocabulary's splitter never
joins text across white space. A slice's ids are then gathered by run number.
Texts with white space that only some splitters know go through whole. Added
tokens written in a text are recognised, as by the library's own
``encode(text, add_special_tokens=False)``: runs that hold one go through the
library, texts where one may span or follow from white space go through whole.

Null and empty texts have no ids but the end id. Rows with equal ids follow
each other in an order given by a hash of their texts, then the texts; null ids
come first.
"""
from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch, ship, slices
from voltaic.llm.files import new_name, reading, resolve, writing

#: A worker forgets its cache when it holds more runs and words than this.
CACHE_ENTRIES = 1_000_000
#: Rows of an Arrow record batch in a file.
BATCH_ROWS = 512
_STATES: dict = {}


class Table:
    """Ids by string: a row number each, the ids of all rows one after another in one array."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def find(self, keys: list[str]) -> np.ndarray:
        """Row of each key, -1 for unknown ones."""
        return np.fromiter(map(self.rows.get, keys, itertools.repeat(-1)), np.int64, len(keys))

    def add(self, keys: list[str], lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Rows of the new keys."""
        rows = np.arange(len(self.rows), len(self.rows) + len(keys))
        self.rows.update(zip(keys, rows.tolist(), strict=True))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.ids = np.append(self.ids, ids)
        return rows

    def join(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' ids in one array, and each row's number of them."""
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[rows] - ends + lengths, lengths) + np.arange(lengths.sum())
        return self.ids[at], lengths


class Encoder:
    """Ids by the tokenizers library, a distinct run once.

    ``encode_special_tokens`` is the library's flag: special tokens written in a text are spelt out
    when it is set, recognised when not.
    """

    #: White space that not every splitter takes for such.
    ODD = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    #: Words of lower-case Latin letters, accented ones included.
    LATIN = r"^[a-z\x{df}-\x{f6}\x{f8}-\x{17f}]+$"

    def __init__(self, content: str, encode_special_tokens: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        self.normalize = self.tokenizer.normalizer.normalize_str
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size()
        # The splitter's spelling of each accented letter, byte by byte.
        self.letters = {c: self.split(chr(c))[0][0] for c in range(0xDF, 0x180) if c != 0xF7}
        added = self.tokenizer.get_added_tokens_decoder().values()
        added = [t for t in added if t.content and not (t.special and encode_special_tokens)]
        #: Matches runs that hold an added token, or nothing.
        self.added = "|".join(_literal(t.content) for t in added) or r"[^\x{0}-\x{10ffff}]"
        #: Matches texts that go through whole; tokens found in normalized text could be in any.
        wide = [_literal(t.content) for t in added if any(c.isspace() for c in t.content)]
        self.whole = "" if any(t.normalized for t in added) else "|".join([self.ODD, *wide])
        self._forget()

    def _forget(self) -> None:
        self.runs, self.words = Table(), Table()
        self.runs.add([""], np.zeros(1, np.int64), np.zeros(0, "<u4"))

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return _flat(made)

    def _words(self, words: list[str]) -> np.ndarray:
        """Rows of words that the splitter leaves whole; the model sees each new one once."""
        rows = self.words.find(words)
        new = np.flatnonzero(rows < 0)
        keys = [words[i] for i in new.tolist()]
        tokenize = self.model.tokenize
        ids, lengths = _flat([[t.id for t in tokenize(w)] for w in keys])
        rows[new] = self.words.add(keys, lengths, ids)
        return rows

    def _encode_runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's normalizer and splitter on many runs at once, its model on each distinct word."""
        normal = self.normalize(" ".join(runs)).split(" ")
        if len(normal) != len(runs):
            return self._library(runs)
        own = pa.array(normal, pa.string())
        # Latin letters, with full stops and commas after them or none: the splitter cuts between the two.
        body = pc.ascii_rtrim(own, ".,")
        latin = pc.match_substring_regex(body, self.LATIN)
        ascii_ = pc.and_(latin, pc.string_is_ascii(body))
        simple = latin.to_numpy(zero_copy_only=False)
        accented = np.flatnonzero(pc.and_not(latin, ascii_).to_numpy(zero_copy_only=False))
        size = pc.utf8_length(body).to_numpy()
        tailed = np.flatnonzero(simple & (pc.utf8_length(own).to_numpy() > size))
        tails = [normal[i][n:] for i, n in zip(tailed.tolist(), size[tailed].tolist(), strict=True)]
        odd = np.flatnonzero(~simple)
        other = [normal[i] for i in odd.tolist()]
        pieces = self.split(" ".join(other)) if other else []
        ends = np.cumsum([len(r) + 1 for r in other])
        at = odd[np.searchsorted(ends, [span[0] for _, span in pieces], side="right")] if pieces else odd[:0]
        spelt = [w.translate(self.letters) for w in body.take(accented).to_pylist()]
        made = pa.array(spelt + tails + [p for p, _ in pieces], pa.string())
        found = pa.concat_arrays([body.filter(ascii_), made]).dictionary_encode()
        of_run = np.concatenate([np.flatnonzero(ascii_.to_numpy(zero_copy_only=False)), accented, tailed, at])
        order = np.argsort(of_run, kind="stable")
        rows = self._words(found.dictionary.to_pylist())[found.indices.to_numpy()[order]]
        ids, lengths = self.words.join(rows)
        return ids, np.bincount(of_run[order], lengths, len(runs)).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and each text's number of them."""
        if len(self.runs.rows) + len(self.words.rows) > CACHE_ENTRIES or len(self.runs.ids) > 8 * CACHE_ENTRIES:
            self._forget()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.whole)
        lists = pc.ascii_split_whitespace(pc.if_else(odd, "", texts))
        found = lists.flatten().dictionary_encode()
        runs = found.dictionary.to_pylist()
        row = self.runs.find(runs)
        new = np.flatnonzero(row < 0)
        special = pc.match_substring_regex(found.dictionary.take(pa.array(new)), self.added)
        special = special.to_numpy(zero_copy_only=False)
        for method, rows in ((self._encode_runs, new[~special]), (self._library, new[special])):
            for i in range(0, len(rows), 50_000):
                part = rows[i : i + 50_000]
                keys = [runs[k] for k in part.tolist()]
                ids, lengths = method(keys)
                row[part] = self.runs.add(keys, lengths, ids)
        ids, lengths = self.runs.join(row[found.indices.to_numpy()])
        edges = np.append(0, np.cumsum(lengths))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        lengths = np.diff(edges)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(whole):
            made = np.split(ids, edges[1:-1])
            for i in whole.tolist():
                made[i], lengths[i : i + 1] = self._library([texts[i].as_py()])
            ids = np.concatenate(made)
        return ids, lengths


def _literal(text: str) -> str:
    """A regular expression (RE2) for the text itself."""
    return "".join(c if c.isalnum() else rf"\x{{{ord(c):x}}}" for c in text)


def _flat(made: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, made), np.int64, len(made))
    return np.fromiter(itertools.chain.from_iterable(made), "<u4", int(lengths.sum())), lengths


def _encoder(content: str) -> Encoder:
    key = hash(content)
    if key not in _STATES:
        _STATES.clear()
        _STATES[key] = Encoder(content, encode_special_tokens=False)
    return _STATES[key]


def _id_type(vocabulary: int) -> pa.DataType:
    """The narrowest unsigned type that holds every id: half the file for vocabularies up to 65,536."""
    return pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()


def _schema(length: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("input_ids", pa.list_(ids, length)),
        ("mask", pa.list_(pa.bool_(), length)),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_starts", pa.list_(pa.int64())),
    ])


class ShardWriter:
    """One file: ids come in document by document, full rows go out in batches."""

    def __init__(self, out, length: int, ids: pa.DataType):
        self.length, self.schema, self.dtype = length, _schema(length, ids), ids.to_pandas_dtype()
        self.file = pa.ipc.new_file(out, self.schema)
        self.buffer: list[np.ndarray] = []
        self.buffered = self.written = 0
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc, self.written + self.buffered))
        self.buffer.append(ids)
        self.buffered += len(ids)
        if self.buffered >= self.length * BATCH_ROWS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.buffer) if self.buffer else np.zeros(0, self.dtype)
        rows = -(-len(ids) // self.length) if last else len(ids) // self.length // BATCH_ROWS * BATCH_ROWS
        used = min(len(ids), rows * self.length)
        flat = np.zeros(rows * self.length, self.dtype)
        flat[:used] = ids[:used]
        mask = np.arange(rows * self.length) < used
        here = [(d, s) for d, s in self.docs if s < self.written + used]
        self.docs = self.docs[len(here) :]
        row = np.array([(s - self.written) // self.length for _, s in here], np.int64)
        edges = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
        lists = [
            pa.ListArray.from_arrays(edges, pa.array([x[i] for x in here], pa.int64())) for i in (0, 1)
        ]
        fixed = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), self.length).cast(self.schema.field(i).type)
            for i, x in enumerate((flat, mask))
        ]
        for i in range(0, rows, BATCH_ROWS):
            batch = pa.RecordBatch.from_arrays(fixed + lists, schema=self.schema)
            self.file.write_batch(batch.slice(i, BATCH_ROWS))
        self.written += used
        self.buffer, self.buffered = [ids[used:]], len(ids) - used

    def close(self) -> None:
        self._flush(True)
        self.file.close()


class Rows:
    """Rows of one memory-mapped file by number, without a copy. The file is on a mounted folder."""

    def __init__(self, name: str):
        system, path = resolve(name)
        if not isinstance(system, fs.LocalFileSystem):
            raise ValueError(f"{name} cannot be memory-mapped")
        self.file = pa.ipc.open_file(pa.memory_map(path))
        self.length = self.file.schema.field("input_ids").type.list_size
        batches = self.file.num_record_batches
        self.size = (batches - 1) * BATCH_ROWS + self.file.get_batch(batches - 1).num_rows if batches else 0

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, row: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of a row."""
        if not 0 <= row < self.size:
            raise IndexError(row)
        batch = self.file.get_batch(row // BATCH_ROWS)
        start = row % BATCH_ROWS * self.length
        ids, mask = (batch.column(i).values.slice(start, self.length) for i in (0, 1))
        return ids.to_numpy(), mask


def _write(folder: str, vocabulary, length: int, end_id: int, batches) -> Iterator[pa.RecordBatch]:
    """One file per partition; yields name, documents, ids and the smallest shard key."""
    encoder = _encoder(vocabulary.value)
    writer, count, shard = None, 0, None
    name = new_name(folder, ".arrow")
    kind = _id_type(max(encoder.size, end_id + 1))
    for batch in batches:
        for part in slices(batch, 1, 8 << 20):
            if writer is None:
                context = writing(name)
                writer, shard = ShardWriter(context.__enter__(), length, kind), part.column(2)[0].as_py()
            ids, lengths = encoder.encode(part.column(1))
            stops = np.cumsum(lengths)
            ids = np.insert(ids.astype(kind.to_pandas_dtype()), stops, end_id)
            stops = stops + np.arange(1, len(stops) + 1)
            for doc, start, stop in zip(part.column(0).to_pylist(), (stops - lengths - 1).tolist(), stops.tolist(), strict=True):
                writer.add(doc, ids[start:stop])
            count += part.num_rows
    if writer is not None:
        writer.close()
        context.__exit__(None, None, None)
        total = writer.written
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([name]), pa.array([count], pa.int64()), pa.array([total], pa.int64())],
            names=["shard", "file", "documents", "ids"],
        )


def write(
    docs: DataFrame,
    scratch: Scratch,
    *,
    path: str,
    end_id: int,
    length: int = 2048,
    shards: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the id files; returns the stored manifest ``(shard, file, documents, ids, start)``.

    Shards follow each other in id order; ``start`` counts the ids of all shards
    before. ``shards`` defaults to the session's shuffle partitions. Only the
    per-shard totals meet in one place.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Spark collects a sample of the range keys: a hash in place of the text keeps it small.
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    dealt = rows.repartitionByRange(shards, "doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "text")
    dealt = dealt.drop("text_hash")
    dealt = dealt.withColumn("shard", F.spark_partition_id())
    run = functools.partial(_write, scratch.folder("ids"), vocabulary, length, end_id)
    files = scratch.store(dealt.mapInArrow(run, "shard int, file string, documents long, ids long"), "files")
    totals = sorted((r["shard"], r["ids"]) for r in files.select("shard", "ids").collect())
    starts, before = [], 0
    for shard, ids in totals:
        starts.append((shard, before))
        before += ids
    started = spark.createDataFrame(starts, "shard int, start long")
    return scratch.store(files.join(F.broadcast(started), "shard"), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for manifest in batches:
        for name, base, total in zip(*(manifest.column(i).to_pylist() for i in range(3)), strict=True):
            with reading(name) as source:
                yield from _documents(pa.ipc.open_file(source), base, total)


def _documents(file, base: int, total: int) -> Iterator[pa.RecordBatch]:
    """Documents of one file, a record batch at a time; a document may span batches."""
    open_doc: list = []
    crc = size = 0

    def made(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    at, rows = 0, []
    for k in range(file.num_record_batches):
        batch = file.get_batch(k)
        ids = batch.column(0).flatten().to_numpy()[: batch.column(1).flatten().true_count].astype("<u4")
        docs, starts = batch.column(2).flatten().to_pylist(), batch.column(3).flatten().to_pylist()
        edges = [*starts, at + len(ids)]
        if open_doc:
            piece = ids[: edges[0] - at]
            crc, size = zlib.crc32(np.ascontiguousarray(piece), crc), size + len(piece)
        for doc, start, stop in zip(docs, edges[:-1], edges[1:], strict=True):
            if open_doc:
                rows.append((open_doc[0], base + open_doc[1], size, crc))
            piece = ids[start - at : stop - at]
            open_doc, crc, size = [doc, start], zlib.crc32(np.ascontiguousarray(piece)), len(piece)
        at += len(ids)
        yield made(rows)
        rows = []
    if at != total:
        raise ValueError(f"{at} ids in a file of {total}")
    if open_doc:
        yield made([(open_doc[0], base + open_doc[1], size, crc)])


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    ship(manifest.sparkSession)
    files = manifest.select("file", "start", "ids").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
