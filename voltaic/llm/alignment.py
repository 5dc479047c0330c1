r"""Alignment of two tokenizers' tokens by sparse incidence matrices.

Tokenizer A is a byte-level BPE (``tokenizers`` file, special tokens' strings
read as plain text) over a space and the text, B a piece model
(``sentencepiece`` file) over the text, which adds that space itself. Both
spell the same bytes; a text where they do not (null and empty ones too) has
no tokens.

* A token-byte incidence matrix has a row per token and a one in each byte that
  the token covers. ``A·Bᵀ`` by Gustavson's row products links the tokens whose
  byte ranges overlap; an entry's value is the number of shared bytes.
* Bytes where tokens of both sides end cut the text into groups. A group
  incidence matrix has a row per token and a one in its group; the product of
  the two links every A token of a group with every B token of it. Its rows are
  sized first (the symbolic phase) and made in blocks, so a long group does not
  fill the memory.

A single space between two other characters is where both tokenizers start a
token, whatever stands around it: the pre-tokenizer's pattern begins a match
there, and no piece holds a space after another character. Texts are cut there,
and each distinct cut is encoded and aligned once, many in one block-diagonal
product; a worker keeps the short ones for the documents that follow.

Corpus-wide counts (in how many documents an id pair is linked) are sums over
blocks of documents: a block gives each pair once with its documents, pairs
are counted by a shuffle on the pair, and the counts come back to a block for
its own pairs only. Nothing is broadcast and nothing passes the driver.

Null ids, repeated ids and repeated rows are allowed: every input row is a
document of its own. Columns other than id and text are not read. An empty
table gives an empty table.
"""
from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.llm.common import SLICE_BYTES, Scratch, ship, slices, worker_state

#: Text bytes of a block of documents (or one longer document).
BLOCK_BYTES = 4 << 20
#: Bytes of distinct cuts aligned in one product.
BATCH_BYTES = 256 << 10
#: A worker forgets the cuts it knows when it holds more of them, or more id pairs, than this.
KEPT_CUTS, KEPT_PAIRS = 300_000, 6_000_000
#: Entries of the group product made at a time.
PRODUCT = 1 << 20
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: In ASCII, where a space has a neighbour that is white space too.
_ODD = ["  ", *(pair for c in "\t\n\v\f\r\x1c\x1d\x1e\x1f" for pair in (c + " ", " " + c))]
#: Counts of a text or cut.
_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]


# ---- sparse matrices ----


@dataclass
class Csr:
    """A sparse matrix by rows: columns ``cols[ptr[i]:ptr[i + 1]]`` of row i hold ``values``."""

    ptr: np.ndarray
    cols: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def ones(ptr: np.ndarray, cols: np.ndarray, width: int) -> Csr:
        return Csr(ptr, cols, np.ones(len(cols), np.int64), width)

    @property
    def height(self) -> int:
        return len(self.ptr) - 1

    def rows(self) -> np.ndarray:
        """Row number of every entry."""
        return np.repeat(np.arange(self.height), np.diff(self.ptr))

    def transposed(self) -> Csr:
        """Entries dealt to their columns by counting."""
        order = np.argsort(self.cols, kind="stable")
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=self.width))])
        return Csr(ptr, self.rows()[order], self.values[order], self.height)

    def slice(self, first: int, last: int) -> Csr:
        a, b = self.ptr[first], self.ptr[last]
        return Csr(self.ptr[first : last + 1] - a, self.cols[a:b], self.values[a:b], self.width)


def row_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Symbolic phase: terms of each row of ``left · right``, before equal columns are added up."""
    sizes = np.concatenate([[0], np.cumsum(np.diff(right.ptr)[left.cols])])
    return sizes[left.ptr[1:]] - sizes[left.ptr[:-1]]


def product(left: Csr, right: Csr) -> Csr:
    """``left · right`` by Gustavson: a row is the sum of the right rows that its entries name."""
    lengths = np.diff(right.ptr)[left.cols]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(right.ptr[left.cols], lengths)
    key = np.repeat(left.rows(), lengths) * right.width + right.cols[at]
    value = np.repeat(left.values, lengths) * right.values[at]
    if len(key) > 1 and (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], np.diff(key) > 0])) if len(key) else np.zeros(0, np.int64)
    row, cols = np.divmod(key[new], max(1, right.width))
    values = np.add.reduceat(value, new) if len(new) else np.zeros(0, np.int64)
    ptr = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=left.height))])
    return Csr(ptr, cols, values, right.width)


def token_bytes(ends: np.ndarray) -> Csr:
    """Token-byte incidence of tokens that end at ``ends``."""
    ptr = np.concatenate([[0], ends])
    return Csr.ones(ptr, np.arange(ptr[-1]), int(ptr[-1]))


def token_groups(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Group incidence of tokens, where groups end at ``cuts``."""
    return Csr.ones(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), len(cuts))


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers (a, b) whose byte ranges overlap, and the bytes they share."""
    linked = product(token_bytes(ends_a), token_bytes(ends_b).transposed())
    return linked.rows(), linked.cols, linked.values


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Bytes where tokens of both sides end (both rise)."""
    at = np.searchsorted(ends_b, ends_a)
    return ends_a[ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a] if len(ends_b) else ends_a[:0]


def group_links(ends_a: np.ndarray, ends_b: np.ndarray, most: int = PRODUCT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token numbers (a, b) in the same group, in blocks of about ``most`` links."""
    cuts = common_ends(ends_a, ends_b)
    left, right = token_groups(ends_a, cuts), token_groups(ends_b, cuts).transposed()
    sizes = np.cumsum(row_sizes(left, right))
    first = 0
    while first < left.height:
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + most, side="right")))
        linked = product(left.slice(first, last), right)
        yield linked.rows() + first, linked.cols
        first = last


def count_group_links(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Tokens of the other side in the group of each A token: row sizes of the group product."""
    cuts = common_ends(ends_a, ends_b)
    return row_sizes(token_groups(ends_a, cuts), token_groups(ends_b, cuts).transposed())


# ---- tokenizers ----


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: U+2581 is a space, ``<0xHH>`` a byte."""
    if re.fullmatch(r"<0x[0-9A-Fa-f]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Vocabulary:
    """Bytes of every token id, in one buffer."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.buffer = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """Joined bytes of a sequence of ids."""
        length = self.length[ids]
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(self.start[ids], length)
        return self.buffer[at]


class Cuts:
    """Alignments of distinct cuts of text, by row: counts, id pairs of all rows one after another, group texts."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.spelled = np.zeros(0, bool)
        self.counts = np.zeros((0, len(_COUNTS)), np.int64)
        self.ptr = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.uint32)
        self.groups: list[bytes] = []

    def full(self) -> bool:
        return len(self.rows) > KEPT_CUTS or len(self.pairs) > KEPT_PAIRS

    def add(self, cuts: list[str], spelled: np.ndarray, counts: np.ndarray, pairs: np.ndarray, groups: list[bytes]) -> None:
        self.rows.update(zip(cuts, range(len(self.rows), len(self.rows) + len(cuts)), strict=True))
        self.spelled = np.append(self.spelled, spelled)
        self.counts = np.concatenate([self.counts, counts])
        links = counts[:, _COUNTS.index("n_links")]
        self.ptr = np.append(self.ptr, self.ptr[-1] + np.cumsum(links))
        self.pairs = np.append(self.pairs, pairs)
        self.groups += groups


def _digits(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``most``, each with room for a separator: start, length, bytes."""
    written = [b"%d," % i for i in range(most)]
    length = np.array([len(w) for w in written], np.int64)
    return np.cumsum(length) - length, length, np.frombuffer(b"".join(written), np.uint8)


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions ``start[i] .. start[i] + length[i] - 1`` of all i, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)


class Aligner:
    """Both tokenizers of a worker and the cuts it has aligned."""

    def __init__(self, file_a: bytes, file_b: bytes):
        # A task has one core: the library's own threads would take the others' and cost more than they bring.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(file_a.decode())
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        alphabet = byte_alphabet()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = Vocabulary([bytes(alphabet.get(c, 63) for c in name) for name in names])
        self.bytes_b = Vocabulary([piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())])
        self.digits = _digits(max(len(self.bytes_a.length), len(self.bytes_b.length)))
        self.known = Cuts()

    def learn(self, cuts: list[str]) -> None:
        """Align the cuts that are not known yet, so many bytes at a time."""
        missing = [c for c in dict.fromkeys(cuts) if c not in self.known.rows]
        first = size = 0
        for k, cut in enumerate(missing):
            size += len(cut) + 1
            if size >= BATCH_BYTES:
                self._align(missing[first : k + 1])
                first, size = k + 1, 0
        if first < len(missing):
            self._align(missing[first:])

    def _align(self, cuts: list[str]) -> None:
        """Align distinct cuts side by side: their incidence matrices are blocks of one."""
        chain = itertools.chain.from_iterable
        ids = (
            [e.ids for e in self.a.encode_batch_fast([" " + c for c in cuts], add_special_tokens=False)],
            self.b.encode(cuts, num_threads=1),
        )
        size = np.array([len(c) + 1 if c.isascii() else len(c.encode()) + 1 for c in cuts])
        text = np.frombuffer((" " + " ".join(cuts)).encode(), np.uint8)
        held = [np.fromiter(map(len, side), np.int64, len(cuts)) for side in ids]
        flat = [np.fromiter(chain(side), np.int64, int(n.sum())) for side, n in zip(ids, held, strict=True)]
        spelled = self._spelled(flat, held, size, text)
        if not spelled.all():
            good = [c for c, ok in zip(cuts, spelled, strict=True) if ok]
            bad = [c for c, ok in zip(cuts, spelled, strict=True) if not ok]
            none = np.zeros((len(bad), len(_COUNTS)), np.int64)
            self.known.add(bad, np.zeros(len(bad), bool), none, np.zeros(0, np.uint32), [b""] * len(bad))
            if good:
                self._align(good)
            return

        ends = [np.cumsum(v.length[f]) for v, f in ((self.bytes_a, flat[0]), (self.bytes_b, flat[1]))]
        a, b, _ = overlap_links(*ends)
        shared = np.concatenate([[0], np.cumsum(count_group_links(*ends))])
        common = common_ends(*ends)
        # Where each cut's tokens, groups and links stop.
        stops = [np.cumsum(n) for n in held]
        stop_groups = np.searchsorted(common, np.cumsum(size), side="right")
        stop_links = np.searchsorted(a, stops[0])
        counts = np.stack([
            held[0], held[1], np.diff(stop_groups, prepend=0), np.diff(stop_links, prepend=0),
            np.diff(shared[stops[0]], prepend=0),
        ], axis=1)
        groups = self._written(flat, ends, common, stop_groups)
        self.known.add(cuts, spelled, counts, pair_key(flat[0][a], flat[1][b]), groups)

    def _spelled(self, flat, held, size: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Whether the tokens of both sides spell each cut."""
        ok = np.ones(len(size), bool)
        stop = np.cumsum(size)
        for ids, n, words in zip(flat, held, (self.bytes_a, self.bytes_b), strict=True):
            made = words.spell(ids)
            ends = np.concatenate([[0], np.cumsum(words.length[ids])])[np.cumsum(n)]
            if len(made) == len(text) and (ends == stop).all():
                wrong = np.concatenate([[0], np.cumsum(made != text)])
                ok &= wrong[stop] == wrong[stop - size]
            else:
                starts = np.concatenate([[0], ends[:-1]])
                ok &= [
                    made[x:y].tobytes() == text[z - k : z].tobytes()
                    for x, y, z, k in zip(starts, ends, stop, size, strict=True)
                ]
        return ok

    def _written(self, flat, ends, common: np.ndarray, stop_groups: np.ndarray) -> list[bytes]:
        """Each cut's groups as ``a1,a2|b1;a3|b2``: ids in order of group and side, each with the sign that follows it."""
        sides = [np.searchsorted(common, e) * 2 + k for k, e in enumerate(ends)]
        place = np.concatenate(sides)
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate(flat)[order]
        start, length, signs = self.digits
        length = length[ids]
        out = signs[_spread(start[ids], length)]
        last = np.cumsum(length) - 1
        ending = np.append(np.diff(place) > 0, True)
        out[last[ending & (place % 2 == 0)]] = ord("|")
        out[last[ending & (place % 2 == 1)]] = ord(";")
        # A group ends with its last B token.
        stops = last[ending & (place % 2 == 1)][stop_groups - 1].tolist()
        whole = out.tobytes()
        return [whole[x:y] for x, y in zip([0, *[s + 1 for s in stops[:-1]]], stops, strict=True)]


#: An id pair as one number; piece ids stay below 2**16.
_ID_BITS = 16


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a.astype(np.uint32) << _ID_BITS) | b.astype(np.uint32)).astype(np.uint32)


def _aligner(files) -> Aligner:
    key, a, b = files.value
    return worker_state(__name__, key, lambda: Aligner(a, b))


# ---- documents ----


def split_text(text: str | None) -> list[str]:
    """Cuts of a text, without the space before each."""
    if not text:
        return []
    if text.isascii() and not (text[0] == " " or text[-1] == " " or any(odd in text for odd in _ODD)):
        return text.split(" ")
    return _CUT.split(text)


def _aligned(aligner: Aligner, texts: list[str | None]) -> tuple:
    """Of all texts: counts (a row each), digests, and pair keys with their links, by text in one array each."""
    if aligner.known.full():
        aligner.known = Cuts()
    split = [split_text(t) for t in texts]
    known = aligner.known
    aligner.learn(list(itertools.chain.from_iterable(split)))
    sizes = np.array([len(own) for own in split], np.int64)
    row = np.fromiter(map(known.rows.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    # A text with a cut that is not spelled has no tokens.
    bad = np.bincount(doc, ~known.spelled[row], len(texts)) > 0
    if bad.any():
        keep = ~bad[doc]
        row, doc = row[keep], doc[keep]
        sizes = np.where(bad, 0, sizes)
    counts = np.zeros((len(texts), len(_COUNTS)), np.int64)
    for k in range(len(_COUNTS)):
        counts[:, k] = np.bincount(doc, known.counts[row, k], len(texts)).astype(np.int64)
    stops = np.cumsum(sizes).tolist()
    digests, rows, first = [], row.tolist(), 0
    for stop in stops:
        said = hashlib.sha256()
        for k in range(first, stop, 65536):
            said.update((b";" if k > first else b"") + b";".join([known.groups[r] for r in rows[k : min(stop, k + 65536)]]))
        digests.append(said.hexdigest() if stop > first else "")
        first = stop
    links = np.diff(known.ptr)[row]
    key = np.repeat(doc.astype(np.uint64) << np.uint64(32), links) | known.pairs[_spread(known.ptr[row], links)]
    key.sort()
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    held = np.bincount((key[new] >> np.uint64(32)).astype(np.int64), minlength=len(texts))
    return counts, digests, held, key[new].astype(np.uint32), np.diff(np.append(new, len(key))).astype(np.uint32)


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit integers by byte planes, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * count, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(4, count).T.copy().view("<u4").reshape(-1)


def _block_schema(id_field: T.StructField) -> T.StructType:
    array = lambda kind: T.ArrayType(kind)
    return T.StructType([
        T.StructField("block", T.StringType()),
        T.StructField("ids", array(id_field.dataType)),
        *[T.StructField(c, array(T.LongType())) for c in _COUNTS],
        T.StructField("digests", array(T.StringType())),
        T.StructField("held", array(T.LongType())),
        T.StructField("places", T.BinaryType()),
        T.StructField("links", T.BinaryType()),
        T.StructField("keys", array(T.LongType())),
        T.StructField("docs", array(T.IntegerType())),
    ])


def _blocks(files, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in blocks of about ``BLOCK_BYTES``: their counts, their pairs by place in the block's list of pairs."""
    aligner = _aligner(files)
    ids, made, size = [], [], 0

    def block() -> pa.RecordBatch:
        counts, held, every, links = (np.concatenate([m[k] for m in made]) for k in (0, 2, 3, 4))
        keys, places, docs = np.unique(every, return_inverse=True, return_counts=True)
        # Within a document places rise: differences are small.
        steps = np.diff(places, prepend=0)
        starts = (np.cumsum(held) - held)[held > 0]
        steps[starts] = places[starts]
        one = lambda values, kind: pa.array([values], kind)
        longs, list_of = pa.list_(pa.int64()), pa.ListArray.from_arrays
        id_list = pa.chunked_array(ids).combine_chunks()
        id_list = list_of(pa.array([0, len(id_list)], pa.int32()), id_list)
        columns = [pa.array([uuid.uuid4().hex]), id_list]
        columns += [one(counts[:, k], longs) for k in range(len(_COUNTS))]
        columns += [one([d for m in made for d in m[1]], pa.list_(pa.string())), one(held, longs)]
        columns += [pa.array([_pack(steps)], pa.binary()), pa.array([_pack(links)], pa.binary())]
        columns += [one(keys.astype(np.int64), longs), one(docs.astype(np.int32), pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        for part in slices(batch, 1, SLICE_BYTES):
            ids.append(part.column(0))
            made.append(_aligned(aligner, part.column(1).to_pylist()))
            size += part.column(1).nbytes
            if size >= BLOCK_BYTES:
                yield block()
                ids, made, size = [], [], 0
    if made:
        yield block()


def _scored(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block with ``n_best`` and ``count_sum``."""
    at = {n: i for i, n in enumerate(["block", "ids", *_COUNTS, "digests", "held", "places", "links", "counted"])}
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(at[name])[row]  # noqa: E731,B023
            held = get("held").values.to_numpy()
            total = int(held.sum())
            best, counts = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
            if total:
                counted = get("counted").values
                key, count, top = (counted.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                order = np.argsort(key)
                count, top = count[order].astype(np.int64), top[order].astype(bool)
                steps, links = (_unpack(get(c).as_py(), total).astype(np.int64) for c in ("places", "links"))
                # Undo the differences document by document.
                run = np.cumsum(steps)
                starts = np.cumsum(held) - held
                before = np.where(starts > 0, run[np.maximum(starts, 1) - 1], 0)
                place = run - np.repeat(before, held)
                some = held > 0
                best[some] = np.add.reduceat(links * top[place], starts[some])
                counts[some] = np.add.reduceat(links * count[place], starts[some])
            columns = [get("ids").values, *[get(c).values for c in _COUNTS], get("digests").values]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best), pa.array(counts)], names=names)


def align(
    docs: DataFrame, *, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_shared, groups_sha256, n_best, count_sum.

    ``n_shared`` counts the links of the group product. ``path_a`` and
    ``path_b`` are read by the driver and sent to the workers once.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "alignment")
    with open(path_a, "rb") as a, open(path_b, "rb") as b:
        files = spark.sparkContext.broadcast((uuid.uuid4().hex, a.read(), b.read()))
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = _block_schema(own.schema["id"])
    blocks = scratch.store(own.mapInArrow(functools.partial(_blocks, files, schema.names), schema), "blocks")

    pairs = blocks.select("block", F.explode(F.arrays_zip("keys", "docs")).alias("p"))
    pairs = pairs.select("block", F.col("p.keys").alias("key"), F.col("p.docs").alias("docs"))
    counts = scratch.store(pairs.groupBy("key").agg(F.sum("docs").alias("n")), "counts")
    # An A id has at most as many pairs as B has ids.
    own_a = F.shiftright("key", _ID_BITS)
    tops = counts.groupBy(own_a.alias("a")).agg(F.max("n").alias("most"))
    rated = counts.withColumn("a", own_a).join(tops, "a").select("key", "n", (F.col("n") == F.col("most")).alias("top"))
    counted = pairs.select("block", "key").join(scratch.store(rated, "rated"), "key")
    counted = counted.groupBy("block").agg(F.collect_list(F.struct("key", "n", "top")).alias("counted"))
    both = blocks.drop("keys", "docs").join(counted, "block", "left")
    out = T.StructType([
        own.schema["id"], *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("groups_sha256", T.StringType()),
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
    ])
    return both.mapInArrow(functools.partial(_scored, out.names), out)
