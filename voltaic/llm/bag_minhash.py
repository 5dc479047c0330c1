"""Near-duplicates by weighted MinHash (BagMinHash), banding and exact multiset overlap.

A text is the multiset of its five-word shingles (a text of fewer words is one
shingle; a text without words has none and stands alone). Two texts are linked
when their weighted Jaccard similarity - the sum of the smaller shingle counts
over the sum of the larger - is at least ``threshold``.

Signatures: every shingle owns Poisson processes over its weight axis, cut into
the unit steps that integer counts need and grouped into blocks (0,1], (1,2],
(2,4], (4,8], ... A block is one process of the block's total rate whose points
carry a unit step; a text sees the points at steps up to its count. Points are
drawn in time order, each falls on one of ``bands * rows`` slots, and a slot
keeps its first time. Two texts agree in a slot with the probability of their
weighted Jaccard similarity, without bias. Drawing stops when no further point
can come before the latest first time.

1. Texts with equal words form one content class (a digest, partial counts).
2. Classes are banded; each member of a bucket is verified against the
   bucket's centre: as many pairs as members.
3. Linked classes are joined into components. A member that missed its centre
   may still be linked to other members. One minus weighted Jaccard is a
   metric, so only members whose similarities to the centre differ by at most
   ``1 - threshold`` qualify. They are compared tile by tile, all texts of one
   with all of the other in matrix products, where their components differ; a
   tile pair returns links between components. No bucket, candidate or partner
   count is capped.

A link is found with probability ``1 - (1 - s**rows)**bands``: 0.99997 at 0.8
for 20 bands of 4, and above for closer pairs; exact copies always.

Null ids, repeated ids and repeated rows are allowed: classes are made of
contents, every input row is returned once, ``class_id`` is the smallest
non-null id of the class.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import BINARY, LONG, LONGS, Scratch, map_text, words
from voltaic.llm.components import connected_components, spanning_links

SHINGLE = 5
#: Texts and features in a tile, features that are multiplied at a time.
TILE_ROWS, TILE_FEATURES, COLUMNS = 512, 250_000, 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit counter generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(own: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles of a word list, in text order."""
    if not own:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    width = min(size, len(own))
    out = np.full(len(own) - width + 1, width, np.uint64)
    for k in range(width):
        out = (out ^ hashed[k : k + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return _mix(out)


def signatures(texts: list[np.ndarray], slots: int) -> np.ndarray:
    """First point time of each slot for each multiset of shingle hashes (infinite without shingles)."""
    first = np.full((len(texts), slots), np.inf)
    unique = [np.unique(t, return_counts=True) for t in texts]
    sizes = [len(u[0]) for u in unique]
    if not sum(sizes):
        return first
    element = np.concatenate([u[0] for u in unique])
    weight = np.concatenate([u[1] for u in unique]).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    # Blocks of unit steps: 0 is (0,1], b is (2**(b-1), 2**b].
    blocks = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    block = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    element, weight, doc = (np.repeat(x, blocks) for x in (element, weight, doc))
    low = np.where(block > 0, np.int64(1) << np.maximum(block - 1, 0), 0)
    steps = np.where(block > 0, low, 1)
    state = _mix(element + _MIX * (block.astype(np.uint64) + np.uint64(1)))
    time = np.zeros(len(element))
    bound = np.full(len(texts), np.inf)
    while len(element):
        state = state + _MIX
        draw = _mix(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / steps
        near = time < bound[doc]
        element, weight, doc, low, steps, state, time, draw = (
            x[near] for x in (element, weight, doc, low, steps, state, time, draw)
        )
        other = _mix(draw ^ np.uint64(0xD1B54A32D192ED03))
        slot = ((other >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)
        step = low + 1 + ((other & np.uint64(0xFFFFFFFF)) % steps.astype(np.uint64)).astype(np.int64)
        seen = step <= weight
        np.minimum.at(first.reshape(-1), (doc * slots + slot)[seen], time[seen])
        bound = first.max(axis=1)
    return first


def band_hashes(first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of each signature; equal only for equal band number and slots."""
    bits = first.view(np.uint64).reshape(len(first), bands, rows)
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(first), 1))
    for k in range(rows):
        out = _mix((out ^ bits[:, :, k]) * _MIX + np.uint64(k + 1))
    return out.view(np.int64)


def _sketch_setup(size: int, bands: int, rows: int):
    def fn(texts: list) -> list:
        split = [words(t) for t in texts]
        keys = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in split]
        hashes = band_hashes(signatures([shingles(w, size) for w in split], bands * rows), bands, rows)
        return [keys, [h.tolist() if w else None for h, w in zip(hashes, split, strict=True)]]

    return fn


def features(own: np.ndarray) -> np.ndarray:
    """Multiset of shingle hashes as a sorted set: the k-th copy of a shingle is an element of its own."""
    element, count = np.unique(own, return_counts=True)
    copy = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    repeated = np.repeat(element, count)
    return np.sort(np.where(copy > 0, _mix(repeated + copy.astype(np.uint64) * _MIX), repeated))


def _feature_setup(size: int):
    def fn(texts: list) -> list:
        made = [features(shingles(words(t), size)) for t in texts]
        return [[m.tobytes() for m in made], [len(m) for m in made]]

    return fn


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted Jaccard similarity of each pair ``(a, b, a_features, b_features)``."""
    for batch in batches:
        out = np.zeros(batch.num_rows)
        sides = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        for row, (left, right) in enumerate(sides):
            both = np.sort(np.concatenate([np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)]))
            common = int((both[1:] == both[:-1]).sum())
            out[row] = common / (len(both) - common)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["a", "b", "sim"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Similarity of every left text with every right text, by matrix products over their common features."""
    flat = [np.concatenate(side) for side in (left, right)]
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    both = np.zeros((len(left), len(right)), np.float32)
    at = [np.searchsorted(common, f) for f in flat]
    for k in (0, 1):
        known = (at[k] < len(common)) & (common[np.minimum(at[k], len(common) - 1)] == flat[k] if len(common) else False)
        at[k] = np.where(known, at[k], -1)
    row = [np.repeat(np.arange(len(s)), s) for s in sizes]
    for start in range(0, len(common), COLUMNS):
        parts = []
        for k, side in enumerate((left, right)):
            here = (at[k] >= start) & (at[k] < start + COLUMNS)
            part = np.zeros((len(side), min(COLUMNS, len(common) - start)), np.float32)
            part[row[k][here], at[k][here] - start] = 1
            parts.append(part)
        both += parts[0] @ parts[1].T
    exact = both.astype(np.float64)
    return exact / (sizes[0][:, None] + sizes[1][None, :] - exact)


def _compare_tiles(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the texts of two tiles that are in different parts."""
    for batch in batches:
        for row in range(batch.num_rows):
            nodes_a, parts_a, raw_a, nodes_b, parts_b, raw_b = (c[row].as_py() for c in batch.columns)
            apart = np.array(parts_a)[:, None] != np.array(parts_b)[None, :]
            if not apart.any():
                continue
            left, right = ([np.frombuffer(r, np.uint64) for r in raw] for raw in (raw_a, raw_b))
            i, j = np.nonzero(apart & (overlaps(left, right) >= threshold))
            # A spanning forest of the linked parts says as much as all their links.
            ends = spanning_links(np.array(parts_a)[i], np.array(parts_b)[j])
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    size: int = SHINGLE,
    bands: int = 20,
    rows: int = 4,
) -> DataFrame:
    """``(id, key, class_id, kept)`` per input row: its content digest, its class and whether it stays.

    ``key`` is null for texts without words, which are classes of their own.
    One content of each class stays (that of ``class_id``); of several rows with
    that id and content each is marked, see ``keep_one``. Columns of ``docs``
    other than id and text are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dup")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = functools.partial(_sketch_setup, size, bands, rows)
    sketched = scratch.store(
        map_text(own, "text", {"key": BINARY, "bands": LONGS}, sketch, keep_text=False), "sketches"
    )
    # Content classes, numbered once they are stored.
    contents = sketched.where("key is not null").groupBy("key").agg(F.min("id").alias("id"))
    nodes = scratch.store(contents.withColumn("node", F.monotonically_increasing_id()), "contents")
    firsts = sketched.where("key is not null").select("key", "bands").dropDuplicates(["key"])
    banded = scratch.store(
        firsts.join(nodes.select("key", "node"), "key").select("node", F.explode("bands").alias("bucket")), "bands"
    )
    # The centre of a bucket is the member whose buckets hold most rows: in a group of copies, the one they derive from.
    sizes = scratch.store(banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = scratch.store(banded.join(sizes, "bucket"), "shared")
    weights = scratch.store(shared.groupBy("node").agg(F.sum("n").alias("weight")), "weights")
    centres = shared.join(weights, "node").groupBy("bucket").agg(
        F.max_by("node", F.struct("weight", -F.col("node"))).alias("centre")
    )
    centres = scratch.store(centres, "centres")
    members = shared.select("bucket", "node").join(centres, "bucket").where("node != centre")
    members = scratch.store(members, "members")
    scratch.drop(banded, centres, sizes, shared)

    stars = members.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    stars = scratch.store(stars, "star-pairs")
    wanted = stars.select(F.col("a").alias("node")).union(stars.select(F.col("b").alias("node"))).distinct()
    wanted = scratch.store(wanted.join(nodes, "node").select("node", "key", "id"), "wanted")
    texts = _texts_of(own, sketched, wanted)
    shingled = map_text(texts, "text", {"features": BINARY, "n": LONG}, functools.partial(_feature_setup, size), False)
    shingled = scratch.store(shingled, "features")

    raw = shingled.select("node", "features")
    joined = stars.join(raw.toDF("b", "right"), "b").join(raw.toDF("a", "left"), "a").select("a", "b", "left", "right")
    sims = scratch.store(joined.mapInArrow(_overlap, "a long, b long, sim double"), "star-sims")
    links = sims.where(F.col("sim") >= threshold).select("a", "b")
    parts = scratch.store(connected_components(links, scratch), "parts")

    placed = members.join(sims.withColumnsRenamed({"a": "centre", "b": "node"}), ["centre", "node"])
    placed = placed.join(parts.withColumnRenamed("id", "node"), "node", "left")
    placed = placed.select("bucket", "node", "sim", F.coalesce("component", "node").alias("part"))
    more = _links_of_missed(scratch.store(placed, "placed"), shingled, threshold, scratch)
    scratch.drop(shingled, members, stars)
    if not more.isEmpty():
        # ``more`` links parts; together with each node's part it links nodes.
        of_parts = scratch.store(connected_components(more, scratch), "parts-of-parts")
        moved = parts.alias("p").join(of_parts.alias("q"), F.col("p.component") == F.col("q.id"), "left")
        moved = moved.select("p.id", F.coalesce("q.component", "p.component").alias("component"))
        alone = of_parts.join(parts.select("id"), "id", "left_anti")
        parts = scratch.store(moved.unionByName(alone), "all-parts")

    classed = nodes.join(parts.withColumnRenamed("id", "node"), "node", "left")
    classed = classed.select("key", "id", F.coalesce("component", "node").alias("part"))
    smallest = classed.groupBy("part").agg(
        F.min("id").alias("class_id"), F.min_by("key", F.struct(F.col("id").isNull(), "id", "key")).alias("kept_key")
    )
    smallest = scratch.store(smallest, "classes")
    classed = scratch.store(classed.join(smallest, "part"), "classed")
    result = sketched.select("id", "key").join(classed.select("key", "class_id", "kept_key"), "key", "left")
    kept = (F.col("key") == F.col("kept_key")) & F.col("id").eqNullSafe(F.col("class_id"))
    return result.select(
        "id",
        "key",
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("key").isNull(), F.lit(True)).otherwise(kept).alias("kept"),
    )


def _links_of_missed(placed: DataFrame, shingled: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Links ``(a, b)`` between parts, from members that missed their bucket's centre.

    A bucket's members are ranked in steps of ``1 - threshold`` by similarity to
    the centre; only equal and neighbouring steps can hold a link. Members of a
    step are dealt into tiles of bounded size; rows are pairs of tiles.
    """
    open_ = placed.groupBy("bucket").agg(F.min("sim").alias("least"), F.count_distinct("part").alias("parts"))
    open_ = scratch.store(open_.where((F.col("least") < threshold) & (F.col("parts") > 1)).select("bucket"), "open")
    rows = placed.join(open_, "bucket").join(shingled, "node")
    rows = rows.withColumn("missed", F.col("sim") < threshold)
    rows = rows.withColumn("step", F.floor(F.col("sim") / F.lit(1 - threshold + 1e-9)))
    where = ["bucket", "step", "missed"]
    tiles = rows.groupBy(where).agg(
        F.ceil(F.greatest(F.count("*") / TILE_ROWS, F.sum("n") / TILE_FEATURES)).alias("tiles")
    )
    dealt = rows.join(scratch.store(tiles, "tile-counts"), where)
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    filled = dealt.groupBy(*where, "tile").agg(
        F.collect_list("node").alias("nodes"), F.collect_list("part").alias("own"), F.collect_list("features").alias("raw")
    )
    filled = scratch.store(filled.withColumn("number", F.monotonically_increasing_id()), "tiles")
    key = filled.select("number", "bucket", "step", "missed")
    near = key.withColumn("step", F.explode(F.array(F.col("step"), F.col("step") + 1)))
    pairs = near.alias("x").join(
        key.alias("y"),
        (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.step") == F.col("y.step")),
    )
    pairs = pairs.where("x.missed or y.missed").select(
        F.least("x.number", "y.number").alias("a"), F.greatest("x.number", "y.number").alias("b")
    )
    pairs = scratch.store(pairs.distinct(), "tile-pairs")
    sides = [
        filled.select(F.col("number").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "own", "raw")])
        for s in "ab"
    ]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    both = both.select("nodes_a", "own_a", "raw_a", "nodes_b", "own_b", "raw_b")
    found = scratch.store(both.mapInArrow(functools.partial(_compare_tiles, threshold), "a long, b long").distinct(), "more")
    scratch.drop(filled)
    return found


def _texts_of(own: DataFrame, sketched: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each wanted content: that of its smallest id; a content without any id is found by its key alone."""
    named = own.join(wanted.where("id is not null").select("id").distinct(), "id", "left_semi")
    with_key = map_text(named, "text", {"key": BINARY}, _key_setup)
    out = with_key.dropDuplicates(["id", "key"]).join(wanted, ["id", "key"]).select("node", "text")
    nameless = wanted.where("id is null").select("key", "node")
    with_key = map_text(own.where("id is null").select("text"), "text", {"key": BINARY}, _key_setup)
    return out.unionByName(with_key.dropDuplicates(["key"]).join(nameless, "key").select("node", "text"))


def _key_setup():
    def fn(texts: list) -> list:
        split = [words(t) for t in texts]
        return [[xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in split]]

    return fn


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` with one document of each class: the row with the smallest id.

    Texts without words all stay. Of several rows with that id and content, one stays.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    found = Scratch(docs.sparkSession, "keep-one").store(found, "found")
    by_id = found.where("id is not null").groupBy("id").agg(F.count("*").alias("rows"), F.max("kept").alias("kept"))
    # An id that occurs once says by itself whether its row stays: no text is looked at again.
    once = by_id.where("rows = 1 and kept").select(F.col("id").alias(id_col))
    stay = docs.join(once, id_col, "left_semi")
    often = by_id.where("rows > 1").select(F.col("id").alias(id_col))
    rest = docs.join(often, id_col, "left_semi").unionByName(docs.where(F.col(id_col).isNull()))
    # Names that no column of docs has.
    tag = max((len(c) for c in docs.columns), default=0) + 1
    key, row = "k" * tag, "r" * tag
    keepers = found.where("kept and key is not null").select(F.col("key").alias("__key"), F.col("id").alias("__id")).distinct()
    keyed = map_text(rest, text_col, {key: BINARY}, _key_setup)
    # Rows without words are told apart by a number of their own, so each stays.
    keyed = keyed.withColumn(row, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    of_class = (F.col(f"d.{key}") == F.col("k.__key")) & F.col(f"d.{id_col}").eqNullSafe(F.col("k.__id"))
    kept = keyed.alias("d").join(keepers.alias("k"), of_class, "left").where(F.col(f"d.{key}").isNull() | F.col("k.__key").isNotNull())
    kept = kept.select("d.*").dropDuplicates([id_col, key, row])
    return stay.select(docs.columns).unionByName(kept.select(docs.columns))
