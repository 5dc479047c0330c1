"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are rotated so that leading coordinates carry most of the variance.
Equal vectors of a label are compared once, with their number. Within a label,
vectors fall into cells of the two leading coordinates (as wide as two linked
unit vectors can lie apart) and cells into tiles of about ``tile_rows`` vectors;
tiles of equal and neighbouring cells are compared pairwise, so a cell with a
third of all vectors spreads over as many tasks as it has tile pairs.

A comparison sums leading coordinates first; the product of the suffix norms
bounds the rest (Cauchy-Schwarz), and a pair is dropped as soon as its cosine
cannot reach the threshold. Pairs that are left are decided by the cosine of
the given vectors in double precision. A tile pair returns link counts and a
spanning forest of its links - at most as many rows as it has vectors.

Vectors that are null, empty, zero or hold null or non-finite components, and
vectors without a label, link with nothing. Vectors of different lengths do not
link. Rows are vectors: a repeated row is another vector. The rotation is
fitted on about ``sample_vectors`` distinct vectors at most; any rotation gives
the same links, a good one gives them sooner.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch, in_sample, ship
from voltaic.llm.components import connected_components

#: Rows of a tile that are compared with the other tile at a time.
STRIP = 128
#: Slack of the bounds, far above rounding errors and far below any meaningful difference.
SLACK = 1e-9
MAX_DIMENSION = 4096


def _rows(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision; None if it cannot link."""
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.null_count:
        values[flat.is_null().to_numpy(zero_copy_only=False)] = np.nan
    sizes = np.array([0 if v is None else v for v in pa.compute.list_value_length(column).to_pylist()], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        own = values[a:b]
        out.append(own if b > a and np.isfinite(own).all() and own.any() else None)
    return out


def _key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content digest, length and bytes of each vector that can link; nulls for the others."""
    for batch in batches:
        keys, sizes, raws = [], [], []
        for label, vector in zip(batch.column(1).to_pylist(), _rows(batch.column(2)), strict=True):
            raw = None if vector is None or label is None else vector.tobytes()
            keys.append(raw and xxhash.xxh3_128_digest(str(label).encode() + b"|" + raw))
            sizes.append(None if raw is None else len(vector))
            raws.append(raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
             pa.array(raws, pa.binary())],
            names=["vec_id", "label", "key", "size", "raw"],
        )


def _unit(raw: list[bytes], size: int) -> np.ndarray:
    """Rows scaled to length 1 without overflow or underflow, padded with zeros to ``size``."""
    out = np.zeros((len(raw), size))
    for i, r in enumerate(raw):
        own = np.frombuffer(r)
        out[i, : len(own)] = own / np.abs(own).max()
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _moments(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((size, size))
    for batch in batches:
        unit = _unit(batch.column(0).to_pylist(), size)
        total += unit.T @ unit
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["moments"])


def fit_rotation(contents: DataFrame, size: int, sample_vectors: int) -> np.ndarray:
    """Columns are principal directions, most variance first."""
    share = sample_vectors / max(1, contents.count())
    rows = contents.select("raw")
    if share < 1:
        rows = contents.where(in_sample(share, "key")).select("raw")
    parts = rows.repartition(4).mapInArrow(functools.partial(_moments, size), "moments binary").collect()
    total = sum((np.frombuffer(p[0]).reshape(size, size) for p in parts), np.zeros((size, size)))
    return np.linalg.eigh(total)[1][:, ::-1].copy()


def _cells(rotation, width: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn = rotation.value
    for batch in batches:
        lead = _unit(batch.column(1).to_pylist(), len(turn)) @ turn[:, :2]
        cell = np.floor(lead / width).astype(np.int32)
        second = cell[:, 1] if cell.shape[1] > 1 else np.zeros(len(cell), np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cell[:, 0]), pa.array(second)], names=["node", "c0", "c1"]
        )


def links_between(a: np.ndarray, b: np.ndarray, threshold: float, same: bool, cuts: tuple[int, ...]):
    """Index pairs of rotated unit rows that may reach ``threshold``; ``same``: each pair once."""
    size = a.shape[1]
    edges = [c for c in cuts if c < size] + [size]
    rest_a, rest_b = ([np.linalg.norm(x[:, e:], axis=1) for e in edges] for x in (a, b))
    found = []
    for start in range(0, len(a), STRIP):
        strip = a[start : start + STRIP]
        dots = strip[:, : edges[0]] @ b[:, : edges[0]].T
        able = dots + rest_a[0][start : start + STRIP, None] * rest_b[0][None, :] >= threshold - SLACK
        if same:
            able &= (np.arange(start, start + len(strip))[:, None]) < np.arange(len(b))[None, :]
        i, j = np.nonzero(able)
        dots = dots[i, j]
        for k in range(1, len(edges)):
            low, high = edges[k - 1], edges[k]
            dots = dots + np.einsum("ij,ij->i", strip[i, low:high], b[j, low:high])
            able = dots + rest_a[k][i + start] * rest_b[k][j] >= threshold - SLACK
            i, j, dots = i[able], j[able], dots[able]
        found.append((i + start, j))
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, int) for k in (0, 1))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _scaled(raw: list[bytes]) -> np.ndarray:
    """Given vectors; those with extreme components scaled by a power of two, which leaves the cosine as it is."""
    out = np.stack([np.frombuffer(r) for r in raw])
    most = np.abs(out).max(axis=1)
    odd = (most > 1e100) | (most < 1e-100)
    out[odd] = np.ldexp(out[odd], -np.frexp(most[odd])[1][:, None])
    return out


def _forest(i: np.ndarray, j: np.ndarray, count: int) -> np.ndarray:
    """Smallest index linked to each index, directly or not."""
    label = np.arange(count)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (before == label).all():
            return label


def _compare(rotation, threshold: float, cuts: tuple[int, ...], batches: Iterator[pa.RecordBatch]):
    turn = rotation.value
    for batch in batches:
        for row in range(batch.num_rows):
            tile_a, tile_b, nodes_a, raw_a, n_a, nodes_b, raw_b, n_b = (c[row].as_py() for c in batch.columns)
            same = tile_a == tile_b
            given_a, given_b = _scaled(raw_a), _scaled(raw_b)
            i, j = links_between(
                _unit(raw_a, len(turn)) @ turn, _unit(raw_b, len(turn)) @ turn, threshold, same, cuts
            )
            linked = [
                cosine(given_a[i[k : k + 65536]], given_b[j[k : k + 65536]]) >= threshold
                for k in range(0, len(i), 65536)
            ]
            linked = np.concatenate(linked) if linked else np.zeros(0, bool)
            i, j = i[linked], j[linked]
            nodes = np.array(nodes_a if same else nodes_a + nodes_b, np.int64)
            j = j if same else j + len(nodes_a)
            many = np.array(n_a if same else n_a + n_b, np.int64)
            links = np.bincount(i, many[j], len(nodes)) + np.bincount(j, many[i], len(nodes))
            used = np.flatnonzero(links)
            label = _forest(i, j, len(nodes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[used]), pa.array(nodes[label[used]]), pa.array(links[used].astype(np.int64))],
                names=["a", "b", "links"],
            )


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    tile_rows: int = 1024,
    sample_vectors: int = 20_000,
    cuts: tuple[int, ...] = (8, 16, 32),
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``; further columns are ignored."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "embedding-dup")
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    label_type = rows.schema["label"].dataType.simpleString()
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, label {label_type}, key binary, size int, raw binary"
    keyed = scratch.store(rows.mapInArrow(_key, schema), "keyed")
    contents = keyed.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"),
        F.first("size").alias("size"), F.first("raw").alias("raw"),
    )
    contents = scratch.store(contents.withColumn("node", F.monotonically_increasing_id()), "contents")

    size = contents.agg(F.max("size")).first()[0] or 1
    if size > MAX_DIMENSION:
        raise ValueError(f"vectors of more than {MAX_DIMENSION} components")
    rotation = spark.sparkContext.broadcast(fit_rotation(contents, size, sample_vectors))
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    cells = contents.select("node", "raw").mapInArrow(
        functools.partial(_cells, rotation, width), "node long, c0 int, c1 int"
    )
    placed = scratch.store(cells.join(contents.select("node", "label", "size"), "node"), "cells")
    where = ["label", "size", "c0", "c1"]
    chunks = placed.groupBy(where).agg(F.ceil(F.count("*") / tile_rows).alias("chunks"))
    chunked = placed.join(scratch.store(chunks, "chunks"), where)
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks")).select("node", *where, "chunk")
    held = chunked.join(contents.select("node", "raw", "n"), "node")
    tiles = held.groupBy(*where, "chunk").agg(
        F.collect_list("node").alias("nodes"), F.collect_list("raw").alias("raws"), F.collect_list("n").alias("ns")
    )
    tiles = scratch.store(tiles.withColumn("tile", F.monotonically_increasing_id()), "tiles")

    place = tiles.select("tile", *where)
    steps = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))]))
    near = place.withColumn("step", steps).select(
        F.col("tile").alias("a"), "label", "size", (F.col("c0") + F.col("step.x")).alias("c0"),
        (F.col("c1") + F.col("step.y")).alias("c1"), ((F.col("step.x") == 0) & (F.col("step.y") == 0)).alias("same_cell"),
    )
    pairs = near.join(place.withColumnRenamed("tile", "b"), where)
    pairs = scratch.store(pairs.where("not same_cell or a <= b").select("a", "b"), "tile-pairs")
    sides = [tiles.select(F.col("tile").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "raws", "ns")]) for s in "ab"]
    both = pairs.repartition("a", "b").join(sides[0], "a").join(sides[1], "b")
    both = both.select("a", "b", "nodes_a", "raws_a", "ns_a", "nodes_b", "raws_b", "ns_b")
    compared = both.mapInArrow(
        functools.partial(_compare, rotation, threshold, tuple(cuts)), "a long, b long, links long"
    )
    compared = scratch.store(compared, "links")
    scratch.drop(tiles)
    parts = connected_components(compared.select("a", "b"), scratch).withColumnRenamed("id", "node")
    linked = compared.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classed = contents.select("key", "node", "id", "n").join(parts, "node", "left").join(linked, "node", "left")
    classed = classed.select(
        "key", "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("part"),
    )
    classed = scratch.store(classed, "classed")
    smallest = scratch.store(classed.groupBy("part").agg(F.min("id").alias("component_id")), "smallest")
    classed = scratch.store(classed.join(smallest, "part").select("key", "n_links", "component_id"), "classes")
    out = keyed.select("vec_id", "key").join(classed, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
