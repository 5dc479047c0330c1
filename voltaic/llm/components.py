"""Connected components of a link table, as joins and partial aggregates only."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import Scratch


def spanning_links(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links ``(node, smallest node reachable)`` that join the same nodes as ``a, b``: fewer than there are nodes."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (before == label).all():
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1)


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, component)`` of every node that is not the smallest of its component.

    ``links`` holds two BIGINT columns ``a, b`` (either order, repeats and
    self-links allowed, no nulls). Each round hooks every node to its smallest
    neighbour, flattens the resulting trees by pointer jumping and contracts the
    links; a component loses all but its local minima per round, so rounds grow
    with the logarithm of the links. Tables are written to the shared folder
    after each step, hubs are met by partial aggregation, and the flat stored
    tables let AQE split a join whose key is a hub. A node missing from the
    result is its own component.
    """
    edges = scratch.store(_ordered(links), "links")
    labels = None
    while not edges.isEmpty():
        parents = scratch.store(edges.groupBy("hi").agg(F.min("lo").alias("up")).withColumnRenamed("hi", "id"), "hooks")
        parents = _flatten(parents, scratch)
        if labels is None:
            labels = parents
        else:
            moved = labels.alias("l").join(parents.alias("p"), F.col("l.up") == F.col("p.id"), "left")
            moved = moved.select("l.id", F.coalesce("p.up", "l.up").alias("up"))
            new = scratch.store(moved.unionByName(parents), "labels")
            scratch.drop(labels)
            labels = new
        near = edges.alias("e").join(parents.alias("p"), F.col("e.hi") == F.col("p.id"))
        near = near.select(F.col("p.up").alias("a"), F.col("e.lo").alias("lo"))
        far = near.alias("n").join(parents.alias("q"), F.col("n.lo") == F.col("q.id"), "left")
        contracted = scratch.store(_ordered(far.select("n.a", F.coalesce("q.up", "n.lo").alias("b"))), "contracted")
        scratch.drop(edges)
        edges = contracted
    if labels is None:
        return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return labels.select("id", F.col("up").alias("component"))


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )


def _flatten(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """Point every node at the root of its tree (parents are smaller, so there is no cycle)."""
    while True:
        jumped = parents.alias("x").join(parents.alias("y"), F.col("x.up") == F.col("y.id"), "left")
        jumped = jumped.select(
            "x.id", F.coalesce("y.up", "x.up").alias("up"), F.col("y.up").isNotNull().alias("moved")
        )
        after = scratch.store(jumped, "jump")
        scratch.drop(parents)
        parents = after
        if parents.where("moved").isEmpty():
            return parents.drop("moved")
