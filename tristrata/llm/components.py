"""Connected components: stars within tasks, then alternating stars over all edges; every round's
edges are written out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.common import salt_of, salted
from tristrata.scratch import staged

#: Tasks that the edges of one node are spread over when they meet its smallest neighbour.
SALTS = 8
#: Edges that one task makes stars of, and how many of all edges that must leave to be done again.
TASK_EDGES = 1 << 20
SHRINKS = 0.7


def nearest(edges: DataFrame) -> DataFrame:
    """``x, y, m``: every edge with the smallest neighbour of ``x``."""
    least = edges.groupBy("x").agg(F.min("y").alias("m"))
    sides = edges.withColumn("salt", salt_of(SALTS, F.col("y")))
    return sides.join(salted(least, SALTS), ["x", "salt"]).drop("salt")


def rounds(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over edges ``u > v``."""
    both = edges.selectExpr("u AS x", "v AS y").unionByName(edges.selectExpr("v AS x", "u AS y"))
    # Every larger neighbour of a node moves to the smallest node around it.
    large = (
        nearest(both)
        .where("y > x")
        .select(F.col("y").alias("x"), F.least("x", "m").alias("y"))
        .distinct()
    )
    small = nearest(large)
    down = small.where("y > m").selectExpr("y AS u", "m AS v")
    return down.unionByName(small.selectExpr("x AS u", "m AS v")).distinct()


def contracted(edges: DataFrame, parts: int) -> DataFrame:
    """``u, v``: a star for each component of each of so many parts of the edges, to its smallest
    node. A part has about ``TASK_EDGES`` edges at first and never more afterwards."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(batches)
        held = [[b.column(c).to_numpy() for b in own] for c in ("u", "v")]
        if not own:
            return
        u, v = np.concatenate(held[0]), np.concatenate(held[1])
        nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        low = smallest(len(nodes), place[: len(u)], place[len(u) :])
        moved = np.flatnonzero(low != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[moved]), pa.array(nodes[low[moved]])], names=["u", "v"]
        )

    return edges.coalesce(parts).mapInArrow(stars, "u long, v long")


def smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches: roots are hooked, paths halved."""
    low = np.arange(n)
    while True:
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            return low
        np.minimum.at(low, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            jumped = low[low]
            if (jumped == low).all():
                break
            low = jumped


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns ``a`` and ``b``): the smallest node
    that it reaches. Null ends and loops do not count.

    Each task first makes stars of the edges it has, as long as that makes them fewer; when all fit
    one task's bound, one such step is the result. Alternating stars settle what is left.
    """
    now = staged(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a IS NOT NULL AND b IS NOT NULL AND u > v")
        .distinct(),
        "edges",
    )
    many = now.count()
    while many:
        parts = many // task_edges + 1
        now = staged(contracted(now, parts), "contracted")
        if parts == 1:
            break
        before, many = many, now.count()
        if many > SHRINKS * before:
            now = settled(now)
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def settled(now: DataFrame) -> DataFrame:
    """The edges of stars to the smallest nodes, by rounds over all edges."""
    print_of = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = now.select(print_of).first()[0]
    while before[0]:
        now = staged(rounds(now), "stars")
        after = now.select(print_of).first()[0]
        if after == before:
            break
        before = after
    return now
