"""Connected components of a graph given as edges: forests of bounded pieces first, then alternating small and large stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import checkpointed

#: Edges that one task joins to a forest: some 50 MB in a worker.
PIECE = 250_000


def forests(edges: DataFrame, n_edges: int, piece: int = PIECE) -> DataFrame:
    """Edges of the same components, fewer and shorter: a task takes its edges about ``piece`` at a time and keeps, for
    every node that a piece touches, one edge to the least node that the piece connects it with. A task with more edges
    starts anew after each piece, so that its memory does not grow with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, top)
            return top

        def forest() -> Iterator[pa.RecordBatch]:
            nodes = list(parent)
            for at in range(0, len(nodes), 100_000):
                part = nodes[at : at + 100_000]
                yield pa.record_batch([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["a", "b"])
            parent.clear()

        taken = 0
        for batch in batches:
            for at in range(0, batch.num_rows, piece):
                some = batch.slice(at, piece)
                if taken and taken + some.num_rows > piece:
                    yield from forest()
                    taken = 0
                taken += some.num_rows
                for a, b in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    x, y = root(a), root(b)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
        yield from forest()

    return edges.coalesce(max(1, -(-n_edges // piece))).mapInArrow(run, "a long, b long")


def _least(edges: DataFrame) -> DataFrame:
    """The least node around each node a; an exchange of its own lets a join split a node with many edges."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    return least.select("node", F.least("node", "least").alias("least")).repartition("node")


def _both(a: str, b: str, c: str, d: str) -> Column:
    """Two edges for each row: (a, b) and (c, d)."""
    return F.inline(F.array(F.struct(F.col(a).alias("a"), F.col(b).alias("b")), F.struct(F.col(c).alias("a"), F.col(d).alias("b"))))


def star_round(edges: DataFrame) -> DataFrame:
    """A small and a large star: nodes and their smaller neighbours are linked to the least of them, then larger
    neighbours to the least node around. Edges lead from larger to smaller nodes before and after."""
    small = edges.join(_least(edges), F.col("a") == F.col("node")).select(_both("a", "least", "b", "least")).filter("a > b")
    both = small.select(_both("a", "b", "b", "a"))
    large = both.join(_least(both), F.col("a") == F.col("node")).filter("b > a")
    return large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def components(edges: DataFrame, piece: int = PIECE) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named after its least node. Ends when
    every edge leads to the least node of its component, which takes a logarithmic number of rounds."""
    edges = checkpointed(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = checkpointed(forests(edges, edges.count(), piece))
    while True:
        nodes = edges.select(_both("a", "b", "b", "b")).groupBy(F.col("a").alias("node"))
        nodes = nodes.agg(F.min("b").alias("component"), F.max("b").alias("other"))
        # Settled when no node has two ends: neither two roots, nor a root while it is one itself.
        if nodes.agg(F.count_if(F.col("component") < F.col("other"))).first()[0] == 0:
            return nodes.select("node", "component")
        edges = checkpointed(star_round(edges))
