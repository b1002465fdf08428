"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import by_batches, cut, lookup

#: Links that one task joins up in memory.
BLOCK = 400_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links' components: each node with the least node of its component, itself included."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    root = list(range(len(nodes)))
    for a, b in zip(at[: len(u)].tolist(), at[len(u) :].tolist(), strict=True):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if a < b:
            root[b] = a
        else:
            root[a] = b
    for i in range(len(root)):  # a root is never greater than its node
        root[i] = root[root[i]]
    return nodes, nodes[np.array(root, np.int64)] if len(nodes) else nodes


def _contracted(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[tuple[np.ndarray, np.ndarray]] = []

        def joined() -> pa.RecordBatch:
            nodes, roots = stars(np.concatenate([u for u, _ in have]), np.concatenate([v for _, v in have]))
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["u", "v"])

        for batch in batches:
            have.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(u) for u, _ in have) >= block:
                yield joined()
                have = []
        if have:
            yield joined()

    return run


def _least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with the least v of each u as m; a vertex with very many links is looked up by broadcast."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("__n"))
    return lookup(edges, least, "u", "__n").drop("__n")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 64, block: int = BLOCK) -> DataFrame:
    """(node, root) for each node of a link; root is the least node that can be reached.

    Each round joins up blocks of links in tasks of bounded size. One block is the whole graph, and
    done; more are brought together by a large-star and a small-star step, cut in the shared folder.
    Self-links and repeated links do no harm; no links give no rows.
    """
    now = cut(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    before = None
    for _ in range(rounds):
        blocks = -(-now.count() // block)
        local = by_batches(now.coalesce(max(1, blocks)), _contracted(2 * block), "u bigint, v bigint")
        if blocks <= 1:
            return local.select(F.col("u").alias("node"), F.col("v").alias("root"))
        local = local.filter("u != v")
        both = local.unionByName(local.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(cut(both)).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _least(cut(large))
        now = cut(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        # A fixed point is told by an order-free digest of the links.
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = mark
    raise RuntimeError(f"components didn't settle in {rounds} rounds")
