"""Connected components of a link table, as iterated joins (no graph on the driver)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.session import materialize, materialize_with, remove


#: So many links are united by one task (some 100 MB); beyond, all tasks share the work.
FEW = 500_000


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least node reachable from each node of links (a, b)."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = parent.setdefault(x, x)
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for at in range(0, len(nodes), 1 << 16):
        part = nodes[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], ["node", "component"])


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Smallest node reachable from each node of ``edges`` (two long columns ``a``, ``b``).

    Returns ``node, component`` for the nodes that occur in an edge; isolated
    nodes are the caller's. Rows with a null end and self links are ignored.
    Alternates large-star and small-star rewrites (Kiveris et al., 2014): each
    keeps the connectivity and moves links to smaller nodes, a logarithmic
    number of rounds in practice. A hub's neighbours are grouped only through
    ``min`` (combined before the shuffle) and joined back to that one value.
    FEW links or fewer, as counted, are united by one task in bounded memory.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    e = e.where("a is not null and b is not null and a <> b")
    # Count and checksum tell whether a round has changed anything, without a job of their own.
    state = F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    e, before = materialize_with(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc", *state)
    if before["n"] <= FEW:
        out = materialize(e.coalesce(1).mapInArrow(_unite, "node long, component long"), "cc")
        remove(e.sparkSession, e)
        return out
    for _ in range(max_rounds):
        # Large star: every neighbour above a node goes to the node's smallest neighbour.
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "cc")
        # Small star: every node and its smaller neighbours go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        small, after = materialize_with(small, "cc", *state)
        remove(e.sparkSession, e, large)
        e = small
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())
