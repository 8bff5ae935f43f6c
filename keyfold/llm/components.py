"""Connected components of links that Spark holds: union-find in tasks, stars between them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.session import materialize


#: Links that one task holds in its union-find.
TASK_LINKS = 500_000


def _contract(batches):
    """Union-find over the links of one task: each node with the smallest node it reaches here."""
    parent: dict = {}

    def find(x):
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a), parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for at in range(0, len(nodes), 100_000):
        part = nodes[at:at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(part, dtype=np.int64)),
                                          pa.array(np.array([find(x) for x in part], dtype=np.int64))], names=["a", "b"])


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Tie the neighbours of each node to its smallest one: all, or (small) only those below the node."""
    both = edges if small else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    tied = both.join(least, "a")
    out = tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        out = out.union(least.select("a", F.col("m").alias("b")))
    else:
        out = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): each linked node with the smallest node it reaches.

    ``links`` has two long columns; direction, repeats and loops do not matter, rows
    with a null are ignored. Nodes without links are not in the result. Tasks first
    contract at most ``TASK_LINKS`` links each. Where that takes several tasks, rounds
    of large and small stars join what they found, which settles in a logarithmic number
    of rounds; every round is checkpointed, and only counts come to the driver.
    """
    a, b = links.columns
    clean = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    tasks = -(-clean.count() // TASK_LINKS) or 1
    edges = clean.coalesce(tasks).mapInArrow(_contract, "a bigint, b bigint").where(F.col("a") != F.col("b"))
    before = None
    if tasks == 1:
        edges = materialize(edges)
    while tasks > 1:
        edges = materialize(_star(_star(edges, small=False), small=True))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
