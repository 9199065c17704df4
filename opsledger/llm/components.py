"""Connected components of an edge table by distributed union-find.

Every task first joins its own edges into stars. Then, round by round, each node hooks to its smallest smaller
neighbour, paths are halved until every hooked node points to the end of its path, and edges are renamed to those
ends. At least half of the remaining nodes vanish in each round. Neighbours of a node are never gathered: a round
is a minimum per node and joins, so a node with very many edges costs what its edges cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import store

FLUSH_NODES = 500_000


def _stars(edges: DataFrame) -> DataFrame:
    """(hi, lo) edges with the same components as (a, b): per task, each node to the smallest it is joined with."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        def made() -> pa.RecordBatch:
            rows = [(x, find(x)) for x in list(parent)]
            rows = [(x, r) for x, r in rows if x != r]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], ["hi", "lo"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > FLUSH_NODES:
                yield made()
        yield made()

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(join, "hi long, lo long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node of its component.

    Edges with a null end are left out; loops, repeated and turned edges do not matter; no edges give no rows.
    """
    links = store(_stars(edges.where("a IS NOT NULL AND b IS NOT NULL")), "components-links")
    found = None
    while not links.isEmpty():
        up = store(links.groupBy("hi").agg(F.min("lo").alias("to")), "components-up")
        while True:
            above = up.select(F.col("hi").alias("to"), F.col("to").alias("next"))
            jumped = up.join(above, "to", "left").select(
                "hi", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
            jumped = store(jumped, "components-jump")
            up = jumped.select("hi", "to")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = up
        else:
            higher = up.select(F.col("hi").alias("to"), F.col("to").alias("next"))
            found = store(found.join(higher, "to", "left").select("hi", F.coalesce("next", "to").alias("to"))
                          .unionByName(up), "components-found")
        ends = up.select(F.col("hi").alias("lo"), F.col("to").alias("lo_end"))
        renamed = (
            links.join(up, "hi").join(ends, "lo", "left")
            .select(F.col("to").alias("a"), F.coalesce("lo_end", "lo").alias("b")).where("a <> b").distinct()
        )
        links = store(_stars(renamed), "components-links")
    if found is None:
        found = links.select("hi", F.col("lo").alias("to"))
    return found.select(F.col("hi").alias("node"), F.col("to").alias("root")).unionByName(
        found.select(F.col("to").alias("node"), F.col("to").alias("root")).distinct())
