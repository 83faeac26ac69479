"""Connected components of an edge table, by alternating large and small stars; no node's neighbours ever meet in one task.

As soon as no more than ``SMALL`` links are left, one task joins them: its memory is bounded by that number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

SMALL = 100_000


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """node, component (its smallest reachable node) of every node in edges (u, v), written. Rounds grow with the logarithm of a component.

    Each round only takes minima per node (partial sums first) and joins them back, so a node that a third of all edges share
    is split like any skewed join. Loops and repeated edges do no harm; nulls are dropped. A round's links are deleted once the
    next round's are there.
    """
    known = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull())
    first = shared.materialise(known.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    table, state = first, _state(first)
    while state[0] > small:
        links = table.where(F.col("u") != F.col("v"))
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        star = large.join(_least(large), "u")
        star = star.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(star.select("u", F.col("m").alias("v")))
        after = shared.materialise(star.where(F.col("u") != F.col("v")).distinct(), "links")
        if table is not first:
            shared.discard(table)
        table, before, state = after, state, _state(after)
        if state == before:
            break
    roots = _joined(table) if state[0] <= small else table.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    nodes = first.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("component"))
    return shared.materialise(found, "components", instead_of=(table, first))


def _joined(links: DataFrame) -> DataFrame:
    """node, root of a bounded number of links, in one task."""
    kind = links.schema["u"].dataType.simpleString()

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def top(k):
            while (p := parent.setdefault(k, k)) != k:
                parent[k] = k = parent.setdefault(p, p)
            return k

        t = None
        for batch in batches:
            t = batch.column("u").type
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                a, b = top(u), top(v)
                parent[max(a, b)] = min(a, b)
        if parent:
            nodes = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, t), pa.array([top(k) for k in nodes], t)], ["node", "root"])

    return links.coalesce(1).mapInArrow(done, f"node {kind}, root {kind}")


def _state(links: DataFrame) -> tuple:
    """Count and two sums that tell one edge set from another."""
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(r)
