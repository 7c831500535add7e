"""Connected components of links between many nodes, without a driver-side graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import kept, per_batch, record_batch


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("h")).first()
    return row["n"], row["h"] or 0


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links after a star step; the rows of a node stream through its task in order, so none is too large.

    ``links(a, b)``. The large step takes both directions and hands the smallest
    of a node and its neighbours to the larger ones; the small step takes smaller
    neighbours and hands the smallest to the others and to the node.
    """
    dealt = links.repartition("a").sortWithinPartitions("a", "b")

    def hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, least = None, 0  # of the last row so far
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.append(node is None or a[0] != node, a[1:] != a[:-1])
            first = np.where(new, b, 0)
            if not new[0]:
                first[0] = least
            group = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
            m = first[group]
            node, least = a[-1], m[-1]
            if large:
                m = np.minimum(a, m)
                some = b > a
                yield record_batch(["a", "b"], [b[some], m[some]])
            else:
                some = b != m
                yield record_batch(["a", "b"], [np.append(b[some], a[new]), np.append(m[some], m[new])])

    return per_batch(dealt, hand_on, "a long, b long")


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Alternates the large-star and small-star steps: every node hands its
    smallest neighbour to the larger ones, then to the smaller ones, until
    nothing changes. Each step is one shuffle. Links with a null end are ignored.
    """
    edges = kept(
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = kept(_stars(_stars(both, large=True), large=False).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
