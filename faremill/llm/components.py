"""Connected components of a graph of links, as rounds of joins while there are many."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.storage import written


ROOM = 1 << 16  # links that one task takes, a megabyte of numbers


def components(links: DataFrame, room: int = ROOM) -> DataFrame:
    """(id, component): the smallest id that each linked vertex can reach.

    links: rows (a, b) of whole numbers; null ends and loops are ignored, repeated links do
    no harm. Up to `room` links are followed to their ends in one task. More of them
    alternate large-star and small-star steps, which keep the number of links from growing
    and end after about log(vertices) rounds, or when no more than `room` are left; each
    round's links are written to the shared folder. A vertex with many links is grouped by
    a minimum, which combines before the shuffle, and joined back, where adaptive execution
    splits it.
    """
    edges = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    n, before = edges.count(), None
    if n > room:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while n > room:
        edges = written(small_star(large_star(edges)).distinct(), "links")
        # a forest of stars stays as it is
        now = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes"),
        ).first()
        if now == before:
            roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
        n, before = now["n"], now
    return written(edges.repartition(1).mapInArrow(reached, "id long, component long"), "links")


def reached(batches):
    """(id, component) of the vertices of a task's links."""
    sides = [(np.asarray(x.column(0)), np.asarray(x.column(1))) for x in batches if x.num_rows]
    if not sides:
        return
    a, b = (np.concatenate(x) for x in zip(*sides, strict=True))
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    least = np.arange(len(ids))
    while (least[a] != least[b]).any():
        low = np.minimum(least[a], least[b])
        for side in (a, b):
            np.minimum.at(least, least[side], low)
        while (least[least] != least).any():
            least = least[least]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[least])], names=["id", "component"])


def large_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its smaller neighbours and itself to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = edges.join(least, "a")
    return (
        met.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter("a <> b")
    )
