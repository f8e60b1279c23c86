"""Connected components of an edge table that grows with the data, without collecting any of it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import checkpointed, forget_shuffles

EDGES = 50_000  # a partition of edges holds at least so many, if there are as many


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component_id) for every id that occurs in ``edges`` (a, b); component_id is the smallest id reachable.

    Alternating large-star and small-star rounds: each vertex's larger neighbours are hung under its smallest one, then
    its smaller neighbours. Both group map-side first and join on the vertex, which AQE splits where a star is hot. The
    rounds end when the edges no longer change, in about log(n) of them; each is cut off by a checkpoint, after which the
    shuffle files of the round go. A round reads its edges in as many partitions as they fill: what a shuffle leaves on disk
    beside its rows grows with the square of the partitions.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct())
    before = _state(edges)
    for _ in range(max_rounds):
        forget_shuffles(edges.sparkSession)
        edges = edges.coalesce(before[0] // EDGES + 1)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    ids = edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return ids.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())


def forest(links: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """(id, smallest id of its component) for every linked row that isn't that smallest one itself."""
    both = links | links.T
    todo, out = both.any(axis=1), []
    for start in np.argsort(ids, kind="stable"):
        if not todo[start]:
            continue
        todo[start] = False
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(both[front].any(axis=0) & todo)
            todo[front] = False
            out += [(int(ids[i]), int(ids[start])) for i in front]
    return out
