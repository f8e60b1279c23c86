"""Embedding near-dedup through a pivot-permutation index.

A bounded number of vectors serve as pivots, no two of them alike: a crowd of similar vectors is drawn as often as it
has members, and among hundreds of pivots of its own each of its vectors would be near others. Each distinct vector is
described by its nearest pivots in order, and posted in the inverted lists of those; the nearest is its home. Two
vectors are candidates when their descriptions share at least ``shared`` pivots, and all of a list's pairs are compared
by their cosine in double precision.

Where the vectors share a direction, as text embeddings often do, pivots and descriptions are of what differs from the
pivots' mean, and descriptions are longer: a link then has a smaller angle in common. Cosines are always those of the
vectors themselves. Where nearly all point one way, nearly all are linked, and nothing is taken off.

A pair of one home is counted in the list of that home, any other in the first list it meets in. Lists are cut into
blocks by a hash, and every pair of a list's blocks is one group: no list is ever gathered whole, whatever its share of
the rows. A home that fills blocks of other lists has blocks of its own there, which aren't paired with each other, so
a crowd is compared with itself once and not in every list it shares. A group emits how many links each of its vectors
has and a forest of them, never the pairs, so a large group of near copies costs its comparisons but not its pairs as
rows.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components, forest
from .tables import checkpointed, narrow, read_table, ship_package
from .vp_search import usable

MIN_PIVOTS, MAX_PIVOTS = 64, 8192  # about 4 * sqrt(rows), within these: the broadcast pivots stay under 8192 vectors
PREFIX = 16  # pivots in a description
SHARED = 1  # that two descriptions must share
APART = 0.6  # no two pivots have this cosine
CENTRED = (0.25, 0.8)  # mean cosine of two pivots, from which on and up to which their mean is taken off
WIDER = 4  # times as many pivots are in a description then
BLOCK_ROWS = 2048
MAX_ZONES = 65_536  # homes with blocks of their own in other lists, at most
COSINE = 0.9


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def thinned(pivots: np.ndarray, apart: float = APART) -> np.ndarray:
    """The unit vectors, in order, that have no cosine of ``apart`` with one kept before."""
    kept = pivots[:0]
    for at in range(0, len(pivots), 256):
        part = pivots[at:at + 256]
        part = part[(part @ kept.T < apart).all(axis=1)]
        near, new = part @ part.T >= apart, []
        for i in range(len(part)):
            if not near[i, new].any():
                new.append(i)
        kept = np.concatenate([kept, part[new]])
    return kept


def directions(x: np.ndarray, mean: np.ndarray | None) -> np.ndarray:
    """Unit vectors of ``x``, or of what they have beside ``mean`` (zero where that is nothing)."""
    if mean is None:
        return _unit(x)
    rest = _unit(x) - mean
    size = np.sqrt(np.einsum("ij,ij->i", rest, rest))
    return rest / np.where(size > 0, size, 1)[:, None]


def fitted(pivots: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """(mean to take off, or None; the thinned pivots) of the vectors drawn as pivots."""
    unit, n = _unit(pivots), len(pivots)
    total = unit.sum(axis=0)
    if n < 2 or not CENTRED[0] <= (total @ total - n) / (n * (n - 1)) <= CENTRED[1]:
        return None, thinned(unit)
    return total / n, thinned(directions(pivots, total / n))


def link_blocks(x: np.ndarray, near: np.ndarray, side: np.ndarray | None, here: int, shared: int,
                cosine: float) -> np.ndarray:
    """Boolean matrix of the verified pairs of one block pair that count in this list, each pair once.

    ``near`` holds each row's description, its home first, -1 where it has no more. Where two blocks meet, ``side``
    tells them apart and only pairs across them count. ``here`` is the pivot of this list.
    """
    n = len(x)
    left, right = (np.arange(n),) * 2 if side is None else (np.flatnonzero(~side), np.flatnonzero(side))
    c = x[left] @ x[right].T
    good = c >= cosine
    i, j = np.nonzero(np.abs(c - cosine) < 1e-9)  # summed in the order of the pair alone
    good[i, j] = np.einsum("ij,ij->i", x[left[i]], x[right[j]]) >= cosine
    same = near[left, 0][:, None] == near[right, 0][None, :]
    good &= ~same | (near[left, 0] == here)[:, None]
    if side is None:
        good = np.triu(good, 1)
    links = np.zeros((n, n), bool)
    links[np.ix_(left, right)] = good
    linked = np.flatnonzero(links.any(axis=0) | links.any(axis=1))
    if not len(linked):
        return links
    row, flat = np.repeat(linked, near.shape[1]), near[linked].ravel()
    row, flat = row[flat >= 0], flat[flat >= 0]
    order = np.argsort(flat, kind="stable")
    row, flat = row[order], flat[order]
    counts, earlier = np.zeros((n, n) if shared > 1 else (0, 0), np.uint16), np.zeros((n, n), bool)
    cuts = np.flatnonzero(np.diff(flat)) + 1
    for at, end in zip(np.r_[0, cuts], np.r_[cuts, len(flat)], strict=True):
        members = np.ix_(row[at:end], row[at:end])
        if shared > 1:
            counts[members] += 1
        if flat[at] < here:
            earlier[members] = True
    links &= ~earlier | (near[:, 0][:, None] == near[:, 0][None, :])
    return links & (counts >= shared) if shared > 1 else links


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
                    prefix: int = PREFIX, shared: int = SHARED, block_rows: int = BLOCK_ROWS,
                    pivots: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of ``vectors``.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are kept, as are
    rows with a null id (component null); vectors of different lengths don't link. Equal vectors form one class, which
    is searched once and whose members all link with each other; repeated rows of one id count as one vector.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = narrow(vectors, vec_id=id_col).select(F.col("vec_id").cast("long").alias("vec_id"))
    points = checkpointed(usable(vectors, id_col, vec_col).withColumn("x", F.transform("x", lambda c: c + F.lit(0.0))))  # one zero
    classes = points.groupBy("x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
    classes = checkpointed(classes.withColumn("dim", F.size("x")))
    n = classes.count()
    wanted = pivots or min(MAX_PIVOTS, max(MIN_PIVOTS, 4 * isqrt(n)))
    picked = classes.orderBy(F.xxhash64("rep", F.lit("pivot")), "rep").limit(wanted).select("x").collect()
    tables = {}
    for r in picked:
        tables.setdefault(len(r["x"]), []).append(r["x"])
    shared_pivots = spark.sparkContext.broadcast({d: fitted(np.array(v)) for d, v in tables.items()})
    widest = prefix * (1 if all(mean is None for mean, _ in shared_pivots.value.values()) else WIDER)

    def describe(batches):
        for b in batches:
            near: list[list[int]] = [[] for _ in range(len(b))]
            for dim, at in b.groupby("dim").indices.items():
                mean, table = shared_pivots.value.get(dim, (None, None))
                if table is None:  # no pivot of this length: pivot 0 stands for all, so that such rows still meet
                    for i in at:
                        near[i] = [0]
                    continue
                k = min(prefix * (1 if mean is None else WIDER), len(table), (len(table) + shared + 1) // 2)  # so many share ``shared`` in any case
                for part in np.array_split(at, -(-len(at) // 1024)):
                    c = directions(np.stack(b["x"].iloc[part].to_numpy()), mean) @ table.T
                    top = np.argpartition(-c, k - 1, axis=1)[:, :k]
                    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(c, top, axis=1), axis=1, kind="stable"), axis=1)
                    for i, t in zip(part, top.tolist(), strict=True):
                        near[i] = t
            yield pd.DataFrame({"rep": b["rep"], "size": b["size"], "dim": b["dim"], "x": b["x"], "near": near})

    described = checkpointed(classes.select("rep", "size", "dim", "x").mapInPandas(
        describe, "rep long, size long, dim int, x array<double>, near array<int>"))
    entries = described.select("*", F.col("near")[0].alias("home"), F.explode("near").alias("list"))
    least = max(block_rows, n * widest // MAX_ZONES)
    sizes = checkpointed(entries.groupBy("dim", "list", "home").count())
    sizes = sizes.withColumn("zone", F.when((F.col("home") != F.col("list")) & (F.col("count") > least), F.col("home")).otherwise(-1))
    sizes = sizes.groupBy("dim", "list", "zone").agg(F.ceil(F.sum("count") / block_rows).cast("int").alias("blocks"))
    # of the lists and zones longer than a block, bounded by the pivots of a vector length and MAX_ZONES
    lists: dict[tuple, dict[int, int]] = {}
    for r in sizes.where("blocks > 1 OR zone >= 0").collect():
        lists.setdefault((r["dim"], r["list"]), {-1: 1})[r["zone"]] = r["blocks"]
    cuts = []
    for (dim, pivot), blocks in lists.items():
        first, total = 0, sum(blocks.values())
        for zone in sorted(blocks):  # what has no zone comes first
            cuts.append((dim, pivot, zone, first, blocks[zone], total))
            first += blocks[zone]
    cuts = spark.createDataFrame(cuts or [(-1, -1, -1, 0, 1, 1)], "dim int, list int, zone int, first int, blocks int, total int")
    rest = cuts.where("zone < 0").select("dim", "list", F.struct("zone", "first", "blocks", "total").alias("rest"))
    zones = cuts.where("zone >= 0").select("dim", "list", F.col("zone").alias("home"), F.struct("zone", "first", "blocks", "total").alias("cut"))
    whole = F.struct(F.lit(-1).alias("zone"), F.lit(0).alias("first"), F.lit(1).alias("blocks"), F.lit(1).alias("total"))
    entries = entries.join(F.broadcast(rest), ["dim", "list"], "left").join(F.broadcast(zones), ["dim", "list", "home"], "left")
    entries = entries.select("rep", "size", "x", "near", "dim", "list", F.coalesce("cut", "rest", whole).alias("cut"))
    entries = entries.select("*", "cut.*").withColumn("own", (F.col("first") + F.pmod(F.xxhash64("rep"), F.col("blocks"))).cast("int"))
    entries = entries.withColumn("other", F.explode(F.expr(
        "filter(sequence(0, total - 1), o -> zone < 0 OR o < first OR o >= first + blocks)")))
    entries = entries.select("rep", "size", "x", "near", "dim", "list", "own", F.least("own", "other").alias("lo"),
                             F.greatest("own", "other").alias("hi"))

    def verify(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        _, here, lo, hi = key
        side = (b["own"].to_numpy() == hi) & (lo != hi)
        if len(b) > 1 and (lo == hi or side.any() and not side.all()):
            ids, size = b["rep"].to_numpy(), b["size"].to_numpy()
            width = max(map(len, b["near"]))
            near = np.full((len(b), width), -1)
            for i, r in enumerate(b["near"]):
                near[i, :len(r)] = r
            links = link_blocks(_unit(np.stack(b["x"].to_numpy())), near, side if lo != hi else None, here,
                                min(shared, width), cosine)
            n_links = links @ size + links.T @ size
            out += [(int(i), None, int(c)) for i, c in zip(ids, n_links, strict=True) if c]
            out += [(a, m, 0) for a, m in forest(links, ids)]
        return pd.DataFrame(out, columns=["rep", "linked", "n"]).astype({"rep": "int64", "linked": "Int64", "n": "int64"})

    found = checkpointed(entries.groupBy("dim", "list", "lo", "hi").applyInPandas(verify, "rep long, linked long, n long"))
    counts = found.where("linked IS NULL").groupBy("rep").agg(F.sum("n").alias("n"))
    components = connected_components(found.where("linked IS NOT NULL").select(F.col("rep").alias("a"), F.col("linked").alias("b")))
    classes = (classes.join(counts, "rep", "left").join(components.withColumnRenamed("id", "rep"), "rep", "left")
               .select("x", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                       F.coalesce("component_id", "rep").alias("component_id")))
    linked = points.join(classes, "x").groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return rows.join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"))


def op1_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach AS r JOIN l ON r.b = l.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), d AS (
  SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings AS e JOIN c USING (vec_id) LEFT JOIN d USING (vec_id)
"""
