"""Nearest neighbours by inner product through vantage-point trees, one tree a shard.

Inner product becomes a metric by one more coordinate: with M the largest norm of a shard, (x, sqrt(M^2 - |x|^2)) and
(q, 0) lie the closer together the larger q.x is. A tree splits its shard at the median distance from a vantage
point; a child is skipped when the triangle inequality puts all of it beyond ``factor`` times the distance of the
k-th best so far. At factor one nothing nearer can be lost, so the search is exact; smaller factors skip more.

Shards are index rows of a bounded number of vectors, so the count of shards grows with the table. Queries go through
all shards in blocks, one (shard, block) pair at a time, and each keeps its k best there; a window picks the k best.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import narrow, read_table, ship_package

SHARD_ROWS = 4096
BLOCK_QUERIES = 1024
LEAF = 256
FACTOR = 1.0


def usable(df: DataFrame, id_col: str, vec_col: str, with_zero: bool = False) -> DataFrame:
    """Distinct (vec_id, x array<double>): no null id or vector, no null or non-finite component, not all zero."""
    v = narrow(df, vec_id=id_col, x=vec_col)
    v = v.where("vec_id IS NOT NULL AND x IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("x").cast("array<double>").alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.where(~bad & (F.size("x") > 0))
    if not with_zero:
        v = v.where(F.exists("x", lambda c: c != 0))
    return v.distinct()


class VpTree:
    """Arrays of a tree: nodes in preorder, leaves as ranges of the reordered points."""

    FIELDS = ("points", "ids", "extra", "vp", "child", "reach", "span")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF, seed: int = 1) -> VpTree:
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        norms = np.einsum("ij,ij->i", x, x)
        extra = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
        full = np.column_stack([x, extra])
        rng = np.random.default_rng(seed)
        vp, child, reach, span, at, ranges = [], [], [], [], [], []

        def grow(members: np.ndarray) -> int:
            node = len(vp)
            vp.append(np.zeros(full.shape[1]))
            child.append([-1, -1])
            reach.append([0.0, 0.0, 0.0, 0.0])  # least and largest distance of the near, then of the far child
            span.append([0, 0])
            if len(members) > leaf:
                point = full[members[rng.integers(len(members))]]
                d = np.sqrt(np.maximum(np.einsum("ij,ij->i", full[members] - point, full[members] - point), 0))
                near = d <= np.median(d)
                if near.all():  # more than half at the largest distance: a tie that no median splits
                    near = d < d.max()
                if near.any() and not near.all():
                    vp[node] = point
                    reach[node] = [d[near].min(), d[near].max(), d[~near].min(), d[~near].max()]
                    child[node] = [grow(members[near]), grow(members[~near])]
                    return node
            span[node] = [sum(ranges), sum(ranges) + len(members)]
            ranges.append(len(members))
            at.append(members)
            return node

        grow(np.arange(len(ids)))
        order = np.concatenate(at)
        return cls(points=x[order], ids=ids[order], extra=extra[order], vp=np.array(vp), child=np.array(child),
                   reach=np.array(reach), span=np.array(span))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> VpTree:
        with np.load(io.BytesIO(data)) as z:
            return cls(**{f: z[f] for f in cls.FIELDS})

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> Iterator[tuple]:
        """(query_id, ids, scores) of each query's k best here, its own row apart; ties at the end all stay in."""
        squares = np.einsum("ij,ij->i", q, q) + (np.einsum("ij,ij->i", self.points, self.points) + self.extra**2).max()
        best = np.full((len(q), k), -np.inf)  # the k largest inner products so far
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in q]
        full_q = np.column_stack([q, np.zeros(len(q))])
        slack = 1e-9

        def leaf(node: int, live: np.ndarray) -> None:
            a, b = self.span[node]
            s = q[live] @ self.points[a:b].T
            s[query_ids[live][:, None] == self.ids[None, a:b]] = -np.inf
            floor = best[live, 0]
            hit = s >= (floor - slack * (1 + np.abs(floor)))[:, None] if np.isfinite(floor).any() else s > -np.inf
            hit &= s > -np.inf
            rows = np.flatnonzero(hit.any(axis=1))
            for r in rows:
                i, c = live[r], np.flatnonzero(hit[r])
                found[i].append((a + c, s[r, c]))
            merged = np.concatenate([best[live[rows]], np.where(hit[rows], s[rows], -np.inf)], axis=1)
            best[live[rows]] = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
            best[live[rows]] = np.sort(best[live[rows]], axis=1)

        def visit(node: int, live: np.ndarray) -> None:
            if not len(live):
                return
            if self.child[node, 0] < 0:
                leaf(node, live)
                return
            diff = full_q[live] - self.vp[node]
            d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            near_lo, near_hi, far_lo, far_hi = self.reach[node]
            first = d <= (near_hi + far_lo) / 2  # these look into the near child first

            def beyond(ids: np.ndarray, dist: np.ndarray, lo: float, hi: float) -> np.ndarray:
                least = np.maximum(np.maximum(lo - dist, dist - hi), 0)
                tau = np.sqrt(np.maximum(squares[ids] - 2 * best[ids, 0], 0))  # infinite while fewer than k are known
                return least > factor * tau + slack

            for side, (lo, hi) in ((0, (near_lo, near_hi)), (1, (far_lo, far_hi))):
                mine = first if side == 0 else ~first
                visit(self.child[node, side], live[mine][~beyond(live[mine], d[mine], lo, hi)])
            for side, (lo, hi) in ((1, (far_lo, far_hi)), (0, (near_lo, near_hi))):
                mine = first if side == 1 else ~first
                visit(self.child[node, side], live[mine][~beyond(live[mine], d[mine], lo, hi)])

        visit(0, np.arange(len(q)))
        for i, parts in enumerate(found):
            if not parts:
                continue
            at, s = (np.concatenate(p) for p in zip(*parts, strict=True))
            at = at[s >= best[i, 0] - slack * (1 + abs(best[i, 0]))] if np.isfinite(best[i, 0]) else at
            # the reported score adds the products in order, so that equal vectors get equal scores
            yield query_ids[i], self.ids[at], np.cumsum(self.points[at] * q[i], axis=1)[:, -1]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest other vectors by inner product, ties to the smaller id.

    Vectors that are null, empty, zero, without an id, or hold null or non-finite components take no part, nor do
    those of another length than the query's. Repeated rows count once. With fewer than k candidates all are returned;
    an empty table gives no rows.
    """
    ship_package(vectors.sparkSession)
    points = usable(vectors, id_col, vec_col).withColumn("dim", F.size("x"))
    asked = usable(queries, id_col, vec_col).withColumn("dim", F.size("x"))
    shape = points.agg(F.count("*").alias("n")).first()["n"]
    shards, blocks = max(1, -(-shape // shard_rows)), max(1, -(-asked.count() // BLOCK_QUERIES))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(rows["x"].to_numpy()), rows["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        x, ids = x[order], ids[order]
        _, kind = np.unique(x, axis=0, return_inverse=True)  # of equal vectors only the k + 1 smallest ids can be wanted
        nth = pd.Series(kind.ravel()).groupby(kind.ravel()).cumcount().to_numpy()
        tree = VpTree.build(ids[nth <= k], x[nth <= k])
        return pd.DataFrame({"shard": [key[0]], "dim": [key[1]], "tree": [tree.dump()]})

    index = (points.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
             .groupBy("shard", "dim").applyInPandas(build, "shard int, dim int, tree binary"))
    pairs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = (asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))

    def look(tree: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(tree) and len(rows):
            found = VpTree.load(tree["tree"].iloc[0]).search(rows["vec_id"].to_numpy(), np.stack(rows["x"].to_numpy()), k, factor)
            for query, ids, scores in found:
                best = np.lexsort((ids, -scores))[:k]
                out += zip([query] * len(best), ids[best].tolist(), scores[best].tolist(), strict=True)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["shard", "block", "dim"]
    near = asked.groupBy(*keys).cogroup(pairs.groupBy(*keys)).applyInPandas(
        lambda rows, tree: look(tree, rows), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op10_vp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND q.vec_id % 20 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
