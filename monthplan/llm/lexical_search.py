"""Ranked lexical search: exact inner products of sparse vectors over ball trees.

A document's vector holds, for each term that some query uses, its saturated frequency; a query's holds the terms'
weights. The score is their inner product, all in integers. Documents are sorted by their rarest terms, so that those
alike stand together, and cut into chunks; each chunk becomes a ball tree. A ball has a centroid c, the largest distance r
of a member from it, and the largest distance by coordinate; no member scores more than q.c + |q| r, nor than
q.c + q.r by coordinate. The smaller bound, rounded up past any error of its sum and then down to a whole number, lets a
query leave a subtree out. Balls are opened best bound first and leaves are scored exactly. The floor that a query has
reached goes along from chunk to chunk of a task.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .tables import narrow, read_table, ship_package, stored, text_pieces

TOP = 20
LEAF = 64  # documents of a leaf
CHUNK_ROWS, CHUNK_TERMS = 8192, 1_500_000  # documents and vector entries of one tree at most (one document at least)
PART_ROWS = 32_768  # documents of a task, more where that would be over MAX_PARTS tasks
MAX_PARTS = 20_000
QUERY_BYTES = 8_000_000  # item texts searched together; beyond that the query set goes through in blocks
BOUND_QUERIES, BOUND_TERMS = 512, 8192  # queries and terms whose bounds are worked out together
PIECE = 1_000_000  # bytes of a text that are split into words at once

_TABLE = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))


def terms(text: str | None) -> Counter:
    """Term (UTF-8) -> occurrences. Only A-Z are lower-cased; any other ASCII but 0-9 parts terms."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    if len(raw) <= PIECE:
        return Counter(raw.split())
    found, at = Counter(), 0
    while at < len(raw):  # pieces end at a space
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        found.update(raw[at:end].split())
        at = end
    return found


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class BallTree:
    """A tree over sparse rows (CSR: row i holds columns idx[indptr[i]:indptr[i + 1]] with whole values val).

    Rows are split in halves along the line between two rows far apart, in the space where a column counts by ``scale``.
    """

    def __init__(self, ids: np.ndarray, indptr: np.ndarray, idx: np.ndarray, val: np.ndarray, scale: np.ndarray, leaf: int = LEAF):
        self.columns, local = np.unique(idx, return_inverse=True)
        y = val * scale[idx]
        order: list[np.ndarray] = []
        self.span, self.child, self.filled = [], [], 0

        def grow(rows: np.ndarray, ptr: np.ndarray, col: np.ndarray, x: np.ndarray) -> int:
            node = len(self.span)
            self.span.append((self.filled, self.filled + len(rows)))
            self.child.append((-1, -1))
            if len(rows) <= leaf:
                order.append(rows)
                self.filled += len(rows)
                return node
            halves = self._halve(ptr, col, x)
            kids = []
            for half in halves:
                half = np.sort(half)
                entries, sub = _gather(ptr, half)
                kids.append(grow(rows[half], sub, col[entries], x[entries]))
            self.child[node] = (kids[0], kids[1])
            return node

        grow(np.arange(len(ids)), indptr, local, y)
        rows = np.concatenate(order)
        entries, self.ptr = _gather(indptr, rows)
        self.ids, self.col, self.idx, self.val = ids[rows], local[entries], idx[entries], val[entries]
        self.row = np.repeat(np.arange(len(rows)), np.diff(self.ptr))
        self.least = np.array([self.ids[a:b].min() for a, b in self.span])
        self.scored = 0  # leaves looked into so far, by all queries

    def _halve(self, ptr: np.ndarray, col: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, wide = len(ptr) - 1, len(self.columns)
        norm = np.add.reduceat(x * x, ptr[:-1])

        def along(v: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x * v[col], ptr[:-1])

        def row(i: int) -> np.ndarray:
            v = np.zeros(wide)
            v[col[ptr[i]:ptr[i + 1]]] = x[ptr[i]:ptr[i + 1]]
            return v

        mean = np.bincount(col, x, wide) / size
        one = along(row(int(np.argmax(norm - 2 * along(mean)))))
        two = along(row(int(np.argmax(norm - 2 * one))))
        line = np.argsort(two - one, kind="stable")
        return line[:size // 2], line[size // 2:]

    def bounds(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The whole number that no member's score of node (row) by query (column) goes beyond."""
        used = np.unique(np.concatenate([q[0] for q in queries]))
        used = used[np.isin(used, self.columns)]
        if not len(used):
            return np.zeros((len(self.span), len(queries)), np.int64)
        q = np.zeros((len(used), len(queries)))
        for j, (t, v) in enumerate(queries):
            at = np.searchsorted(used, t)
            known = (at < len(used)) & (used[np.minimum(at, len(used) - 1)] == t)
            q[at[known], j] = v[known]
        where = np.searchsorted(used, self.columns)
        where[(where >= len(used)) | (used[np.minimum(where, len(used) - 1)] != self.columns)] = -1
        col = where[self.col]
        keep = col >= 0
        col, row, val = col[keep], self.row[keep], self.val[keep].astype(float)
        edge = np.searchsorted(row, np.array([s for pair in self.span for s in pair])).reshape(-1, 2)
        nodes, wide = len(self.span), len(used)
        total, high, low = np.zeros((nodes, wide)), np.zeros((nodes, wide)), np.zeros((nodes, wide))
        for node in range(nodes - 1, -1, -1):  # children come after their parent
            left, right = self.child[node]
            if left >= 0:
                total[node] = total[left] + total[right]
                np.maximum(high[left], high[right], out=high[node])
                np.minimum(low[left], low[right], out=low[node])
                continue
            (a, b), (first, last) = edge[node], self.span[node]
            total[node] = np.bincount(col[a:b], val[a:b], wide)
            np.maximum.at(high[node], col[a:b], val[a:b])
            everywhere = np.bincount(col[a:b], minlength=wide) == last - first
            if everywhere.any():
                least = np.full(wide, np.inf)
                np.minimum.at(least, col[a:b], val[a:b])
                low[node, everywhere] = least[everywhere]
        size = np.array([b - a for a, b in self.span], float)
        centre = total / size[:, None]
        reach = np.maximum(high - centre, centre - low)
        norm = np.bincount(row, val * val, len(self.ids))
        radius = np.empty(nodes)
        for node, (first, last) in enumerate(self.span):
            a, b = edge[node]
            along = np.bincount(row[a:b] - first, val[a:b] * centre[node, col[a:b]], last - first)
            far = norm[first:last] - 2 * along + centre[node] @ centre[node]
            # whole members around a rounded centre: what cancels is below a part in 2^30 of the norms
            radius[node] = math.sqrt(max(far.max(), 0) + (norm[first:last].max() + centre[node] @ centre[node]) * 2.0**-30)
        middle = centre @ q
        best = middle + np.minimum(reach @ q, radius[:, None] * np.sqrt((q * q).sum(axis=0))[None, :])
        slack = (np.count_nonzero(q, axis=0) + 16) * 2.0**-51
        return np.floor(best * (1 + slack)[None, :]).astype(np.int64)

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], top: list[list[tuple[int, int]]], k: int, columns: int) -> None:
        """Bring each query's list of (-score, id) up to date, at most k and in order."""
        bound, dense = self.bounds(queries), np.zeros(columns, np.int64)
        for j, (t, v) in enumerate(queries):
            best = top[j]
            heap = [(-int(bound[0, j]), 0)]
            dense[t] = v
            while heap:
                most, node = heapq.heappop(heap)
                if most >= 0 or (len(best) == k and most > best[-1][0]):
                    break  # every other bound is smaller still
                if len(best) == k and (most, self.least[node]) > best[-1]:
                    continue  # at most a tie, and all ids here come later
                left, right = self.child[node]
                if left >= 0:
                    heapq.heappush(heap, (-int(bound[left, j]), left))
                    heapq.heappush(heap, (-int(bound[right, j]), right))
                    continue
                self.scored += 1
                a, b = self.span[node]
                lo, hi = self.ptr[a], self.ptr[b]
                score = np.add.reduceat(self.val[lo:hi] * dense[self.idx[lo:hi]], self.ptr[a:b] - lo)
                good = np.flatnonzero(score >= (-best[-1][0] if len(best) == k else 1))
                if len(good):
                    new = zip((-score[good]).tolist(), self.ids[a:b][good].tolist(), strict=True)
                    best[:] = sorted([*best, *new])[:k]
            dense[t] = 0


def _gather(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries of ``rows`` in their order, their own row pointer)."""
    size = ptr[rows + 1] - ptr[rows]
    out = np.concatenate([[0], np.cumsum(size)])
    return np.arange(out[-1]) + np.repeat(ptr[rows] - out[:-1], size), out


def _query_blocks(items: DataFrame, max_bytes: int) -> Iterator[list[Row]]:
    """Items in runs of about ``max_bytes`` of text, fetched one partition at a time."""
    block, held = [], 0
    for row in items.toLocalIterator():
        block.append(row)
        held += len(row["text"] or "") + 64
        if held >= max_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def _lists(values: np.ndarray, sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.int32()),
                                    pa.array(values, pa.int32()))


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, t, f) of each document with a term: its length, the vocabulary's terms that it holds, and how often."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value
        for piece in text_pieces(batches):
            ids, n, sizes, t, f = [], [], [], [], []
            for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                held = terms(text)
                if held:
                    own = [(place[w], c) for w, c in held.items() if w in place]
                    ids.append(doc_id)
                    n.append(sum(held.values()))
                    sizes.append(len(own))
                    t += [a for a, _ in own]
                    f += [c for _, c in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), _lists(np.array(t, np.int32), sizes), _lists(np.array(f, np.int32), sizes)],
                ["doc_id", "n", "t", "f"])

    return docs.mapInArrow(work, "doc_id long, n long, t array<int>, f array<int>")


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, row pointer) of a list column."""
    lists = batch.column(batch.schema.get_field_index(name))
    ptr = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy(zero_copy_only=False)[ptr[0]:ptr[-1]].astype(np.int64), ptr - ptr[0]


def impacts(vectors: DataFrame, documents: int, length: int, rank: np.ndarray) -> DataFrame:
    """(doc_id, t, x, rarest, next): a term's saturated frequency, and the two rarest terms by ``rank`` to sort by."""
    ranks = vectors.sparkSession.sparkContext.broadcast(rank)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (t, ptr), (f, _) = _flat(batch, "t"), _flat(batch, "f")
            n = batch.column(batch.schema.get_field_index("n")).to_pylist()
            m = np.array([75 + 25 * size * documents // length for size in n], np.int64)  # whole numbers of any size
            row = np.repeat(np.arange(len(n)), np.diff(ptr))
            x = 1_000_000_000 * f // (1000 * f + 12 * m[row])
            order = np.lexsort((ranks.value[t], row))
            t, x = t[order], x[order]  # each document's terms by rarity
            first, second = ranks.value[t[ptr[:-1]]], ranks.value[t[np.minimum(ptr[:-1] + 1, ptr[1:] - 1)]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(t.astype(np.int32), np.diff(ptr).tolist()), _lists(x.astype(np.int32), np.diff(ptr).tolist()),
                 pa.array(first, pa.int32()), pa.array(second, pa.int32())], ["doc_id", "t", "x", "rarest", "next"])

    return vectors.where("doc_id IS NOT NULL AND size(t) > 0").mapInArrow(work, "doc_id long, t array<int>, x array<int>, rarest int, next int")


def _chunks(batches: Iterator[pa.RecordBatch], rows: int, entries: int) -> Iterator[pa.Table]:
    """Runs of at most ``rows`` rows and ``entries`` list entries, one row at least."""
    held, n, size = [], 0, 0
    for batch in batches:
        ends = batch.column(1).offsets.to_numpy().astype(np.int64)
        ends = ends[1:] - ends[0]
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            fit = int(np.searchsorted(ends, before + entries - size, side="right"))
            end = min(at + rows - n, max(fit, at + (not n)), batch.num_rows)
            if end > at:
                held.append(batch.slice(at, end - at))
                n, size = n + end - at, size + int(ends[end - 1]) - before
                at = end
            if at < batch.num_rows:  # full
                yield pa.Table.from_batches(held)
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def best_of(sorted_vectors: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], scale: np.ndarray, k: int, leaf: int,
            chunk_rows: int) -> DataFrame:
    """(q, doc_id, score): for each task the k best documents of each query."""
    asked = sorted_vectors.sparkSession.sparkContext.broadcast((queries, scale))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, by = asked.value
        top: list[list[tuple[int, int]]] = [[] for _ in every]
        for chunk in _chunks(batches, chunk_rows, CHUNK_TERMS):
            batch = chunk.combine_chunks().to_batches()[0]
            (t, ptr), (x, _) = _flat(batch, "t"), _flat(batch, "x")
            tree = BallTree(batch.column(0).to_numpy(), ptr, t, x, by, leaf)
            for block in _bound_blocks(every):
                found = [top[j] for j in block]
                tree.search([every[j] for j in block], found, k, len(by))
        rows = [(j, i, -s) for j, best in enumerate(top) for s, i in best]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
                zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["q", "doc_id", "score"])

    return sorted_vectors.select("doc_id", "t", "x").mapInArrow(work, "q int, doc_id long, score long")


def _bound_blocks(queries: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[int]]:
    """Numbers of queries that are bounded together: few enough, and with few enough terms (one query at least)."""
    block: list[int] = []
    held: set[int] = set()
    for j, (t, _) in enumerate(queries):
        if block and (len(block) == BOUND_QUERIES or len(held.union(t.tolist())) > BOUND_TERMS):
            yield block
            block, held = [], set()
        block.append(j)
        held.update(t.tolist())
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", leaf: int = LEAF, chunk_rows: int = CHUNK_ROWS,
           part_rows: int = PART_ROWS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` its k best rows of ``docs`` with a score above 0.

    Every row is a document or an item of its own, also where ids repeat; equal scores go by ascending id. Null and empty
    texts hold no term: such a document counts nowhere, such an item gets no rows. A document without an id counts in the
    statistics but can't be named, so it isn't listed. Empty tables give no rows; other columns don't count.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = narrow(items, item_id=item_col, text=item_text_col)
    kind = asked.schema["item_id"].dataType.simpleString()
    parts = [_search_block(texts, block, kind, k, leaf, chunk_rows, part_rows) for block in _query_blocks(asked, query_bytes)]
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)


def _search_block(texts: DataFrame, items: list[Row], kind: str, k: int, leaf: int, chunk_rows: int, part_rows: int) -> DataFrame:
    spark = texts.sparkSession
    held = [terms(row["text"]) for row in items]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*held)))}
    vectors = stored(term_vectors(texts, vocabulary), "lexical-vectors")
    about = vectors.agg(F.count("*").alias("documents"), F.sum("n").alias("length"),
                        F.count(F.when(F.size("t") > 0, 1)).alias("rows")).first()
    holding = np.zeros(len(vocabulary), np.int64)  # one count a term of the block's items
    for row in vectors.select(F.explode("t").alias("t")).groupBy("t").count().collect():
        holding[row["t"]] = row["count"]
    documents = about["documents"]
    weights = np.array([weight(documents, int(d)) for d in holding], np.int64)
    rank = np.empty(len(weights), np.int64)
    rank[np.lexsort((np.arange(len(weights)), -weights))] = np.arange(len(weights))
    queries = []
    for one in held:
        t = np.array(sorted(vocabulary[w] for w in one if holding[vocabulary[w]]), np.int64)
        often = {vocabulary[w]: c for w, c in one.items()}
        queries.append((t, np.array([often[i] for i in t.tolist()], np.int64) * weights[t]))
    parts = min(MAX_PARTS, max(1, -(-about["rows"] // part_rows)))
    placed = impacts(vectors, documents, about["length"] or 1, rank).repartitionByRange(parts, "rarest", "next", "doc_id")
    found = best_of(placed.sortWithinPartitions("rarest", "next", "doc_id"), queries, weights.astype(float), k, leaf, chunk_rows)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "doc_id")
    named = spark.createDataFrame([(j, row["item_id"]) for j, row in enumerate(items)], f"q int, item_id {kind}")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .join(F.broadcast(named), "q").select("item_id", "rank", "doc_id", "score"))


def op13_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH doc_term AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
  GROUP BY doc_id, term
), item_term AS (
  SELECT item_id, term, count(*) AS qf
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term
), doc_length AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM doc_term GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM doc_length),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM doc_term, total GROUP BY term, docs
), scored AS (
  SELECT item_id, doc_id,
         CAST(sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
  FROM item_term JOIN weight USING (term) JOIN doc_term USING (term) JOIN doc_length USING (doc_id), total
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
