"""MinHash near-dedup with circulant signatures.

Two permutations make a whole signature. The first scatters the shingles over a circle of 2^32 places; the second
ranks the places, and coordinate k is the least rank after turning the circle by k. Both are fixed bijections.
Coordinates are banded; documents that share a band are candidates, and a candidate pair is linked only if the exact
Jaccard similarity of its full sets reaches the threshold.

Documents of equal sets are one class and go through the search once. In each band bucket every class is first held
against the bucket's smallest, which connects most of a group of near copies at about one comparison a member and
bucket. What candidates leave unconnected is gathered into clusters (components of the candidate pairs whose ends are
still apart); in those all pairs of different components are compared, block by block, by one product of shingle
incidences a block pair, which emits a forest of links and never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components, forest
from .shingles import forget, mix64, shingle_sets
from .tables import checkpointed, forget_shuffles, id_text, read_table, ship_package, text_pieces

BANDS, ROWS = 24, 7  # a pair at 0.85 shares no band with a probability of 1e-4
WIDTH = 5
PERCENT = 85
BLOCK_ROWS = 256  # sets of a block in a cluster's comparison
ALONE = 2  # the side of a block that is held against itself
_CHUNK = 1024


def _rank(places: np.ndarray) -> np.ndarray:
    """The second permutation: a bijection of 32-bit places, in place."""
    places ^= places >> np.uint32(16)
    places *= np.uint32(0x85EBCA6B)
    places ^= places >> np.uint32(13)
    places *= np.uint32(0xC2B2AE35)
    places ^= places >> np.uint32(16)
    return places


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The circulant MinHash of a non-empty set of 64-bit shingle hashes."""
    places = (mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    turns = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(places), _CHUNK):
        np.minimum(least, _rank(places[None, at:at + _CHUNK] + turns).min(axis=1), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key a band, of the band's number and coordinates."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in sig.reshape(bands, rows).astype(np.uint64).T:
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def signatures(texts: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the whole set; null if empty), bands, of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            sets = shingle_sets(piece.column(1).to_pylist(), width)
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            found = [band_keys(signature(s, bands * rows), bands, rows) if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])
        forget()

    return texts.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def sets_of(texts: DataFrame, width: int) -> DataFrame:
    """doc_id, shingles (array<long>, distinct) of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            sets = [s.view(np.int64) for s in shingle_sets(piece.column(1).to_pylist(), width)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["doc_id", "shingles"])
        forget()

    return texts.mapInArrow(run, "doc_id long, shingles array<long>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = sets_of(texts.join(ids, "doc_id", "left_semi"), width)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b").distinct()


def cluster_links(candidates: DataFrame, placed: DataFrame, texts: DataFrame, width: int, percent: int,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) that connect what is still apart: over all pairs of different components in a cluster.

    ``candidates`` (rep, hub) share a bucket, ``placed`` (id, component_id) are the components so far. A cluster is cut
    into blocks, every two of them that may hold different components (``block_pairs``) are a group of their own, and a
    group gives a forest of its links.
    """
    def labelled(column: str, name: str) -> DataFrame:
        return placed.select(F.col("id").alias(column), F.col("component_id").alias(name))

    ends = candidates.join(labelled("rep", "c"), "rep", "left").join(labelled("hub", "h"), "hub", "left").select(
        "rep", "hub", F.coalesce("c", "rep").alias("c"), F.coalesce("h", "hub").alias("h"))
    ends = checkpointed(ends)
    clusters = connected_components(ends.where("c <> h").select(F.col("c").alias("a"), F.col("h").alias("b")))
    rows = ends.select(F.explode(F.array(F.struct(F.col("rep").alias("doc"), F.col("c").alias("component")),
                                         F.struct(F.col("hub").alias("doc"), F.col("h").alias("component")))).alias("r"))
    rows = rows.select("r.*").distinct().join(clusters.select(
        F.col("id").alias("component"), F.col("component_id").alias("cluster")), "component")
    rows = checkpointed(rows)
    sets = sets_of(texts.join(rows.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi"), width)
    met = block_pairs(rows, block_rows).join(sets.withColumnRenamed("doc_id", "doc"), "doc")

    def verify(b: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        component, side = b["component"].to_numpy(), b["side"].to_numpy()
        apart = component[:, None] != component[None, :]
        if side[0] != ALONE:
            apart &= side[:, None] != side[None, :]
        if apart.any():
            links = similar([np.asarray(s, np.int64) for s in b["shingles"]], percent) & apart
            out = forest(np.triu(links, 1), b["doc"].to_numpy())
        return pd.DataFrame(out, columns=["a", "b"]).astype({"a": "int64", "b": "int64"})

    return met.groupBy("pair").applyInPandas(verify, "a long, b long")


def block_pairs(rows: DataFrame, block_rows: int) -> DataFrame:
    """(pair, side, doc, component): the documents of each two blocks of a cluster that may hold different components.

    ``rows`` are (cluster, component, doc). A component of more than ``block_rows`` documents is a unit cut into blocks of
    its own, which never meet each other; the smaller ones of a cluster together are a unit, cut by whole components, whose
    blocks meet each other and themselves (side ``ALONE``). So a large component that a few others touch is copied a few
    times, whatever its size.
    """
    sizes = rows.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("large", F.col("n") > block_rows).withColumn("unit", F.when(F.col("large"), F.col("component")).otherwise(0))
    units = sizes.groupBy("cluster", "large", "unit").agg(
        F.ceil(F.sum("n") / block_rows).cast("int").alias("blocks"), F.count("*").alias("components"))
    members = (rows.join(sizes.drop("n"), ["cluster", "component"]).join(units, ["cluster", "large", "unit"])
               .withColumn("block", F.pmod(F.xxhash64(F.when(F.col("large"), F.col("doc")).otherwise(F.col("component"))),
                                           F.col("blocks")).cast("int"))
               .select("cluster", F.struct("large", "unit", "block").alias("place"), "doc", "component"))
    one, two = (units.select("cluster", F.struct("large", "unit").alias(f"u{k}"), F.col("blocks").alias(f"n{k}"),
                             F.col("components").alias(f"c{k}")) for k in (1, 2))
    same = F.col("u1") == F.col("u2")
    met = one.join(two, "cluster").where((F.col("u1") < F.col("u2")) | (same & ~F.col("u1.large") & (F.col("c1") > 1)))
    met = met.withColumn("b1", F.explode(F.sequence(F.lit(0), F.col("n1") - 1)))
    met = met.withColumn("b2", F.explode(F.sequence(F.when(same, F.col("b1")).otherwise(0), F.col("n2") - 1)))
    place = [F.struct(F.col(f"u{k}.large").alias("large"), F.col(f"u{k}.unit").alias("unit"), F.col(f"b{k}").alias("block"))
             for k in (1, 2)]
    met = met.select("cluster", place[0].alias("p1"), place[1].alias("p2"))
    sides = met.select(F.struct("cluster", "p1", "p2").alias("pair"), "cluster", F.explode(
        F.when(F.col("p1") == F.col("p2"), F.array("p1")).otherwise(F.array("p1", "p2"))).alias("place"))
    sides = sides.withColumn("side", F.when(F.col("pair.p1") == F.col("pair.p2"), ALONE).when(F.col("place") == F.col("pair.p1"), 0).otherwise(1))
    return sides.join(members, ["cluster", "place"]).select("pair", "side", "doc", "component")


def similar(sets: list[np.ndarray], percent: int, columns: int = 4096) -> np.ndarray:
    """Which of the sets reach the similarity to each other, by products of their incidence, some shingles at a time."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    row = np.repeat(np.arange(n), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1  # a shingle of one set alone adds to no intersection
    number = np.cumsum(shared) - 1
    keep = shared[place]
    row, place = row[keep], number[place[keep]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    common = np.zeros((n, n), np.float32)
    for at in range(0, int(shared.sum()), columns):
        part = slice(*np.searchsorted(place, [at, at + columns]))
        incidence = np.zeros((n, columns), np.float32)
        incidence[row[part], place[part] - at] = 1
        common += incidence @ incidence.T
    union = sizes[:, None] + sizes[None, :] - common
    return 100 * common >= percent * union


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``.

    Null, empty and blank texts have an empty set, link with nothing and are kept, as are rows with a null id
    (component null). Rows that repeat an id are one document, linked with whatever any of its texts is like.
    """
    ship_package(docs.sparkSession)
    texts = id_text(docs, id_col, text_col)
    signed = checkpointed(signatures(texts, bands, rows, width))
    classes = (signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
               .groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")))
    classes = checkpointed(classes)
    entries = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("rep").alias("hub"), F.min(F.struct("rep", "n")).alias("least"),
                                           F.max("rep").alias("last")).where("hub <> last")
    met = checkpointed(entries.join(shared.select("bucket", "hub", F.col("least.n").alias("hub_n")), "bucket"))

    def like(n: str, m: str):  # sets whose sizes differ more can't reach the similarity
        return (F.col(n) * 100 >= F.col(m) * percent) & (F.col(m) * 100 >= F.col(n) * percent)

    first = met.where(F.col("rep") != F.col("hub")).where(like("n", "hub_n")).select(
        F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = checkpointed(verified(first, texts, width, percent))
    forget_shuffles(docs.sparkSession)
    placed = checkpointed(connected_components(links))
    more = cluster_links(met.select("rep", "hub").distinct(), placed, texts, width, percent)
    of_class = classes.select("set_key", "rep")
    texts_of = signed.select("doc_id", "set_key").join(of_class, "set_key").select("doc_id", "rep").distinct()
    several = texts_of.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("a <> b")
    repeats = texts_of.join(several.select("doc_id", "b"), "doc_id").select(F.col("rep").alias("a"), "b")
    more = checkpointed(more)
    forget_shuffles(docs.sparkSession)
    found = connected_components(placed.select(F.col("id").alias("a"), F.col("component_id").alias("b"))
                                 .unionByName(more).unionByName(repeats))
    of_class = of_class.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component_id", "rep").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return signed.join(of_class, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op5_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes AS m ON m.doc_id = a.doc_id JOIN sizes AS n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents AS d JOIN c USING (doc_id) LEFT JOIN sizes AS n USING (doc_id)
"""
