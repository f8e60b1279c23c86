"""Merkle manifest of a table with an inclusion proof for every row, made by pointer jumping.

Each row is a leaf. A language's leaves, ordered by id, are hashed in pairs level by level to its subroot; the subroots,
ordered by language, are hashed the same way to the root. Every node first holds the one sibling step towards its
parent. A self-join then gives a node its ancestor's steps as well, so the distance doubles each time and every leaf
reaches its top after log2(depth) joins. Only nodes on multiples of the doubled distance are still somebody's ancestor;
the others leave the table.

No tree is gathered anywhere: places come from a range sort with counts by partition, levels are hashed in blocks of
1024 neighbours, and a join key is an ancestor with at most 2^distance leaves below it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import drop, narrow, read_table, stored

BLOCK = 10  # levels hashed at once: a block has 2^10 neighbours
STEP = 33  # bytes of a step: the sibling's side (0 none, 1 left, 2 right), then its digest
TOP_BLOCK = 16  # rows of a language that share one copy of its way to the root: 2^16
TAMPER = 7  # the manifest is proven against ids whose CRC this divides


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered, salt): the row's digest, that of the tampered row where there is one, and its language.

    ``tree`` orders like the language, bytewise and null first.
    """
    c = F.col
    chars = c("n_chars").cast("decimal(38,0)")

    def leaf(n_chars: Column) -> Column:
        return digest(field(c("doc_id")), field(c("source")), field(c("lang")), field(n_chars), field(c("text")))

    hit = (F.crc32(c("doc_id").cast("string").cast("binary")) % TAMPER == 0) & c("n_chars").isNotNull()
    return docs.select(F.coalesce(F.concat(F.lit("+"), c("lang")), F.lit("")).alias("tree"), "doc_id",
                       leaf(chars).alias("leaf"), F.when(hit, leaf(chars + 1)).alias("tampered"),
                       F.monotonically_increasing_id().alias("salt"))


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, the place within its tree by ``order``, and ``n``, the rows of the tree.

    A range sort numbers the rows of each partition; what stands before a partition is a sum over partitions. ``salt``
    splits rows that are equal otherwise.
    """
    keys = ["tree", *order, "salt"]
    cut = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "merkle-order")
    runs = cut.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    whole = Window.partitionBy("tree")
    before = F.sum("held").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = runs.select("tree", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("held").over(whole).alias("n"))
    return cut.join(placed, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop(
        "at", "part", "first", "before", "held", "salt")


def _level(rows: DataFrame, base: int) -> DataFrame:
    """The nodes of up to ``BLOCK`` levels above ``base``, each with its step, and the top digest of every block.

    ``rows``: tree, n, depth, pos, hash, body, one for each node at ``base``. A step row has ``seg``, a top row ``hash``.
    """
    grouped = rows.groupBy("tree", "depth", "n", F.shiftright("pos", BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "hash", "body"))).alias("found"))
    df = grouped.withColumn("up", F.least(F.lit(BLOCK), F.col("depth") - base).cast("int")).withColumn(
        "l0", F.col("found.hash"))
    for k in range(1, BLOCK + 1):
        pair = f"sha2(concat(get(l{k - 1}, 2 * i), coalesce(get(l{k - 1}, 2 * i + 1), '')), 256)"
        up = f"transform(sequence(0, (size(l{k - 1}) - 1) div 2), i -> {pair})"
        df = df.withColumn(f"l{k}", F.expr(f"CASE WHEN up >= {k} THEN {up} END"))
    side = "CASE WHEN i % 2 = 1 THEN 1 WHEN i + 1 < size(l{j}) THEN 2 ELSE 0 END"
    steps = []
    for j in range(BLOCK):
        sibling = f"coalesce(unhex(get(l{j}, i + CASE WHEN i % 2 = 1 THEN -1 ELSE 1 END)), unhex(repeat('00', 32)))"
        step = f"concat(unhex(lpad(hex({side.format(j=j)}), 2, '0')), {sibling})"
        lone = f"CASE WHEN up > {j} THEN {step} ELSE unhex('') END"
        body = "get(found.body, i)" if j == 0 else "CAST(NULL AS {body})"
        node = (f"named_struct('level', {base + j}, 'idx', shiftleft(block, {BLOCK - j}) + i, 'seg', {lone}, "
                f"'to', {base} + least({j + 1}, up), 'hash', CAST(NULL AS string), 'body', {body})")
        steps.append(f"CASE WHEN up > {j} OR ({j} = 0 AND {base} = 0) THEN transform(l{j}, (h, i) -> {node}) ELSE array() END")
    top = "named_struct('level', {base} + up, 'idx', block, 'seg', CAST(NULL AS binary), 'to', 0, 'hash', {hash}, 'body', CAST(NULL AS {body}))"
    last = "coalesce(" + ", ".join(f"get(l{k}, 0)" for k in range(BLOCK, -1, -1)) + ")"
    body_type = rows.schema["body"].dataType.simpleString()
    every = "flatten(array(" + ", ".join([*steps, f"array({top.format(base=base, hash=last, body='{body}')})"]) + "))"
    return df.select("tree", "depth", "n", F.explode(F.expr(every.replace("{body}", body_type))).alias("node")).select(
        "tree", "depth", "n", "node.*")


def grow(rows: DataFrame, deepest: int) -> tuple[list[DataFrame], DataFrame]:
    """(tables of nodes, (tree, n, hash) of every tree's top) over rows (tree, n, pos, hash, body)."""
    at = rows.withColumn("depth", F.when(F.col("n") <= 1, 0).otherwise(F.length(F.bin(F.col("n") - 1))))
    tables, tops, base = [], [], 0
    while base == 0 or base < deepest:
        table = stored(_level(at, base), f"merkle-level-{base}")
        tables.append(table)
        top = table.where("hash IS NOT NULL")
        tops.append(top.where("level = depth").select("tree", "n", "hash"))
        body = rows.schema["body"].dataType.simpleString()
        at = top.where("level < depth").select("tree", "n", "depth", F.col("idx").alias("pos"), "hash",
                                               F.lit(None).cast(body).alias("body"))
        base += BLOCK
    return tables, reduce(DataFrame.unionByName, tops)


def jump(tables: list[DataFrame], deepest: int) -> DataFrame:
    """(tree, n, pos, seg, body) of every leaf, ``seg`` the steps up to its tree's top.

    A round joins the nodes on multiples of twice the distance to their ancestors at that distance.
    """
    nodes = reduce(DataFrame.unionByName, tables).where("seg IS NOT NULL").drop("hash")
    written, distance = tables, 1
    while distance < deepest:
        far = nodes.where(f"level % {2 * distance} = {distance}").select(
            "tree", F.col("level").alias("at"), F.col("idx").alias("at_idx"), F.col("seg").alias("far_seg"), F.col("to").alias("far_to"))
        # who is at the top already has no ancestor to meet: a key of its own keeps such rows apart
        moving = nodes.where(f"level % {2 * distance} = 0").select(
            "*", F.when(F.col("to") < F.col("depth"), F.col("to")).otherwise(-1).alias("at"),
            F.when(F.col("to") < F.col("depth"), F.expr("shiftright(idx, CAST(to - level AS int))")).otherwise(
                F.col("idx")).alias("at_idx"))
        joined = moving.join(far, ["tree", "at", "at_idx"], "left").select(
            "tree", "depth", "n", "level", "idx", F.concat("seg", F.coalesce("far_seg", F.lit(b""))).alias("seg"),
            F.coalesce("far_to", "to").alias("to"), "body")
        nodes = stored(joined, f"merkle-jump-{distance}")
        for table in written:
            drop(table)  # its readers are written
        written, distance = [nodes], 2 * distance
    return nodes.where("level = 0").select("tree", "n", F.col("idx").alias("pos"), "seg", "body")


def _deepest(n: int) -> int:
    return max(0, n - 1).bit_length()


def fold(start: Column, steps: Column) -> Column:
    """The digest that ``start`` reaches over ``steps`` (side, sibling in hex)."""
    def up(acc: Column, s: Column) -> Column:
        return digest(F.when(s["side"] == 1, s["sibling"]).otherwise(""), acc, F.when(s["side"] == 2, s["sibling"]).otherwise(""))

    return F.aggregate(steps, start, up)


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang",
             chars_col: str = "n_chars", text_col: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof (its siblings' hex digests in order), proof_sha256, folded_root, verified.

    One row for each row of ``docs``. Nulls are ``-`` in a leaf and a null id comes first in its language; a null
    language is a tree of its own, before the empty one. Rows of one id are ordered by their leaf, and rows that are
    equal throughout each get a leaf, whichever comes first. A null n_chars can't be tampered with. An empty table
    has no root and gives no rows; other columns of ``docs`` don't count.
    """
    held = stored(leaves(narrow(docs, doc_id=id_col, source=source_col, lang=lang_col, n_chars=chars_col, text=text_col)),
                  "merkle-leaves")
    body = F.struct(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "tampered")
    placed = positions(held, "doc_id", "leaf").select("tree", "n", "pos", F.col("leaf").alias("hash"), body.alias("body"))
    deepest = _deepest(placed.agg(F.max("n")).first()[0] or 0)
    tables, subroots = grow(placed, deepest)
    drop(held)
    # the subroots, ordered by language, are the leaves of the upper tree
    tops = stored(subroots.select("tree", "n", "hash"), "merkle-subroots")
    langs = positions(tops.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "n", "hash", F.lit(0).alias("salt"))
                      .withColumnRenamed("n", "rows"), "lang")
    upper = langs.select("tree", "n", "pos", "hash", F.struct("lang", "hash", "rows").alias("body"))
    highest = _deepest(tops.count())
    upper_tables, roots = grow(upper, highest)
    root = roots.first()
    low = jump(tables, deepest)
    high = jump(upper_tables, highest)
    # one copy of a language's way to the root for every 2^16 of its rows: no join key holds more
    way = high.select(F.col("body.lang").alias("tree"), F.col("body.hash").alias("subroot"), F.col("seg").alias("high_seg"),
                      F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("body.rows") - 1, TOP_BLOCK))).alias("block"))
    whole = low.withColumn("block", F.shiftright("pos", TOP_BLOCK)).join(way, ["tree", "block"]).select(
        "body.*", "subroot", F.lit(root["hash"] if root else None).cast("string").alias("root"), F.concat("seg", "high_seg").alias("seg"))
    steps = F.expr(f"transform(CASE WHEN octet_length(seg) = 0 THEN array() ELSE sequence(0, octet_length(seg) div {STEP} - 1) END, "
                   f"i -> named_struct('side', CAST(hex(substring(seg, {STEP} * i + 1, 1)) AS int), "
                   f"'sibling', lower(hex(substring(seg, {STEP} * i + 2, {STEP - 1})))))")
    told = whole.withColumn("steps", steps).withColumn("proof", F.expr("transform(filter(steps, s -> s.side > 0), s -> s.sibling)"))
    return told.select("doc_id", "leaf", "subroot", "root", "proof", digest(F.array_join("proof", "")).alias("proof_sha256"),
                       fold(F.coalesce("tampered", "leaf"), F.col("steps")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents")).drop("proof")


def _oracle() -> str:
    def value(column: str) -> str:
        text = f"CAST({column} AS varchar)"
        return f"coalesce(concat(strlen({text}), ':', {text}), '-')"

    def leaf(chars: str) -> str:
        return f"sha256(concat({', '.join(value(c) for c in ('doc_id', 'source', 'lang', chars, 'text'))}))"

    pairs = "list_transform(range(0, (len(arr) + 1) // 2), lambda i: sha256(concat(arr[2 * i + 1], coalesce(arr[2 * i + 2], ''))))"
    bit = "CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    return f"""
WITH RECURSIVE held AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
         CASE WHEN n_chars IS NOT NULL THEN {leaf("n_chars + 1")} END AS other,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
           string_split(CAST(doc_id AS varchar), ''), lambda d: [ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, b: {bit})) % 7 = 0 AS hit
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM held
), low AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS arr FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, {pairs} FROM low WHERE len(arr) > 1
), subroots AS (
  SELECT lang, arr[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM low WHERE len(arr) = 1
), high AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS arr FROM subroots
  UNION ALL
  SELECT level + 1, {pairs} FROM high WHERE len(arr) > 1
), root AS (
  SELECT arr[1] AS root FROM high WHERE len(arr) = 1
), steps AS (
  SELECT p.lang, p.pos, w.level, (p.pos >> w.level) % 2 AS is_right, w.arr[xor(p.pos >> w.level, 1) + 1] AS sibling
  FROM placed p JOIN low w ON w.lang IS NOT DISTINCT FROM p.lang AND len(w.arr) > 1
  UNION ALL
  SELECT p.lang, p.pos, 1000 + w.level, (s.place >> w.level) % 2, w.arr[xor(s.place >> w.level, 1) + 1]
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN high w ON len(w.arr) > 1
), ways AS (
  SELECT lang, pos, list({{'is_right': is_right, 'sibling': sibling}} ORDER BY level) AS way,
         sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256
  FROM steps GROUP BY lang, pos
), folding AS (
  SELECT p.doc_id, p.leaf, p.lang, coalesce(w.way, []) AS way, coalesce(w.proof_sha256, sha256('')) AS proof_sha256,
         CASE WHEN hit AND other IS NOT NULL THEN other ELSE p.leaf END AS h, 0 AS k
  FROM placed p LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM p.lang AND w.pos = p.pos
  UNION ALL
  SELECT doc_id, leaf, lang, way, proof_sha256,
         CASE WHEN way[k + 1].is_right = 1 THEN sha256(concat(way[k + 1].sibling, h))
              ELSE sha256(concat(h, coalesce(way[k + 1].sibling, ''))) END, k + 1
  FROM folding WHERE k < len(way)
)
SELECT f.doc_id, f.leaf, s.subroot, r.root, f.proof_sha256, f.h AS folded_root, f.h = r.root AS verified
FROM folding f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang CROSS JOIN root r
WHERE f.k = len(f.way)
"""


ORACLE = _oracle()
