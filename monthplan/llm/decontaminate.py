"""Benchmark decontamination: a prefix-filtered join of benchmark windows with every position of every document.

A window is ten consecutive words of an item, or all words of a shorter one. Its tokens are its shingles of up to four
words, ordered by how often the documents hold them. A window occurs only where all of its tokens do, so one token is a
necessary prefix: the rarest. Document positions are joined on that token alone; the token's offset says where the
window would have to begin and end, which has to lie inside the document (positional and length bound); the words in
between are then compared by their sha256. A window with a token that no document holds is dropped beforehand.

DataFrame functions only. The windows are the stated query set: they are broadcast in blocks of at most
``BLOCK_ROWS`` rows of fixed size, so documents are never shuffled, and only documents' counts and hits are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import drop, narrow, read_table, stored

WINDOW = 10  # words of a window
SHINGLE = 4  # words of a token; a shorter window is one token
BLOCK_ROWS = 250_000  # windows or tokens broadcast at once: about 110 bytes a window, 27 MB
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The text's words, A-Z lower-cased and nothing else; none for null."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ascii_only = F.octet_length(text) == F.char_length(text)  # there, lower() does the same and much faster
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, lower))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def token(all_words: Column, at: Column, width: int) -> Column:
    """Hash of the ``width`` words from place ``at``."""
    return F.xxhash64(F.lit(width), *[F.get(all_words, at + j) for j in range(width)])


def _tokens(at: Column, widths: list[int]) -> Column:
    """Tokens of every width that begin at ``at`` and end inside the text, one row each."""
    each = [F.when(at + w <= F.col("n_words"), token(F.col("words"), at, w)) for w in widths]
    return each[0] if len(each) == 1 else F.explode(F.array(*each))


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """((digest, n_words, off, width, token) of every token of every distinct window, (digest, item) pairs)."""
    listed = items.select("item_id", words(F.col("text")).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    windows = listed.select("item_id", "words", F.least("n", F.lit(window)).alias("n_words"), F.explode(
        F.sequence(F.lit(1), F.greatest(F.col("n") - (window - 1), F.lit(1)))).alias("from"))
    windows = windows.select("item_id", F.slice("words", F.col("from"), F.col("n_words")).alias("words"), "n_words")
    windows = windows.withColumn("digest", F.sha2(F.array_join("words", " ").cast("binary"), 256))
    named = windows.where("item_id IS NOT NULL").select("digest", F.col("item_id").cast("string").alias("item")).distinct()
    one = windows.groupBy("digest").agg(F.first("words").alias("words"), F.first("n_words").alias("n_words"))
    one = one.withColumn("width", F.least("n_words", F.lit(shingle)))
    placed = one.select("*", F.explode(F.sequence(F.lit(0), F.col("n_words") - F.col("width"))).alias("off"))
    key = reduce(lambda other, w: F.when(F.col("width") == w, token(F.col("words"), F.col("off"), w)).otherwise(other),
                 range(1, shingle + 1), F.lit(None).cast("long"))
    return placed.select("digest", "n_words", "off", "width", key.alias("token")), named


def _blocks(df: DataFrame, key: str, block_rows: int) -> list[DataFrame]:
    """``df`` in parts of about ``block_rows`` rows by key, each to be broadcast."""
    parts = max(1, -(-df.count() // block_rows))
    return [df] if parts == 1 else [df.where(F.pmod(F.xxhash64(F.lit("block"), key), F.lit(parts)) == p) for p in range(parts)]


def frequencies(docs: DataFrame, tokens: DataFrame, widths: list[int], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(token, seen): how often the documents hold each of ``tokens`` (distinct); none that they don't hold."""
    at = F.explode(F.when(F.col("n_words") > 0, F.sequence(F.lit(0), F.col("n_words") - 1)))
    every = docs.select("words", "n_words", at.alias("at")).select(_tokens(F.col("at"), widths).alias("token"))
    met = [every.join(F.broadcast(part), "token") for part in _blocks(tokens, "token", block_rows)]
    return reduce(DataFrame.unionByName, met).groupBy("token").agg(F.count("*").alias("seen"))


def prefixes(tokens: DataFrame, seen: DataFrame) -> DataFrame:
    """(token, digest, size, off): the rarest token of each window that can occur at all."""
    ranked = F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token", "off")
    best = tokens.join(seen, "token", "left").groupBy("digest").agg(F.first("n_words").alias("size"), F.min(ranked).alias("best"))
    return best.where("best.seen > 0").select("best.token", "digest", "size", "best.off")


def occurrences(docs: DataFrame, prefix: DataFrame, widths: list[int]) -> DataFrame:
    """(row, doc_id, n_words, start, size, digest) of every occurrence, and one row without a digest for each document.

    ``docs``: row, doc_id, words, n_words. The place after the last word stands for the document itself.
    """
    itself = F.col("at") == F.col("n_words")
    stand_in = prefix.sparkSession.range(1).select(F.lit(None).cast("long").alias("token"), F.lit(None).cast("string").alias("digest"),
                                                   F.lit(None).cast("int").alias("size"), F.lit(None).cast("int").alias("off"))
    listed = prefix.select("token", "digest", "size", "off").unionByName(stand_in)
    placed = docs.select("*", F.explode(F.sequence(F.lit(0), F.col("n_words"))).alias("at"))
    tokens = placed.select("*", _tokens(F.col("at"), widths).alias("token")).where(F.col("token").isNotNull() | itself)
    # no text token is null: the stand-in row has the key 0, and so have the documents themselves
    met = tokens.withColumn("key", F.when(itself, F.lit(0)).otherwise(F.col("token"))).drop("token").join(
        F.broadcast(listed.withColumn("key", F.coalesce("token", F.lit(0))).drop("token")), "key")
    start = F.col("at") - F.col("off")
    inside = (start >= 0) & (start + F.col("size") <= F.col("n_words")) & ~itself
    same = F.sha2(F.array_join(F.slice("words", start + 1, F.col("size")), " ").cast("binary"), 256) == F.col("digest")
    return met.where(F.when(F.col("digest").isNull(), itself).when(inside, same).otherwise(F.lit(False))).select(
        "row", "doc_id", "n_words", start.alias("start"), "size", "digest")


def covered(spans: Column) -> Column:
    """Words in the union of sorted (start, size) spans."""
    nothing = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["size"]
        return F.struct(F.greatest(acc["upto"], end).alias("upto"),
                        (acc["n"] + F.greatest(end - F.greatest(acc["upto"], s["start"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, nothing, add, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_words, n_hit, spans (start, size), items (sorted texts), n_items, contaminated: one row for each row of ``docs``.

    Null texts have no words, and items without words no window. Repeated ids, null ids and equal texts each keep their
    row. Items of one id count once; an item without an id hits words but is not counted or named. Without items, or without
    documents, nothing is hit or no row comes. Other columns don't count.
    """
    asked = narrow(items, item_id=item_col, text=item_text_col)
    tokens, named = item_windows(asked, window, shingle)
    tokens, named = stored(tokens, "decontaminate-tokens"), stored(named, "decontaminate-items")
    widths = sorted(r[0] for r in tokens.select("width").distinct().collect()) or [shingle]  # at most ``shingle`` of them
    text = narrow(docs, doc_id=id_col, text=text_col)
    split = text.select("doc_id", words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    seen = frequencies(split, tokens.select("token").distinct(), widths, block_rows)
    prefix = stored(prefixes(tokens, seen), "decontaminate-prefixes")
    drop(tokens)
    parts = _blocks(prefix, "digest", block_rows)
    numbered = text.withColumn("row", F.monotonically_increasing_id())
    if len(parts) > 1:
        numbered = stored(numbered, "decontaminate-documents")  # read once a block: the numbers have to stay
    read = numbered.select("row", "doc_id", words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    met = reduce(DataFrame.unionByName, [occurrences(read, part, widths) for part in parts])
    span = F.when(F.col("digest").isNotNull(), F.struct("start", "size"))
    judged = stored(met.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"), F.collect_set("digest").alias("digests"),
    ).withColumn("n_hit", covered(F.col("spans"))), "decontaminate-documents")
    by_row = judged.select("row", F.explode("digests").alias("digest")).join(named, "digest").groupBy("row").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return judged.join(by_row, "row", "left").select(
        "doc_id", F.col("n_words").cast("long"), F.col("n_hit").cast("long"), "spans", F.coalesce("items", none).alias("items"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def _oracle() -> str:
    def split(table: str, key: str) -> str:
        low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"SELECT {key}, coalesce(regexp_extract_all({low}, '{WORD}'), []) AS w FROM {table}"

    return rf"""
WITH item AS ({split("benchmark", "item_id")}), doc AS ({split("documents", "doc_id")}),
item_window AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p + 1:p + size], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS size, unnest(range(0, greatest(len(w) - {WINDOW - 1}, 1))) AS p
        FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_window),
place AS (
  SELECT doc_id, size, p, array_to_string(w[p + 1:p + size], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS p FROM doc, sizes WHERE len(w) >= size)
), hit AS (
  SELECT doc_id, p, size, item_id FROM place JOIN item_window USING (size, win)
), hit_words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS pos FROM (SELECT DISTINCT doc_id, p, size FROM hit)) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS varchar) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


ORACLE = _oracle()
