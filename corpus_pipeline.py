"""The training-data pipeline over ``documents``: each stage works on all that the one before it kept.

toxicity drops the documents it rejects; near-dedup keeps one document of each group; repeats takes out bytes that stand
earlier in the corpus already; secrets masks what the scan finds; packing gives the pieces of the training windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthplan.llm import circulant_minhash, packing, radix_dedup, secret_scan, toxicity
from monthplan.llm.tables import drop, read_table, ship_package, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut; the model learns from the given labels and documents."""
    ship_package(spark)
    scored = toxicity.score(docs, toxicity.fitted(spark, sf_dir), carry=[c for c in COLUMNS if c not in ("doc_id", "text")])
    return _documents(scored.where("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near duplicates, and every document that is like no other."""
    ship_package(spark)
    gone = circulant_minhash.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return _documents(docs.join(gone, "doc_id", "left_anti"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a window standing earlier covers; a cut character becomes a replacement mark.

    A document of which nothing is left goes.
    """
    ship_package(spark)
    left = radix_dedup.remove_repeats(docs, carry=[c for c in COLUMNS if c not in ("doc_id", "text")])
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return _documents(left.where("NOT (n_removed > 0 AND n_removed = n_bytes)").withColumn("text", text))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every found span replaced by a marker; all documents stay."""
    ship_package(spark)
    scanned = secret_scan.scan_secrets(docs, carry=[c for c in COLUMNS if c not in ("doc_id", "text")])
    return _documents(scanned.withColumnRenamed("masked", "text"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the windows, with their place in document and window."""
    import public_tokenizers

    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]
ORACLE_SQL = None  # a trained model, LSH and tokenizers have no SQL form; tests hold the stages against plain loops


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop(before)  # its one reader is written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
