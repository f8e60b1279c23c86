"""Toxicity scoring of whole texts by the network of ``toxicity_model``: train on a bounded sample, score everything."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import carried_schema, id_text, read_table, ship_package, text_pieces
from .toxicity_model import Network, train

SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3000  # labelled documents a model is fitted on, at most, by the order of a hash
SAMPLE_CHARS = 200_000  # of a training text only: longer labelled texts are left out of the sample, never cut
CUT = 0.3


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2: labels of these rows are not learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2


def fit(texts: DataFrame, labels: DataFrame) -> bytes:
    """The model, from (doc_id, text) and the labelled ids (doc_id, toxic 0/1) that may be learned from.

    The sample is bounded, so one task can hold it and train; only the parameters (about 4 MB) reach the driver.
    """
    counts = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    order = [F.xxhash64("doc_id", F.lit("sample")), "doc_id"]
    chosen = labels.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).unionByName(
        labels.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
    sample = (texts.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if rows:
            all_rows = pd.concat(rows).sort_values("doc_id")
            net = train(all_rows["text"].tolist(), all_rows["toxic"].to_numpy(), share)
            yield pd.DataFrame({"model": [net.dump()]})

    found = sample.repartition(1).mapInPandas(learn, "model binary").collect()
    return bytes(found[0]["model"]) if found else train([], np.zeros(0), 0.0).dump()


def score(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
          carry: Sequence[str] | None = None) -> DataFrame:
    """doc_id, score, predicted: one row for each row of ``docs``; with ``carry`` also text and those columns.

    All overlapping windows of the whole text are scored and the highest decides. Null, empty and wordless texts get
    the score of no evidence; null ids and repeated rows pass through.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.load(shared.value)
        for piece in text_pieces(batches):
            s = net.scores(piece.column(1).to_pylist())
            columns = [piece.column(0), pa.array(s, pa.float64()), pa.array(s >= CUT).cast(pa.int32()), *piece.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns[:len(names)], names=names)

    names = ["doc_id", "score", "predicted"] + (["text", *carry] if carry is not None else [])
    schema = "doc_id long, score double, predicted int"
    if carry is not None:
        schema += ", text string" + carried_schema(docs, carry)
    return id_text(docs, id_col, text_col, carry or ()).mapInArrow(run, schema)


def learnable(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(doc_id, toxic) of the rows outside the held-out remainder, one an id (the higher label), nulls left out."""
    rows = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    rows = rows.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out("doc_id"))
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def fitted(spark: SparkSession, sf_dir: str) -> bytes:
    """The model of the given tables: labels, and the documents they belong to."""
    return fit(id_text(read_table(spark, sf_dir, "documents"), "doc_id", "text"), learnable(read_table(spark, sf_dir, "labels")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(read_table(spark, sf_dir, "documents"), fitted(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")
