"""Small helpers shared by the operators: narrow inputs and Arrow batches cut into bounded pieces."""

from __future__ import annotations

import gc
import io
import os
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthplan.session import ensure_checkpoint_dir, scratch_table


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, through the shared folder and once a context, so that they can import it."""
    context = spark.sparkContext
    if getattr(context, "_monthplan_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = f"{scratch_table(spark, 'package')}/monthplan.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    context.addPyFile(path)
    context._monthplan_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; whatever else the table holds can't clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def id_text(df: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id long, text string), a null text read as the empty text, then the columns to carry along."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *[F.col(f"`{c}`") for c in carry])


def carried_schema(df: DataFrame, carry: Sequence[str]) -> str:
    """The carried columns' part of a schema, after what an operator adds."""
    return "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in carry)


def text_pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose texts hold about ``max_bytes`` (one row at least).

    Only how many texts a worker expands at once is bounded here; every row comes out, whole.
    """
    for batch in batches:
        size = max(1, batch.column(batch.schema.get_field_index(column)).nbytes)
        step = max(1, int(batch.num_rows * max_bytes / size))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder, so a lost executor can't take it along."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing reads any more.

    It does so once the driver has collected its garbage, which a driver that only waits for small jobs may put off until
    the files of many rounds have piled up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same through a parquet table in the shared checkpoint folder: smaller than a checkpoint of rows."""
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files that a stored table is read from; nothing may read it any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
