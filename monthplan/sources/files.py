"""Folders and small files through the cluster's file system: what a commit by rename and a ledger need."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a name that is free; its parent folder is made."""
    fs, old = _at(spark, source)
    new = _at(spark, target)[1]
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"can't rename {source} to {target}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it isn't there."""
    fs, where = _at(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, where = _at(spark, staged)
    stream = fs.create(where)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename(spark, staged, path)
