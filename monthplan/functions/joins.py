"""Joins of tables that grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame

BROADCAST_ROWS = 1_000_000  # of two or three numbers each: about 50 MB in the driver


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that is never broadcast.

    Without it Spark may broadcast a table by the size of its files, and compressed codes take a hundred times that in the
    driver.
    """
    return df.hint("merge")


def counted(df: DataFrame) -> DataFrame:
    """``df`` as a join side that Spark may broadcast while it has at most ``BROADCAST_ROWS`` rows, by count and not by files."""
    return df if df.count() <= BROADCAST_ROWS else shuffled(df)
