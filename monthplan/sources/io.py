"""Sources and sinks: remote reads with push-down, parquet tables + views, slice copies, batch-scoped replace.

Connection details always arrive as arguments (never from code); nothing here opens a connection by itself.
"""

from __future__ import annotations

import bisect
import datetime as _dt
import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthplan.sources import files


PARTITION_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(options: dict | None = None, query: str | None = None, table: str | None = None) -> dict[str, str]:
    """The options of a JDBC read of a statement or a table.

    Spark doesn't split a ``query`` read, so with ``partitionColumn`` the statement is given as a derived table.
    """
    if (query is None) == (table is None):
        raise ValueError("jdbc read needs either query= or table=")
    out = {k: str(v) for k, v in (options or {}).items()}
    given = [k for k in PARTITION_OPTIONS if k in out]
    if "partitionColumn" in out and len(given) < len(PARTITION_OPTIONS):
        raise ValueError(f"a split read needs all of {PARTITION_OPTIONS}")
    if table is not None:
        return {**out, "dbtable": table}
    if "partitionColumn" in out:
        return {**out, "dbtable": f"({query.strip().rstrip(';')}) q"}
    return {**out, "query": query}


def read_source(spark: SparkSession, fmt: str, *, path: str | None = None, options: dict | None = None,
                query: str | None = None, table: str | None = None, columns: Sequence[str] | None = None,
                predicate: Column | str | None = None) -> DataFrame:
    """Read a source table with the column list and filter pushed into the scan.

    * ``fmt="jdbc"``: ``options`` carry ``url``, ``user``, ``password``, ``driver``...; either ``query`` (a whole
      statement shipped to the database, like a remote query) or ``table`` (an attached table, ``schema.table``).
      Spark's JDBC source pushes ``columns`` and ``predicate`` into the generated SQL and can split the read over
      ``partitionColumn`` / ``lowerBound`` / ``upperBound`` / ``numPartitions`` options.
    * any file format (``parquet``, ``orc``, ...): ``path``; the predicate becomes parquet ``PushedFilters`` and the
      column list the ``ReadSchema``.
    """
    if fmt == "jdbc":
        df = spark.read.format(fmt).options(**jdbc_options(options, query, table)).load()
    else:
        if path is None:
            raise ValueError(f"{fmt} read needs path=")
        df = spark.read.format(fmt).options(**(options or {})).load(path)
    if columns is not None:
        df = df.select(*columns)
    if predicate is not None:
        df = df.where(predicate)
    return df


def write_parquet_view(df: DataFrame, path: str, view: str, partition_by: Sequence[str] = (),
                       mode: str = "overwrite", cluster_by: Sequence[str] = (), row_group_bytes: int | None = None) -> DataFrame:
    """A17 + A18: write ``df`` as a parquet table, expose it as a temp view, and return the view's DataFrame.

    Later queries read the files (column pruning, push-down, partition pruning on ``partition_by``), not the
    lineage that produced them. With ``cluster_by`` the rows are range-partitioned and sorted by those columns, so a
    filter on them finds its rows in few files and row groups (of about ``row_group_bytes``) and skips the others by
    their statistics. A key that many rows hold may fill several files: the range is cut by a hash of the row as well.
    """
    if cluster_by:
        spread = F.xxhash64(*[c for c in df.columns if not _is_map(df, c)]) if df.columns else F.lit(0)
        df = df.repartitionByRange(*partition_by, *cluster_by, spread).sortWithinPartitions(*partition_by, *cluster_by)
    w = df.write.mode(mode)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    spark = df.sparkSession
    spark.read.parquet(path).createOrReplaceTempView(view)
    return spark.table(view)


def _is_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()


def copy_slice(src: DataFrame, dst_path: str, predicate: Column | str, partition_by: Sequence[str] = (),
               mode: str = "replace", slice_id: str | None = None) -> int:
    """Copy the rows of ``src`` matching ``predicate`` to ``dst_path``; returns how many.

    The predicate is applied to the source DataFrame, so it reaches the source scan (parquet row groups / JDBC
    ``WHERE``); executors stream their partitions straight to the target files -- nothing passes the driver, and the
    count is observed while they are written. The target is partitioned by ``slice_id`` first (by default a digest of the
    predicate's text): copying a slice again replaces it, also after a copy that failed half-way. Slices that overlap
    each keep their rows. With ``mode="append"`` rows are only added; with ``mode="overwrite"`` and ``partition_by`` the
    partitions the slice touches are replaced.
    """
    seen = Observation()
    rows = src.where(predicate).observe(seen, F.count(F.lit(1)).alias("rows"))
    if mode == "replace":
        name = slice_id or hashlib.sha256(str(predicate).encode()).hexdigest()[:16]
        replace_folder(rows, dst_path, f"slice_id={name}", partition_by)
    else:
        w = rows.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
            if mode == "overwrite":
                w = w.option("partitionOverwriteMode", "dynamic")
        w.parquet(dst_path)
    return seen.get["rows"]


def replace_folder(rows: DataFrame, table: str, part: str, partition_by: Sequence[str] = ()) -> None:
    """Make ``rows`` the contents of the folder ``part`` (``column=value``) of a table: written beside it, then renamed.

    ``rows`` may be read from the folder itself. A write that fails leaves the old contents; between the two renames
    they stand beside the table, and the next replace of that folder puts them back first. Readers don't see the names
    used meanwhile. On a store without atomic renames the two steps are copies, in the same order.
    """
    spark, table = rows.sparkSession, table.rstrip("/")
    target = f"{table}/{part}"
    old = f"{table}/_old-{part.replace('=', '-')}"
    staged = f"{table}/_staged-{uuid.uuid4().hex}"
    if files.exists(spark, old):  # an earlier replace ended between its renames, or before it cleaned up
        files.delete(spark, old) if files.exists(spark, target) else files.rename(spark, old, target)
    try:
        w = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        w.parquet(staged)
        if files.exists(spark, target):
            files.rename(spark, target, old)
        try:
            files.rename(spark, staged, target)
        except Exception:
            if files.exists(spark, old):
                files.rename(spark, old, target)
            raise
    except Exception:
        files.delete(spark, staged)
        raise
    files.delete(spark, old)


def overwrite_batch(df: DataFrame, path: str, batch_id: int, batch_col: str = "batch_id") -> None:
    """Replace the rows of one batch by those of ``df`` and keep every other batch.

    The table is partitioned by ``batch_col`` and the batch's folder is replaced, so a re-plan without rows leaves
    the batch empty (delete, then insert) instead of keeping the last run's. ``df`` may be read from the table itself,
    and a failed write keeps the old batch (see ``replace_folder``).
    """
    rows = df.where(F.col(batch_col) == F.lit(batch_id)).drop(batch_col) if batch_col in df.columns else df
    replace_folder(rows, path, f"{batch_col}={batch_id}")


def split_bounds(sample: Sequence, parts: int) -> list:
    """Values that cut ``sample`` into about ``parts`` runs of equal length.

    Rows of one value can't be parted. A value that fills more than a part is a bound, and so is the next larger one: its
    part holds nothing else.
    """
    held = sorted(v for v in sample if v is not None)
    if not held or parts <= 1:
        return []
    share = len(held) // parts
    bounds = set()
    for c in {held[len(held) * i // parts] for i in range(1, parts)}:
        lo, hi = bisect.bisect_left(held, c), bisect.bisect_right(held, c)
        if lo:
            bounds.add(c)
        if hi - lo > share and hi < len(held):
            bounds.add(held[hi])
    return sorted(bounds)


def split_predicates(column: str, bounds: Sequence) -> list[str]:
    """SQL predicates over ``column``, one a part: every row, also one with a null, fits exactly one of them."""
    def text(v) -> str:
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return str(v)
        kind = "TIMESTAMP " if isinstance(v, _dt.datetime) else "DATE " if isinstance(v, _dt.date) else ""
        return kind + "'" + str(v).replace("'", "''") + "'"

    cuts = [text(b) for b in sorted(set(bounds))]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *inner, f"{column} >= {cuts[-1]}"]


def plan_split(source: DataFrame, column: str, parts: int, sample_rows: int = 20_000) -> list[str]:
    """Predicates for a read in ``parts`` parts of about equal size, from a bounded sample of the key.

    The sample is drawn at a rate that the row count sets. It only places the bounds: the predicates cover every row,
    whatever it holds.
    """
    rows = source.count()
    rate = min(1.0, 1.2 * sample_rows / max(rows, 1))
    drawn = source.select(column).sample(False, rate, seed=7).limit(2 * sample_rows).toPandas()[column].tolist()
    return split_predicates(column, split_bounds([v for v in drawn if v == v and v is not None], parts))


def read_split(spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: dict | None = None) -> DataFrame:
    """A table read over one connection for each predicate of ``plan_split``."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties={k: str(v) for k, v in (properties or {}).items()})
