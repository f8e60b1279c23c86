"""Tables bucketed by one key under a run's folder, with a ledger of those that are whole.

A table enters the ledger after its files are written. A run that starts again over the same folder registers the tables
in the ledger as they are and builds only the others, whatever half-written files they left.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from monthplan.sources import files


class BucketStore:
    """``table`` writes a step once; ``forget`` takes the catalog entries away (the tables are external, files stay)."""

    def __init__(self, spark: SparkSession, folder: str, key: Sequence[str], buckets: int, tag: str | None = None):
        self.spark, self.folder, self.key, self.buckets = spark, folder.rstrip("/"), list(key), buckets
        self.tag = f"{tag or 'run'}_{uuid.uuid4().hex}"
        self.tables: dict[str, str] = {}

    def _entry(self, step: str) -> str:
        return f"{self.folder}/ledger/{step}.json"

    def finished(self) -> list[str]:
        return [n.removesuffix(".json") for n in files.names(self.spark, f"{self.folder}/ledger") if n.endswith(".json")]

    def agree(self, **facts: object) -> None:
        """Note what a run is made of; a run that was begun with something else can't be taken up."""
        facts = json.loads(json.dumps({**facts, "key": self.key, "buckets": self.buckets}, default=str))
        path = f"{self.folder}/run.json"
        if not files.exists(self.spark, path):
            files.write_text(self.spark, path, json.dumps(facts))
        elif (begun := json.loads(files.read_text(self.spark, path))) != facts:
            raise ValueError(f"{self.folder} was begun with {begun}, not {facts}")

    def path(self, step: str) -> str:
        return f"{self.folder}/{step}"

    def table(self, step: str, build: Callable[[], DataFrame], path: str | None = None, partition_by: Sequence[str] = (),
              spread: bool = False) -> DataFrame:
        """The step's table; ``spread`` moves the rows to their buckets, else they have to be there already."""
        name = f"monthplan_{self.tag}_{re.sub('[^0-9a-z]', '_', step.lower())}"
        path = path or self.path(step)
        self.tables[step] = name
        if files.exists(self.spark, self._entry(step)):
            self._register(name, json.loads(files.read_text(self.spark, self._entry(step))))
            return self.spark.table(name)
        files.delete(self.spark, path)
        rows = build()
        if spread:
            rows = rows.repartition(self.buckets, *self.key)
        writer = rows.write.option("path", path).bucketBy(self.buckets, *self.key).sortBy(*self.key)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
        entry = {"schema": rows.schema.jsonValue(), "path": path, "partition_by": list(partition_by)}
        files.write_text(self.spark, self._entry(step), json.dumps(entry))
        return self.spark.table(name)

    def _register(self, name: str, entry: dict) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(entry["schema"]))
        key = ", ".join(f"`{c}`" for c in self.key)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in entry['partition_by'])})" if entry["partition_by"] else ""
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} CLUSTERED BY ({key}) SORTED BY ({key}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{entry['path']}'")
        if entry["partition_by"]:
            self.recover(name)

    def recover(self, name: str) -> None:
        """Let a partitioned table see the folders that were written below it."""
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(name)

    def forget(self, *keep: str) -> None:
        for step in [s for s in self.tables if s not in keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(step)}")


def release(spark: SparkSession, tag: str) -> None:
    """Take the catalog entries of a tag's tables away; DataFrames over them can't be read any more."""
    for t in spark.catalog.listTables(pattern=f"monthplan_{tag}_*"):
        if not t.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
