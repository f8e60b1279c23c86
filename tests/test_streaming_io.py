"""Sources, sinks and the landing trigger."""

import pytest
from pyspark.sql import functions as F

from monthplan.session import scratch_table
from monthplan.plans.inputs import Plan
from monthplan.sources import files
from monthplan.sources import io as sio
from monthplan.sources import loaders as ld
from monthplan.sources.io import jdbc_options, copy_slice, overwrite_batch, read_source
from monthplan.streaming import plan_landed_batches

import datetime as _dt

from conftest import SMALL

J_DATE = _dt.date(1997, 1, 1)


def test_read_source_pushes_filter_and_columns(spark):
    df = read_source(spark, "parquet", path=f"{SMALL}/lineitem.parquet", columns=["l_partkey", "l_quantity"],
                     predicate=F.col("l_quantity") > 40)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_overwrite_batch_keeps_other_batches(spark):
    path = scratch_table(spark, "t_batches")
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "batch_id int, k string, v int")
    overwrite_batch(a, path, 1)
    overwrite_batch(a, path, 2)
    overwrite_batch(spark.createDataFrame([(1, "z", 9)], "batch_id int, k string, v int"), path, 1)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("batch_id", "k", "v").collect())
    assert got == [(1, "z", 9), (2, "y", 2)]
    overwrite_batch(a.limit(0), path, 1)  # a plan without rows leaves its batch empty
    assert [tuple(r) for r in spark.read.parquet(path).select("batch_id", "k", "v").collect()] == [(2, "y", 2)]


def test_jdbc_options():
    split = {"url": "jdbc:x", "partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    assert jdbc_options({"url": "jdbc:x"}, query="select 1") == {"url": "jdbc:x", "query": "select 1"}
    assert jdbc_options(split, query="select * from t;")["dbtable"] == "(select * from t) q"
    assert jdbc_options(split, table="s.t")["dbtable"] == "s.t"
    for bad in ({}, {"query": "q", "table": "t"}):
        with pytest.raises(ValueError):
            jdbc_options({}, **bad)
    with pytest.raises(ValueError):
        jdbc_options({"partitionColumn": "id"}, table="t")


def test_copy_slice_replaces_only_touched_partitions(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "d int, v string")
    dst = scratch_table(spark, "t_slice")
    copy_slice(src, dst, F.col("d") == 1, partition_by=["d"], mode="overwrite")
    copy_slice(src, dst, F.col("d") == 2, partition_by=["d"], mode="overwrite")
    copy_slice(src, dst, F.col("d") == 2, partition_by=["d"], mode="overwrite")
    assert sorted(tuple(r) for r in spark.read.parquet(dst).select("d", "v").collect()) == [(1, "a"), (2, "b"), (2, "c")]


def test_landing_trigger_plans_each_batch_once(spark):
    landing = scratch_table(spark, "t_landing")
    raw = Plan(spark, SMALL).raw("demand_raw")
    raw.where("batch_id = 15").write.parquet(landing)
    seen = []
    q = plan_landed_batches(spark, landing, raw.schema, seen.append, checkpoint=landing + "-ckpt")
    q.awaitTermination(120)
    raw.where("batch_id = 16").write.mode("append").parquet(landing)
    q = plan_landed_batches(spark, landing, raw.schema, seen.append, checkpoint=landing + "-ckpt")
    q.awaitTermination(120)
    assert seen == [15, 16]


def test_write_results_replaces_only_its_batch(spark):
    from monthplan.plans.results import result_tables, write_results

    plan = Plan(spark, SMALL, materialize=True)
    out = scratch_table(spark, "t_results")
    paths = write_results(plan, out)
    write_results(plan, out)  # a re-run of the batch replaces it
    other = spark.createDataFrame([(2, "F99", "x", J_DATE, 1.0, 2.0)],
                                  "batch_id int, factory_code string, linetype string, dt date, qty_surplus double, "
                                  "qty_shortage double")
    from monthplan.sources.io import overwrite_batch

    overwrite_batch(other, paths["capacity_gap"], 2)  # another batch lands in the same table
    expected = {name: df.count() for name, df in result_tables(plan).items()}
    for name, path in paths.items():
        got = spark.read.parquet(path)
        assert got.where(f"batch_id = {plan.batch_id}").count() == expected[name], name
    assert spark.read.parquet(paths["capacity_gap"]).where("batch_id = 2").count() == 1


def test_a_closed_plan_leaves_no_tables(spark):
    import os

    other = scratch_table(spark, "other")
    spark.range(3).write.parquet(other)
    plan = Plan(spark, SMALL, materialize=True)
    plan.calendar
    plan.close()
    assert not os.path.isdir(plan._folder.removeprefix("file:")) and os.path.isdir(other.removeprefix("file:"))


BATCH_T = "batch_id int, k string, v int"


def batches(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("batch_id", "k", "v").collect())


def test_a_batch_read_from_its_own_table_can_be_replaced(spark):
    path = scratch_table(spark, "t_self")
    overwrite_batch(spark.createDataFrame([(1, "x", 1), (1, "y", 2)], BATCH_T), path, 1)
    overwrite_batch(spark.createDataFrame([(2, "z", 3)], BATCH_T), path, 2)
    own = spark.read.parquet(path).where("batch_id = 1")
    overwrite_batch(own.withColumn("v", F.col("v") * 10), path, 1)
    assert batches(spark, path) == [(1, "x", 10), (1, "y", 20), (2, "z", 3)]


def test_a_write_that_fails_leaves_the_old_batch(spark):
    path = scratch_table(spark, "t_fail")
    rows = spark.createDataFrame([(1, "x", 1)], BATCH_T)
    overwrite_batch(rows, path, 1)
    bad = spark.range(1000).select(F.lit(1).alias("batch_id"), F.lit("q").alias("k"),
                                   F.when(F.col("id") == 990, F.raise_error(F.lit("broken row"))).otherwise(F.lit(1)).cast("int").alias("v"))
    with pytest.raises(Exception, match="broken row"):
        overwrite_batch(bad, path, 1)
    assert batches(spark, path) == [(1, "x", 1)]
    assert files.names(spark, path) == ["batch_id=1"]


def test_a_replace_that_ended_between_its_renames_is_put_right(spark, monkeypatch):
    path = scratch_table(spark, "t_between")
    overwrite_batch(spark.createDataFrame([(1, "x", 1)], BATCH_T), path, 1)
    rename, calls = files.rename, []

    def lost(s, a, b):
        calls.append(b)
        if len(calls) > 1:
            raise KeyboardInterrupt  # the driver is gone: nothing is cleaned up
        rename(s, a, b)

    monkeypatch.setattr(files, "rename", lost)
    with pytest.raises(KeyboardInterrupt):
        overwrite_batch(spark.createDataFrame([(1, "y", 2)], BATCH_T), path, 1)
    monkeypatch.setattr(files, "rename", rename)
    assert "batch_id=1" not in files.names(spark, path) and "_old-batch_id-1" in files.names(spark, path)
    with pytest.raises(Exception):  # the next replace fails too: the old rows are back all the same
        overwrite_batch(spark.range(1).select(F.raise_error(F.lit("no")).cast("int").alias("v")), path, 1)
    assert batches(spark, path) == [(1, "x", 1)]
    overwrite_batch(spark.createDataFrame([(1, "y", 2)], BATCH_T), path, 1)
    assert batches(spark, path) == [(1, "y", 2)]


def test_a_slice_copied_twice_is_there_once(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "d int, v string")
    dst = scratch_table(spark, "t_twice")
    assert copy_slice(src, dst, F.col("d") == 2, partition_by=["d"]) == 2
    assert copy_slice(src, dst, F.col("d") == 2, partition_by=["d"]) == 2
    assert copy_slice(src, dst, "d = 1", partition_by=["d"]) == 1
    assert copy_slice(src, dst, "d = 9", partition_by=["d"]) == 0
    got = sorted(tuple(r) for r in spark.read.parquet(dst).select("d", "v").collect())
    assert got == [(1, "a"), (2, "b"), (2, "c")]
    smaller = src.where("v <> 'c'")  # the source lost a row: so does the slice
    assert copy_slice(smaller, dst, F.col("d") == 2, partition_by=["d"], slice_id="two") == 1
    assert copy_slice(src, dst, F.col("d") == 2, partition_by=["d"], slice_id="two") == 2
    assert spark.read.parquet(dst).where("slice_id = 'two'").count() == 2
    assert copy_slice(src, dst + "-more", "d = 2", mode="append") == 2 == copy_slice(src, dst + "-more", "d = 2", mode="append")
    assert spark.read.parquet(dst + "-more").count() == 4


@pytest.mark.parametrize("kind", ["skewed", "dates", "text", "few", "nulls", "empty"])
def test_split_predicates_take_every_row_once(spark, kind):
    col = {"skewed": F.when(F.col("id") % 3 > 0, F.lit(500)).otherwise(F.col("id")), "dates": F.date_add(F.lit(J_DATE), (F.col("id") % 400).cast("int")),
           "text": F.concat(F.lit("o'"), (F.col("id") % 700).cast("string")), "few": F.col("id") % 2,
           "nulls": F.when(F.col("id") % 4 > 0, F.col("id")), "empty": F.lit(None).cast("long")}[kind]
    path = scratch_table(spark, "t_split")
    spark.range(6000).select("id", col.alias("key")).write.parquet(path)
    df = spark.read.parquet(path)
    predicates = sio.plan_split(df, "key", 8)
    parts = [df.where(p).select("id").toPandas()["id"] for p in predicates]
    assert sorted(i for p in parts for i in p) == list(range(6000))
    sizes = [len(p) for p in parts]
    if kind in ("dates", "text"):
        assert len(sizes) == 8 and max(sizes) < 1.3 * 6000 / 8
    if kind == "skewed":  # the heavy value is alone in its part, and no other part is large
        heavy = max(range(len(sizes)), key=sizes.__getitem__)
        assert df.where(predicates[heavy]).where("key <> 500").count() == 0
        assert max(s for i, s in enumerate(sizes) if i != heavy) <= 2 * 6000 / 8
    if kind == "empty":
        assert predicates == ["1 = 1"]


def test_snapshot_reads_only_its_day(spark):
    """The dimension is partitioned by day; the batch's day prunes the scan while the query runs."""
    dim = scratch_table(spark, "t_dim")
    days = [J_DATE + _dt.timedelta(days=i) for i in range(20)]
    rows = [(f"w{i}", f"name {i}", f"F{i % 3}", d) for d in days for i in range(5)]
    spark.createDataFrame(rows, "stockorg_code string, stockorg_name string, parent_org_code string, day_date date").write.partitionBy(
        "day_date").parquet(dim)
    plan_rows = scratch_table(spark, "t_plan_rows")
    spark.createDataFrame([(1, days[3]), (1, days[7]), (2, days[19])], "batch_id int, day_date date").write.parquet(plan_rows)
    out = ld.load_org_snapshot(spark.read.parquet(dim), spark.read.parquet(plan_rows), 1)
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 5
    out.collect()
    scan = [n for n in nodes(out._jdf.queryExecution().executedPlan())
            if "FileSourceScan" in n.getClass().getSimpleName() and "dynamicpruning" in n.toString()]
    assert [n.metrics().get("numPartitions").get().value() for n in scan] == [1]


def nodes(plan):
    """All physical operators, also those of finished query stages."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return nodes(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return nodes(plan.plan())
    children = plan.children()
    return [plan] + [n for i in range(children.size()) for n in nodes(children.apply(i))]


def test_clustered_write_lets_a_key_filter_skip_row_groups(spark):
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(200_000).select(F.concat(F.lit("w"), F.lpad((F.xxhash64("id") % 40 + 40).cast("string"), 2, "0")).alias("stockorg_code"),
                                       F.concat(F.lit("s"), F.lpad((F.col("id") % 997).cast("string"), 3, "0")).alias("sku_code"), "id")
    read = {}
    for name, cluster in (("plain", ()), ("clustered", ("stockorg_code", "sku_code"))):
        path = scratch_table(spark, f"t_{name}")
        out = sio.write_parquet_view(rows, path, f"t_{name}_view", cluster_by=cluster, row_group_bytes=64 * 1024)
        assert out.count() == 200_000 and out.agg(F.countDistinct("id")).first()[0] == 200_000
        hit = total = 0
        for f in glob.glob(path.removeprefix("file:") + "/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(0).statistics
                total += 1
                hit += stats.min <= "w17" <= stats.max
        read[name] = hit / total
    assert read["plain"] > 0.9 and read["clustered"] < 0.25


def test_observed_totals_equal_the_rescans(spark):
    from monthplan.operators.linetypes import todo_reconciliation
    from monthplan.operators.rollforward import month_totals
    from monthplan.plans.results import month_sums, reconcile, write_results

    plan = Plan(spark, SMALL, materialize=True)
    metrics = {}
    paths = write_results(plan, scratch_table(spark, "t_observed"), metrics)
    assert set(metrics) == set(paths)
    assert {n: m["rows"] for n, m in metrics.items()} == {n: spark.read.parquet(p).count() for n, p in paths.items()}
    for row in month_totals(plan.todo).collect():
        for column in [c for c in row.asDict() if c != "dt"]:
            assert month_sums(metrics["warehouse_sku_todo"], column)[row.dt] == row[column]
    by = {(r.grain, r.dt): r.todo_qty for r in todo_reconciliation(plan.todo, plan.factory_linetype_todo, plan.factory_sku_todo).collect()}
    found = reconcile(metrics)
    assert [r["dt"] for r in found] == plan.months and all(r["agrees"] for r in found)
    for r in found:
        assert all(r[g] == by.get((g, r["dt"]), 0) for g in ("sku", "factory_sku", "linetype"))
    plan.close()


def test_entry_without_the_training_data_folder(tmp_path):
    """Also with an emptied folder, of which only __pycache__ is left; an error in its files is not hidden."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    skip = shutil.ignore_patterns("llm", "__pycache__", "*.parquet")
    shutil.copytree(root / "monthplan", tmp_path / "monthplan", ignore=skip)
    shutil.copyfile(root / "__spark_entry__.py", tmp_path / "__spark_entry__.py")
    code = "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) >= 47, len(e.queries())"

    def run():
        return subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})

    assert run().returncode == 0
    (tmp_path / "monthplan/llm/__pycache__").mkdir(parents=True)
    (tmp_path / "corpus_pipeline.py").write_text("from monthplan.llm import packing\n")
    assert run().returncode == 0
    (tmp_path / "monthplan/llm/queries.py").write_text("from . import not_there\n")
    assert "not_there" in run().stderr or "packing" in run().stderr
