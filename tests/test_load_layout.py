"""How the load step lays out the shipments, and how safety stock meets its rules."""

import datetime as dt

from monthplan.operators import demand as dm
from monthplan.plans.inputs import Plan

MONTHS = [dt.date(1997, m, 1) for m in range(1, 7)]


def tables(spark, folder, lines):
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(s, s % 5) for s in range(10)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(n, f"N{n}") for n in range(5)], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    return str(folder)


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_line_is_shuffled_once_and_a_batch_reads_its_own_files(spark, tmp_path):
    lines = [(i, i % 7, i % 10, float(i % 4), dt.datetime(1995 + i % 5, 1 + i % 12, 3)) for i in range(600)]
    lines += [(1, None, 3, 2.0, dt.datetime(1997, 2, 1)), (2, 3, 4, 5.0, None), (3, 3, 4, None, dt.datetime(1997, 2, 1))]
    d = tables(spark, tmp_path, lines)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        lazy = Plan(spark, d)
        from monthplan.sources import fixtures as fx
        assert executed(fx.shipments(lazy.t)).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    kept = Plan(spark, d, materialize=True)
    written = fx.shipments(kept.t)
    want = {}
    for _, k, s, q, day in lines:
        at = (None if day is None else (day.year - 1990) * 2 + (1 if day.month <= 6 else 2), s % 5, k, day and day.date().replace(day=1))
        want[at] = want.get(at) if q is None else (want.get(at) or 0) + int(q)
    assert {(r.batch_id, r.n, r.k, r.dt): r.qty for r in written.collect()} == want and written.count() == len(want)
    scan = [x for x in executed(written.where("batch_id = 15")).split("\n") if "FileScan" in x]
    assert len(scan) == 1 and "PartitionFilters: [isnotnull(batch_id" in scan[0]
    kept.close()


def test_a_folder_without_lines_loads_as_no_rows(spark, tmp_path):
    kept = Plan(spark, tables(spark, tmp_path, []), materialize=True)
    assert kept.demand.count() == 0 and kept.producibility.count() == 0 and kept.months == []
    kept.close()


def test_rules_are_not_expanded_before_they_meet_the_demand(spark):
    calendar = spark.createDataFrame([(m, 6 - i) for i, m in enumerate(MONTHS)], "dt date, dt_rn int")
    rules = spark.createDataFrame([("warehouse.F01", "S1", MONTHS[0], MONTHS[3], 31), ("warehouse.F01", "S1", MONTHS[0], MONTHS[3], 31),
                                   ("warehouse.F01", "S1", MONTHS[3], dt.date(1997, 8, 1), 30), (None, "S1", MONTHS[0], MONTHS[3], 3)],
                                  "stockorg_code string, sku_code string, dt_start date, dt_end date, safety_stock_days int")
    demand = spark.createDataFrame([("warehouse.F01", "S1", MONTHS[1], 28), ("warehouse.F01", "S1", MONTHS[5], 60), (None, "S1", MONTHS[1], 9)],
                                   "stockorg_code string, sku_code string, dt date, demand_qty int")
    got = dm.safety_stock(calendar, MONTHS, rules, demand)
    plan = executed(got)
    assert plan.count("Exchange hashpartitioning") == 2 and plan.index("Generate explode") < plan.index("SortMergeJoin")
    # 28 * 31 / 28 twice in January, 60 * 30 / 30 in May, repeated in June
    assert sorted((r.dt, float(r.safety_stock_qty)) for r in got.collect()) == [
        (MONTHS[0], 31.0), (MONTHS[0], 31.0), (MONTHS[4], 60.0), (MONTHS[5], 60.0)]
