"""Tables that grow with the data are never broadcast, however small the planner takes them to be."""

import datetime as dt

import pytest

from monthplan.functions import joins
from monthplan.operators import demand as dm
from monthplan.operators import linetypes as lt
from monthplan.operators import rollforward as rf
from monthplan.plans import catalog
from monthplan.plans.inputs import Plan
from monthplan.sources import fixtures as fx
from monthplan.sources.buckets import BucketStore

from test_load_layout import tables

D = dt.date(1997, 1, 1)
E = dt.date(1997, 7, 1)


@pytest.fixture
def eager(spark):
    """A session that broadcasts whatever it estimates to be under 10 MB."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "10MB")
    yield spark
    for n, v in before.items():
        spark.conf.set(n, v)


def broadcast_by_sku(df) -> list[str]:
    """Joins on a SKU whose side is broadcast, in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "BroadcastHashJoin" in x and "sku_code" in x]


def test_line_preferences_and_rollups_are_shuffled(eager):
    made = eager.createDataFrame([("F01", "F01_L0", "warehouse.F01", "S1", D), ("F01", "F01_L2", "warehouse.F01", "S1", D)],
                                 "factory_code string, line_code string, stockorg_code string, sku_code string, dt date")
    priority = made.selectExpr("factory_code", "line_code", "sku_code", "dt", "int(right(line_code, 1)) AS priority")
    lines = eager.createDataFrame([("F01", "F01_L0", "pure-bottle"), ("F01", "F01_L2", "ordinary-bottle")],
                                  "factory_code string, line_code string, linetype string")
    best = lt.preferred_line(made, priority, lines)
    assert broadcast_by_sku(best) == [] and [tuple(r) for r in best.collect()] == [("F01", "F01_L0", "S1", D, 0, "pure-bottle")]
    types = lt.sku_line_type(best)
    todo = eager.createDataFrame([("warehouse.F01", "S1", D)], "stockorg_code string, sku_code string, dt date").selectExpr(
        "*", *[f"CAST(2 AS decimal(18,3)) AS {c}" for c in lt.QTY_COLUMNS])
    sent = eager.createDataFrame([("warehouse.F02", "S1", D, "warehouse.F01", "S1")],
                                 "stockorg_code string, sku_code string, dt date, send_stockorg_code string, send_sku_code string")
    for rolled in (lt.todo_rollups(todo, types, sent), lt.warehouse_linetype_todo(todo, types), lt.factory_sku_todo(todo, types, sent)):
        assert broadcast_by_sku(rolled) == [] and {r["linetype"] for r in rolled.collect()} <= {"pure-bottle", None}


def test_demand_routes_and_stock_are_shuffled(eager):
    demand = eager.createDataFrame([("warehouse.F01", "S1", D, 5), ("warehouse.F02", "S1", D, 3)],
                                   "stockorg_code string, sku_code string, dt date, demand_qty int")
    lines = eager.createDataFrame([("warehouse.F01", "S1", D, E)], "stockorg_code string, sku_code string, dt_start date, dt_end date")
    routes = eager.createDataFrame([("S1", "warehouse.F02", "S1", "warehouse.F01", 1, D)],
                                   "receive_sku_code string, receive_stockorg_code string, send_sku_code string, "
                                   "send_stockorg_code string, priority int, dt date")
    need, viable = dm.unproducible_demand(demand, lines), dm.viable_routes(routes, lines)
    best = dm.best_transfer(need, viable)
    stock = demand.selectExpr("stockorg_code", "sku_code", "dt", "1 AS begin_stock_qty")
    safety = demand.selectExpr("stockorg_code", "sku_code", "dt", "1 AS safety_stock_qty")
    for df, rows in ((need, 1), (dm.producible_demand(demand, lines), 1), (viable, 1), (best, 1),
                     (rf.transfer_need(best, stock, safety), 1)):
        assert broadcast_by_sku(df) == [] and df.count() == rows


def test_suppliers_are_broadcast_by_their_count(eager, tmp_path, monkeypatch):
    lines = [(i, i % 7, i % 11, float(i % 4), dt.datetime(1997, 1 + i % 6, 3)) for i in range(420)]
    lines += [(1, 3, None, 2.0, dt.datetime(1997, 2, 1)), (2, None, 4, 5.0, None), (3, 3, 4, None, dt.datetime(1997, 2, 1))]
    d = tables(eager, tmp_path, lines)
    eager.createDataFrame([(4, 3), (4, None), (None, 2)], "s_suppkey bigint, s_nationkey int").write.mode("append").parquet(f"{d}/supplier.parquet")
    found = {}
    for most in (13, 12):  # there are thirteen suppliers
        monkeypatch.setattr(joins, "BROADCAST_ROWS", most, raising=False)
        df = fx.shipments(Plan(eager, d).t)
        found[most] = sorted(map(str, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin [l_suppkey" in plan, "BroadcastHashJoin [l_suppkey" in plan) == (most == 12, most == 13)
    assert found[12] == found[13] != []


FROM_LINE_TYPES = ["preferred_line", "sku_line_type", "warehouse_linetype_todo", "factory_linetype_todo", "factory_sku_todo", "capacity_vs_todo",
                   "rebalance_capacity", "rebalance_capacity_share_pure", "capacity_gap", "month_shortage", "early_moves", "early_moves_month",
                   "early_moves_conserving", "early_moves_month_conserving", "unfilled_shortage", "last_short_month"]


def test_no_query_broadcasts_a_table_of_skus(eager, tmp_path, monkeypatch):
    lines = [(i, i % 7, i % 10, float(1 + i % 4), dt.datetime(1997, 1 + i % 6, 3)) for i in range(420)]
    lines += [(i, i % 7, i % 10, 2.0, dt.datetime(1996, 12, 3)) for i in range(70)]
    d = tables(eager, tmp_path, lines)
    planned = {}

    def seen(name, df):
        planned[name] = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x and "sku_code" in x]
        return df

    keep, table = Plan.keep, BucketStore.table
    monkeypatch.setattr(Plan, "keep", lambda self, name, df, *a: keep(self, name, seen(name, df), *a))
    monkeypatch.setattr(BucketStore, "table", lambda self, name, build, *a, **k: table(self, name, lambda: seen(name, build()), *a, **k))
    try:
        rows = {name: seen(name, catalog.QUERIES[name](eager, d)).count() for name in FROM_LINE_TYPES}
    finally:
        catalog.shared_plan(eager, d).close()
    assert rows["preferred_line"] and rows["factory_sku_todo"] and rows["rebalance_capacity"]
    assert planned["preferred_line"] and planned["sku_linetype"] and len(planned["rollups"]) == 3
    assert {name: x for name, x in planned.items() if any("Broadcast" in j for j in x)} == {}
