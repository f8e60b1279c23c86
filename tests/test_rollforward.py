"""The roll-forward split by role, its ledger, the coverage index and the one-pass roll-ups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from monthplan.operators import demand as dm
from monthplan.operators import linetypes as lt
from monthplan.operators import rollforward as rf
from monthplan.plans.inputs import Plan
from monthplan.session import drop_run, run_folder
from monthplan.sources import buckets, files

from conftest import SMALL
from test_edges import APR, DEMAND_T, FEB, J, MAR, PROD_T, ROUTE_T, SAFETY_T, STOCK_T, D

MONTHS = [J, FEB, MAR, APR]
MAY = dt.date(2024, 5, 1)


def inputs(spark, seed, keys=40, movers=0.4):
    """Random frames in which keys receive in one month, send in another, and do neither in most."""
    rnd = random.Random(seed)
    after = [*MONTHS, MAY]
    names = [(f"warehouse.F{o}", f"S{s}") for o in range(keys // 4) for s in range(4)]
    prod = []
    for org, sku in names:
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            a = rnd.randrange(0, 4)
            prod.append((org.split(".")[1], f"L{rnd.randint(1, 3)}", sku, after[a], after[rnd.randrange(a + 1, 5)], org))
    demand = [(o, s, m, D(rnd.randint(0, 30)) if rnd.random() < 0.9 else None) for o, s in names for m in MONTHS if rnd.random() < 0.7]
    safety = [(o, s, m, D(rnd.randint(0, 9))) for o, s in names for m in MONTHS if rnd.random() < 0.5]
    stock = [(o, s, D(rnd.randint(0, 25)) if rnd.random() < 0.9 else None, J) for o, s in names if rnd.random() < 0.6]
    routes = [(rs, ro, ss, so, rnd.randint(1, 2), m) for ro, rs in names if rnd.random() < movers for m in MONTHS
              for so, ss in rnd.sample(names, 3) if (so, ss) != (ro, rs)]
    made = spark.createDataFrame(prod, PROD_T)
    wanted = spark.createDataFrame(demand, DEMAND_T)
    best = dm.best_transfer(dm.unproducible_demand(wanted, made), dm.viable_routes(spark.createDataFrame(routes, ROUTE_T), made))
    return dict(stock0=spark.createDataFrame(stock, STOCK_T), demand=wanted, producibility=made, transfers=best,
                safety=spark.createDataFrame(safety, SAFETY_T))


def table(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,movers", [(1, 0.4), (2, 1.0), (3, 0.0)])
def test_the_split_changes_nothing(spark, monkeypatch, seed, movers):
    frames = inputs(spark, seed, movers=movers)
    split = table(rf.rollforward(MONTHS, **frames))
    history = rf.key_history
    monkeypatch.setattr(rf, "key_history", lambda *a: history(*a).withColumn("moves", F.lit(True)))
    assert split == table(rf.rollforward(MONTHS, **frames)) and split


def test_month_tables_hold_only_keys_of_transfers(spark):
    frames = inputs(spark, 5)
    out = rf.rollforward(MONTHS, **frames, run="test-movers")
    best = frames["transfers"].where(F.col("dt").isin(MONTHS)).collect()
    touched = {(r.stockorg_code, r.sku_code) for r in best} | {(r.send_stockorg_code, r.send_sku_code) for r in best}
    folder = f"{run_folder(spark, 'test-movers')}/todo"
    looped = set()
    for m in MONTHS:
        looped |= {tuple(r) for r in spark.read.parquet(f"{folder}/dt={m}/moves=true").select(*rf.KEY).collect()}
    assert looped == touched
    assert {(r.stockorg_code, r.sku_code) for r in out.collect()} > touched
    drop_run(spark, "test-movers")


def test_a_month_reads_its_own_inputs_only(spark, monkeypatch):
    plans, step = [], rf.month_step

    def seen(state, inputs, m):
        plans.append(inputs._jdf.queryExecution().executedPlan().toString())
        return step(state, inputs, m)

    monkeypatch.setattr(rf, "month_step", seen)
    rf.rollforward(MONTHS, **inputs(spark, 6))
    assert len(plans) == len(MONTHS)
    for m, plan in zip(MONTHS, plans):
        assert f"PartitionFilters: [isnotnull(dt" in plan and str(m) in plan and "Bucketed" in plan


def test_a_run_that_failed_goes_on_after_its_last_month(spark, monkeypatch):
    frames = inputs(spark, 7)
    want = table(rf.rollforward(MONTHS, **frames))
    step, begun = rf.month_step, []

    def fail(state, inputs, m):
        begun.append(m)
        if m == APR and begun.count(APR) == 1:
            raise RuntimeError("the driver is lost")
        return step(state, inputs, m)

    monkeypatch.setattr(rf, "month_step", fail)
    with pytest.raises(RuntimeError):
        rf.rollforward(MONTHS, **frames, run="test-resume")
    folder = run_folder(spark, "test-resume")
    spark.range(3).write.parquet(f"{folder}/todo/dt={APR}/moves=true")  # half-written files of the lost month
    assert table(rf.rollforward(MONTHS, **frames, run="test-resume")) == want
    assert begun == [J, FEB, MAR, APR, APR]  # the first three were taken as they are
    assert table(rf.rollforward(MONTHS, **frames, run="test-resume")) == want and len(begun) == 5  # all of it is there
    with pytest.raises(ValueError):
        rf.rollforward(MONTHS[:3], **frames, run="test-resume")
    with pytest.raises(ValueError):
        rf.rollforward(MONTHS, **frames, buckets=3, run="test-resume")
    drop_run(spark, "test-resume")
    assert not files.exists(spark, folder)


def test_a_hot_sender_and_rows_without_a_month_of_the_plan(spark):
    n = 3000
    demand = [(f"warehouse.R{i}", "S", J, D(2)) for i in range(n)] + [("warehouse.R0", "S", MAY, D(9)), ("warehouse.X", "S", MAY, D(9))]
    made = spark.createDataFrame([("H", "L", "S", J, MAY, "warehouse.H")], PROD_T)
    wanted = spark.createDataFrame(demand, DEMAND_T)
    routes = spark.createDataFrame([("S", f"warehouse.R{i}", "S", "warehouse.H", 1, J) for i in range(n)], ROUTE_T)
    best = dm.best_transfer(dm.unproducible_demand(wanted, made), dm.viable_routes(routes, made))
    out = rf.rollforward([J, FEB], spark.createDataFrame([], STOCK_T), wanted, made, best, spark.createDataFrame([], SAFETY_T))
    got = {(r.stockorg_code, r.dt): (r.trans_in_qty, r.trans_out_qty, r.todo_qty) for r in out.collect()}
    assert got["warehouse.H", J] == (D(0), D(2 * n), D(2 * n)) and got["warehouse.R7", J] == (D(2), D(0), D(0))
    assert len(got) == 2 * (n + 1) and ("warehouse.X", J) not in got


# --- coverage index ---------------------------------------------------------------------------------------------
def test_coverage_merges_what_touches(spark):
    rows = [("F", "a", "S", J, FEB, "w"), ("F", "b", "S", FEB, MAR, "w"), ("F", "c", "S", APR, MAY, "w"), ("F", "d", "S", APR, J, "w"),
            ("F", "e", "S", None, MAY, "w"), ("F", "f", "S", J, FEB, "w"), ("F", "g", "T", MAR, MAR, "w"), ("F", "h", None, J, MAY, "w")]
    got = {r.sku_code: [(s.dt_start, s.dt_end) for s in r.spans] for r in dm.coverage_index(spark.createDataFrame(rows, PROD_T)).collect()}
    assert got == {"S": [(J, MAR), (APR, MAY)], None: [(J, MAY)]}


def test_coverage_matches_every_interval(spark):
    rnd = random.Random(4)
    first = dt.date(2020, 1, 1)
    day = lambda n: first + dt.timedelta(days=n)
    rows = [("F", f"L{i}", f"S{rnd.randint(0, 9)}", day(a := rnd.randint(0, 90)), day(a + rnd.randint(-3, 12)), f"w{rnd.randint(0, 2)}")
            for i in range(300)]
    probes = [(f"w{o}", f"S{s}", day(n), D(1)) for o in range(3) for s in range(11) for n in range(0, 105, 3)]
    made = spark.createDataFrame(rows, PROD_T)
    got = {tuple(r)[:3] for r in dm.producible_demand(spark.createDataFrame(probes, DEMAND_T), made).collect()}
    want = {(o, s, d) for o, s, d, _ in probes if any(r[5] == o and r[2] == s and r[3] <= d < r[4] for r in rows)}
    assert got == want
    index = dm.coverage_index(made)
    for r in index.collect():  # disjoint, in order, with a gap between
        assert all(a.dt_end < b.dt_start for a, b in zip(r.spans, r.spans[1:]))
    assert {tuple(r)[:3] for r in dm.unproducible_demand(spark.createDataFrame(probes, DEMAND_T), index).collect()} == {
        p[:3] for p in probes} - want


@pytest.fixture(scope="module")
def kept(spark):
    return Plan(spark, SMALL, materialize=True)


def below(plan, at):
    """Lines of the plan's subtree under line ``at``."""
    depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
    out = []
    for line in plan[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        out.append(line)
    return out


def path_to(plan, needle):
    """The operators above the line that holds ``needle``, nearest first."""
    at = next(i for i, line in enumerate(plan) if needle in line)
    depth, out = len(plan[at]) - len(plan[at].lstrip(" :+-")), []
    for line in reversed(plan[:at]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            out.append(line)
            depth = here
    return out


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_no_probe_shuffles_the_index(kept):
    probes = {"unproducible": kept.unproducible, "viable": kept.viable_routes, "producible": dm.producible_demand(kept.demand, kept.coverage)}
    for name, df in probes.items():
        above = path_to(executed(df), "coverage")
        join = next(i for i, line in enumerate(above) if "Join" in line)
        assert not any("Exchange" in line for line in above[:join]), name


def test_the_history_reads_the_index_where_it_lies(kept):
    n = int(kept.spark.conf.get("spark.sql.shuffle.partitions"))
    df = rf.key_history(kept.months, kept.stock0, kept.demand, kept.coverage, kept.best_transfer, kept.safety, n)
    above = path_to(executed(df), "coverage")
    join = next(i for i, line in enumerate(above) if "Join" in line)
    assert not any("Exchange" in line for line in above[:join])


# --- one-pass roll-ups --------------------------------------------------------------------------------------------
def test_rollups_equal_the_single_operators(kept):
    rolled = lt.todo_rollups(kept.todo, kept.sku_linetype, kept.best_transfer)
    by_line = rolled.where("grain = 'linetype'").select("stockorg_code", "linetype", "dt", *lt.QTY_COLUMNS)
    by_sku = rolled.where("grain = 'factory_sku'").select("factory_code", "dt", "sku_code", "linetype", *lt.QTY_COLUMNS)

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))

    assert rows(by_line) == rows(lt.warehouse_linetype_todo(kept.todo, kept.sku_linetype).select(*by_line.columns))
    assert rows(by_sku) == rows(lt.factory_sku_todo(kept.todo, kept.sku_linetype, kept.best_transfer).select(*by_sku.columns))
    plain = lt.todo_reconciliation(kept.todo, kept.factory_linetype_todo, by_sku)
    assert rows(lt.rollup_reconciliation(rolled, kept.factory_linetype_todo)) == rows(plain)


def test_the_todo_is_not_shuffled_before_the_rollups(kept):
    plan = executed(lt.todo_rollups(kept.todo, kept.sku_linetype, kept.best_transfer))
    above = path_to(plan, "_todo[")  # the scan of the roll-forward's table
    expand = next(i for i, line in enumerate(above) if "Expand" in line)
    assert not any("Exchange" in line for line in above[:expand])
    assert sum("_todo[" in line for line in plan) == 1  # one pass


def test_a_closed_plan_leaves_no_catalog_entry(spark):
    plan = Plan(spark, SMALL, materialize=True)
    plan.todo.count()
    assert [t for t in spark.catalog.listTables() if plan.tag in t.name]
    plan.close()
    assert not [t for t in spark.catalog.listTables() if plan.tag in t.name]
    buckets.release(spark, plan.tag)


