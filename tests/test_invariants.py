"""Invariants of the pipeline on the derived test data."""

import pytest
from pyspark.sql import functions as F

from monthplan.plans.inputs import Plan

from conftest import SMALL


@pytest.fixture(scope="module")
def plan(spark):
    return Plan(spark, SMALL, materialize=True)


def test_transfers_balance_and_stock_carries(plan):
    todo = plan.todo
    per_month = todo.groupBy("dt").agg(F.sum("trans_in_qty").alias("i"), F.sum("trans_out_qty").alias("o")).collect()
    assert all(r.i == r.o for r in per_month)
    assert todo.where("trans_in_qty > 0 AND trans_out_qty > 0").count() == 0
    neg = todo.where(" OR ".join(f"{c} < 0" for c in todo.columns if c.endswith("_qty"))).count()
    assert neg == 0
    nxt = todo.select("stockorg_code", "sku_code", F.add_months("dt", 1).alias("dt"), F.col("end_stock_qty").alias("e"))
    joined = nxt.join(todo, ["stockorg_code", "sku_code", "dt"])
    assert joined.where("e <> begin_stock_qty").count() == 0
    assert joined.count() == nxt.where(F.col("dt") <= max(plan.months)).count()


def test_reconciliation_rule(plan):
    from monthplan.operators.linetypes import todo_reconciliation

    rec = todo_reconciliation(plan.todo, plan.factory_linetype_todo, plan.factory_sku_todo).collect()
    by = {}
    for r in rec:
        by.setdefault(r.dt, {})[r.grain] = r.todo_qty
    for g in by.values():
        assert g["sku"] == g["factory_sku"]
        assert g["linetype"] <= g["sku"]


def test_rebalance_respects_capacity_and_ceiling(plan):
    rb = plan.rebalanced
    assert rb.where("assigned_capacity > capacity OR assigned_capacity < 0").count() == 0
    over = (rb.groupBy("factory_code", "dt").agg(F.sum("assigned_capacity").alias("a"))
            .join(plan.ceiling_month, ["factory_code", "dt"], "left")
            .where(F.col("a") > F.coalesce("factory_capacity", F.lit(0))))
    assert over.count() == 0


def test_advance_conserves_shortage(plan):
    from monthplan.operators import advance as adv

    st = plan.advance_state()
    moves = adv.early_moves(st, 1)
    assert moves.where("qty_tomove <= 0").count() == 0
    short = adv.month_shortage(st)
    carried = adv.early_moves_month(st, 1)
    # per (factory, line type, month): shortage = moves made that month + shortage carried to the month before
    m = moves.groupBy("factory_code", "linetype", "dt").agg(F.sum("qty_tomove").alias("moved"))
    c = carried.select("factory_code", "linetype", F.add_months("dt", 1).alias("dt"), F.col("qty_tomove").alias("c"))
    first = min(plan.months)
    chk = (short.join(m, ["factory_code", "linetype", "dt"], "left").join(c, ["factory_code", "linetype", "dt"], "left")
           .where(F.col("dt") != F.lit(first))
           .where(F.col("qty_shortage") != F.coalesce("moved", F.lit(0)) + F.coalesce("c", F.lit(0))))
    assert chk.count() == 0
    cons = adv.early_moves(plan.advance_state(consume_surplus=True), 1)
    over = (cons.groupBy("factory_code", "linetype2", "dt").agg(F.sum("qty_tomove").alias("q"))
            .join(plan.capacity_gap.groupBy("factory_code", F.col("linetype").alias("linetype2"), "dt")
                  .agg(F.sum("qty_surplus").alias("qty_surplus")), ["factory_code", "linetype2", "dt"])
            .where("q > qty_surplus"))
    assert over.count() == 0


def test_month_loop_plan_stays_small(plan):
    # the roll-forward result is read from its written table: no join / aggregate left in its plan
    text = plan.todo._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "HashAggregate" not in text


def test_results_have_the_declared_schemas(plan):
    from monthplan.operators import advance as adv
    from monthplan.operators.linetypes import warehouse_linetype_todo
    from monthplan.plans import schemas as sc

    st = plan.advance_state()
    checks = [
        (plan.todo, sc.ROLLFORWARD),
        (plan.sku_linetype, sc.SKU_LINETYPE),
        (warehouse_linetype_todo(plan.todo, plan.sku_linetype), sc.WAREHOUSE_LINETYPE_TODO),
        (plan.factory_linetype_todo, sc.FACTORY_LINETYPE_TODO),
        (plan.factory_sku_todo, sc.FACTORY_SKU_TODO),
        (plan.rebalanced, sc.ASSIGNED_CAPACITY),
        (adv.early_moves(st, 1), sc.MOVES),
        (adv.early_moves_month(st, 1), sc.MONTH_TO_MOVE),
    ]
    for df, schema in checks:
        assert sc.shape(df.schema) == sc.shape(schema)
