"""Plan checks: no row-at-a-time Python, no cartesian / nested-loop joins, filters and columns reach the scans."""

import pytest

from monthplan.operators import demand as dm
from monthplan.operators import rollforward as rf
from monthplan.operators.rebalance import rebalance_capacity
from monthplan.plans import catalog
from monthplan.plans.inputs import Plan
from monthplan.session import scratch_table
from monthplan.sources import loaders as ld

from conftest import SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Lazy(Plan):
    """A plan that writes nothing but the month loop: every stage shows its own operators."""


@pytest.fixture(scope="module")
def month_plans():
    return []


@pytest.fixture(scope="module")
def lazy(spark, month_plans):
    p = Lazy(spark, SMALL, materialize=False)
    step = rf.month_step

    def seen(*args):
        df = step(*args)
        month_plans.append(executed(df))
        return df

    rf.month_step = seen
    try:
        p.todo
    finally:
        rf.month_step = step
    return p


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_forbidden_operators(spark, lazy, name, monkeypatch):
    monkeypatch.setattr(catalog, "shared_plan", lambda *a: lazy)
    plan = executed(catalog.QUERIES[name](spark, SMALL))
    assert not [k for k in FORBIDDEN if k in plan]


def test_a_month_of_the_loop_has_one_exchange(lazy, month_plans):
    assert len(month_plans) == len(lazy.months)
    for plan in month_plans:
        assert plan.count("Exchange hashpartitioning") == 1 and not [k for k in FORBIDDEN if k in plan]
        assert "send" in plan.split("Exchange hashpartitioning")[1].split("\n")[1] or "partial_sum(need" in plan


def test_loaders_push_the_batch_filter(spark, lazy):
    """Over raw tables on disk, as a warehouse holds them."""
    for name, load in (("demand_raw", ld.load_demand), ("route_raw", ld.load_transfer_routes),
                       ("producibility_raw", ld.load_producibility), ("stock_raw", ld.load_opening_stock)):
        path = scratch_table(spark, name)
        lazy.raw(name).write.parquet(path)
        plan = executed(load(spark.read.parquet(path), 15))
        assert "EqualTo(batch_id,15)" in plan, name


def test_lineitem_is_combined_before_it_meets_the_suppliers(spark, lazy):
    plan = executed(lazy.demand)
    join = plan.index("SortMergeJoin") if "SortMergeJoin" in plan else plan.index("HashJoin")
    assert plan.index("partial_sum(l_quantity", join) > join  # further down the tree: below the join


@pytest.fixture(scope="module")
def kept(spark):
    return Plan(spark, SMALL, materialize=True)


def test_todo_is_not_shuffled_by_its_sender(kept):
    plan = executed(kept.factory_sku_todo)
    senders = [x for x in plan.split("\n") if "Exchange hashpartitioning(send_" in x]
    assert len(senders) <= 2  # transfers and the sender's line types, neither of them the to-do


def test_safety_joins_rules_and_demand_once(kept):
    plan = executed(dm.safety_stock(kept.calendar, kept.months, kept.safety_rules, kept.demand))
    assert plan.count("SortMergeJoin") == 1 and plan.count("FileScan") == 3


def test_folds_shuffle_once_by_factory(spark):
    p = Plan(spark, SMALL, materialize=True)
    p.months
    p.build(["cap_todo"])
    ceiling = p.keep("ceiling_month", p.ceiling_month)
    plan = executed(rebalance_capacity(p.cap_todo, ceiling))
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2 and all("hashpartitioning(factory_code" in x for x in exchanges)


def test_changed_files_are_another_plan(spark, tmp_path):
    import shutil

    for f in ("lineitem", "supplier", "nation"):
        shutil.copyfile(f"{SMALL}/{f}.parquet", tmp_path / f"{f}.parquet")
    first = catalog.shared_plan(spark, str(tmp_path))
    assert catalog.shared_plan(spark, str(tmp_path)) is first
    spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(500).toPandas().to_parquet(tmp_path / "lineitem.parquet")
    assert catalog.shared_plan(spark, str(tmp_path)) is not first
