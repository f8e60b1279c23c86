"""Named queries: one per operator of the planning pipeline, each ``(spark, sf_dir) -> DataFrame``.

Every query derives its inputs from the test tables of ``sf_dir``, runs the operator, and leaves through ``to_edge``
(decimals -> double, small ints -> bigint), with the same column names as its SQL oracle.

Queries over the same folder in the same session share one materialised ``Plan``: the load step and the stage outputs
read by several queries (roll-forward, line types, capacity, gap) are written once under the checkpoint folder and
read by every later query, the way a set of reports over one planning run would be.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthplan.functions.quantities import to_edge
from monthplan.operators import advance as adv
from monthplan.operators import demand as dm
from monthplan.operators import linetypes as lt
from monthplan.operators import rollforward as rf
from monthplan.plans.inputs import Plan

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

QTY8 = lt.QTY_COLUMNS


_PLANS: dict[str, tuple[tuple, Plan]] = {}
_PLANS_LOCK = threading.Lock()


def _alive(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jsc is not None
    except Exception:  # no SparkContext (Spark Connect): the session object itself is the identity
        return True


def folder_listing(spark: SparkSession, sf_dir: str) -> tuple:
    """What the folder holds by name, size and time of change: another listing means other data."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def shared_plan(spark: SparkSession, sf_dir: str) -> Plan:
    """The materialised plan of ``sf_dir`` for this session (a new one for a new session or changed files)."""
    key = sf_dir.rstrip("/")
    listing = folder_listing(spark, key)
    with _PLANS_LOCK:
        known, plan = _PLANS.get(key, (None, None))
        if plan is None or known != listing or plan.spark is not spark or not _alive(spark):
            plan = Plan(spark, key, materialize=True)
            _PLANS[key] = (listing, plan)
        return plan


def query(fn: Callable[[Plan], DataFrame]) -> Callable[[Plan], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_edge(fn(shared_plan(spark, sf_dir)))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# --- stage A: loaders ------------------------------------------------------------------------------------------------
@query
def plan_calendar(p: Plan) -> DataFrame:
    return p.calendar.select("batch_id", "dt", "dt_rn")


@query
def opening_stock(p: Plan) -> DataFrame:
    return p.opening_stock.select("stockorg_code", "sku_code", "dt", "begin_stock_qty")


@query
def producibility(p: Plan) -> DataFrame:
    return p.producibility.select("factory_code", "line_code", "sku_code", "dt_start", "dt_end", "stockorg_code")


@query
def safety_rules(p: Plan) -> DataFrame:
    return p.safety_rules.select("stockorg_code", "sku_code", "dt_start", "dt_end", "safety_stock_days")



def ranked(df: DataFrame) -> DataFrame:
    """The priority as a double: it can be NULL, which client integers can't be."""
    return df.withColumn("priority", F.col("priority").cast("double"))


ROUTE_COLUMNS = ["receive_sku_code", "receive_stockorg_code", "send_sku_code", "send_stockorg_code", "priority", "dt"]


@query
def transfer_routes(p: Plan) -> DataFrame:
    return ranked(p.routes).select(*ROUTE_COLUMNS)


@query
def demand_next_month(p: Plan) -> DataFrame:
    return p.demand.select("stockorg_code", "sku_code", "dt", "demand_qty", "demand_qty_next", "dt2")


@query
def line_hours(p: Plan) -> DataFrame:
    return p.line_hours.select("factory_code", "line_code", "start_dt", "end_dt", "max_hour")


@query
def production_rates(p: Plan) -> DataFrame:
    return p.production_rates.select("factory_code", "line_code", "production_rate", "start_dt", "end_dt")


@query
def line_priority(p: Plan) -> DataFrame:
    return ranked(p.line_priority).select("factory_code", "line_code", "sku_code", "dt", "priority")


@query
def org_snapshot(p: Plan) -> DataFrame:
    return p.org_snapshot.select("stockorg_code", "stockorg_name", "parent_org_code")


# --- stage B1: demand, transfers, safety ---------------------------------------------------------------------------
@query
def unproducible_demand(p: Plan) -> DataFrame:
    return p.unproducible.select("stockorg_code", "sku_code", "dt", "demand_qty")


@query
def viable_routes(p: Plan) -> DataFrame:
    return ranked(p.viable_routes).select(*ROUTE_COLUMNS)


@query
def best_transfer(p: Plan) -> DataFrame:
    return ranked(p.best_transfer).select("stockorg_code", "sku_code", "dt", "demand_qty", "send_sku_code",
                                  "send_stockorg_code", "priority")


@query
def safety_stock(p: Plan) -> DataFrame:
    return p.safety.select("stockorg_code", "sku_code", "dt", "safety_stock_qty")


@query
def producible_demand(p: Plan) -> DataFrame:
    return dm.producible_demand(p.demand, p.coverage).select("stockorg_code", "sku_code", "dt", "demand_qty")


def _first_month(p: Plan):
    m = p.months[0]
    at = F.col("dt") == F.lit(m)
    need = rf.transfer_need(p.best_transfer.where(at), p.stock0, p.safety.where(at))
    return m, at, need


@query
def transfer_need_first_month(p: Plan) -> DataFrame:
    _, _, need = _first_month(p)
    return need.select("stockorg_code", "sku_code", "dt", "send_stockorg_code", "send_sku_code", "qty")


@query
def quantity_pivot(p: Plan) -> DataFrame:
    """B8d over every month: the six kinds stacked and pivoted, from the stock that the roll-forward carries."""
    months = F.col("dt").isin(p.months)
    key = ["stockorg_code", "sku_code"]
    carried = p.todo.select(*key, F.add_months("dt", 1).alias("dt"), F.col("end_stock_qty").alias("begin_stock_qty"))
    stock = p.stock0.select(*key, "dt", "begin_stock_qty").unionByName(carried).where(months)
    dem, safety = p.demand.where(months), p.safety.where(months)
    need = rf.transfer_need(p.best_transfer.where(months), stock, safety)
    stacked = rf.stack_quantities(stock, dem, dm.producible_demand(dem, p.coverage), need, safety)
    return rf.pivot_quantities(stacked)


@query
def inventory_rollforward(p: Plan) -> DataFrame:
    return p.todo.select(*rf.RESULT_COLUMNS)


@query
def month_totals(p: Plan) -> DataFrame:
    return rf.month_totals(p.todo)


# --- stage B2: line types, capacity, roll-ups ------------------------------------------------------------------------
@query
def line_types(p: Plan) -> DataFrame:
    return p.linetypes.select("factory_code", "line_code", "linetype", "linetype_rn")


@query
def producible_months(p: Plan) -> DataFrame:
    return lt.producible_months(p.producibility, p.months).select(
        "factory_code", "line_code", "stockorg_code", "sku_code", "dt")


@query
def preferred_line(p: Plan) -> DataFrame:
    return ranked(p.preferred).select("factory_code", "line_code", "sku_code", "dt", "priority", "linetype")


@query
def sku_line_type(p: Plan) -> DataFrame:
    return p.sku_linetype.select("factory_code", "stockorg_code", "sku_code", "dt",
                                 F.array_join("linetypes", ",").alias("linetypes"), "linetype")


@query
def warehouse_linetype_todo(p: Plan) -> DataFrame:
    return p.warehouse_linetype_todo.select("stockorg_code", "linetype", "dt", *QTY8)


@query
def line_hours_month(p: Plan) -> DataFrame:
    return lt.line_hours_month(p.line_hours, p.months).select("factory_code", "line_code", "dt", "max_hour")


@query
def line_rates_month(p: Plan) -> DataFrame:
    return lt.line_rates_month(p.production_rates, p.months).select(
        "factory_code", "line_code", "production_rate", "dt")


@query
def line_rate_avg(p: Plan) -> DataFrame:
    return p.rate_avg.select("factory_code", "line_code", "linetype", "dt", "linetype_rn", "avg_rate")


@query
def linetype_capacity(p: Plan) -> DataFrame:
    return p.linetype_capacity.select("factory_code", "linetype", "linetype_rn", "dt", "capacity")


@query
def factory_linetype_todo(p: Plan) -> DataFrame:
    return p.factory_linetype_todo.select("factory_code", "linetype", "dt", *QTY8)


@query
def factory_sku_todo(p: Plan) -> DataFrame:
    return p.factory_sku_todo.select("factory_code", "dt", "sku_code", "linetype", *QTY8)


@query
def todo_reconciliation(p: Plan) -> DataFrame:
    return lt.rollup_reconciliation(p.rollups, p.factory_linetype_todo)


# --- stage C: rebalance --------------------------------------------------------------------------------------------
@query
def capacity_vs_todo(p: Plan) -> DataFrame:
    return p.cap_todo.select("factory_code", "linetype", "dt", "linetype_rn", "line_capacity", "todo_qty")


@query
def factory_capacity_month(p: Plan) -> DataFrame:
    return p.ceiling_month.select("factory_code", "dt", "factory_capacity")


@query
def rebalance_capacity(p: Plan) -> DataFrame:
    return p.rebalanced.select("factory_code", "linetype", "dt", "capacity", "assigned_capacity", "todo_qty",
                               "todo_left")


@query
def rebalance_capacity_share_pure(p: Plan) -> DataFrame:
    """Variant of G4-G5: ordinary lines may also use the spare capacity of their package's pure line."""
    from monthplan.operators.rebalance import rebalance_capacity as _rebalance

    return _rebalance(p.cap_todo, p.ceiling_month, share_pure=True).select(
        "factory_code", "linetype", "dt", "capacity", "assigned_capacity", "todo_qty", "todo_left")


@query
def capacity_gap(p: Plan) -> DataFrame:
    return p.capacity_gap.select("factory_code", "linetype", "dt", "qty_surplus", "qty_shortage")


# --- stage D: early production -----------------------------------------------------------------------------------
@query
def month_shortage(p: Plan) -> DataFrame:
    return adv.month_shortage(p.advance_state())


@query
def early_moves(p: Plan) -> DataFrame:
    return adv.early_moves(p.advance_state(), p.batch_id)


@query
def early_moves_month(p: Plan) -> DataFrame:
    return adv.early_moves_month(p.advance_state(), p.batch_id)


@query
def early_moves_conserving(p: Plan) -> DataFrame:
    """Variant of T4-T6: a donor's surplus shrinks by what each round takes, so it is never promised twice."""
    return adv.early_moves(p.advance_state(consume_surplus=True), p.batch_id)


@query
def early_moves_month_conserving(p: Plan) -> DataFrame:
    return adv.early_moves_month(p.advance_state(consume_surplus=True), p.batch_id)


@query
def unfilled_shortage(p: Plan) -> DataFrame:
    """T9, whole: what no donor and no earlier month could take."""
    return adv.unfilled_shortage(p.advance_state(), p.batch_id)


@query
def last_short_month(p: Plan) -> DataFrame:
    return adv.last_short_month(p.capacity_gap)


# --- stage A: sources and sinks (they write under the session's checkpoint folder) ---------------------------------
@query
def read_source(p: Plan) -> DataFrame:
    """``lineitem`` of the plan horizon read with the projection and the date filter pushed into the scan."""
    from monthplan.sources.fixtures import HORIZON_MONTHS, HORIZON_START, _horizon
    from monthplan.sources.io import read_source as _read

    lo, hi = _horizon(HORIZON_START, HORIZON_MONTHS)
    df = _read(p.spark, "parquet", path=f"{p.sf_dir.rstrip('/')}/lineitem.parquet",
               columns=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"],
               predicate=(F.col("l_shipdate") >= F.lit(lo)) & (F.col("l_shipdate") < F.lit(hi)))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     F.to_date("l_shipdate").alias("ship_date"))


@query
def parquet_roundtrip(p: Plan) -> DataFrame:
    """The loaded month demand written as a batch-partitioned parquet table + view, read through the view."""
    from monthplan.session import scratch_table
    from monthplan.sources.io import write_parquet_view

    path = scratch_table(p.spark, "month_demand")
    view = write_parquet_view(p.demand, path, "month_demand", partition_by=["batch_id"])
    return view.select("batch_id", "stockorg_code", "sku_code", "dt", "demand_qty", "demand_qty_next", "dt2")


@query
def slice_copy(p: Plan) -> DataFrame:
    """The stock-org dimension rows of the run's snapshot day copied to a day-partitioned target table."""
    from monthplan.session import scratch_table
    from monthplan.sources.fixtures import HORIZON_START
    from monthplan.sources.io import copy_slice

    dst = scratch_table(p.spark, "stockorg_copy")
    copy_slice(p.raw("stockorg_dim_raw"), dst, F.col("day_date") == F.lit(HORIZON_START), partition_by=["day_date"])
    return p.spark.read.parquet(dst).select("stockorg_code", "stockorg_name", "parent_org_code", "day_date")


@query
def batch_overwrite(p: Plan) -> DataFrame:
    """A batch-partitioned demand table of three batches; the first is planned anew and replaced, the second stays,
    the third is planned anew with an empty result and goes."""
    from monthplan.session import scratch_table
    from monthplan.sources.io import overwrite_batch
    from monthplan.sources.loaders import load_demand

    cols = ["batch_id", "stockorg_code", "sku_code", "dt", "demand_qty"]
    raw = p.raw("demand_raw")
    own, other, gone = (load_demand(raw, b).select(*cols) for b in (p.batch_id, p.batch_id + 1, p.batch_id + 2))
    stale = own.withColumn("demand_qty", (F.col("demand_qty") * 2).cast("decimal(18,3)"))
    path = scratch_table(p.spark, "batch_demand")
    overwrite_batch(stale, path, p.batch_id)
    overwrite_batch(other, path, p.batch_id + 1)
    overwrite_batch(gone, path, p.batch_id + 2)
    overwrite_batch(own, path, p.batch_id)
    overwrite_batch(gone.limit(0), path, p.batch_id + 2)
    return p.spark.read.parquet(path).select(*cols)
