"""One batch of the plan over the raw fixtures of a test-data folder.

``PlanInputs`` holds the loaded tables (A1-A13), ``Plan`` adds the stage outputs; both are lazy properties memoised
per instance, so a query that needs, say, the roll-forward builds it once.  With ``materialize=True`` the loaded
tables and the stage outputs read by several later stages are written once (the load step).
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from monthplan.functions.months import plan_months
from monthplan.sources import fixtures as fx
from monthplan.sources import loaders as ld


class PlanInputs:
    """Loaded tables of one batch.

    With ``materialize=True`` every loaded table (and the stage outputs read by more than one later stage) is
    written once as parquet under the session's checkpoint folder and read back -- the load step of the pipeline.
    Later plans then start from small parquet scans instead of re-deriving their inputs, and a lost executor never
    sends a stage back past a written table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, batch_id: int = fx.BATCH, rate_end: str = "start",
                 special_lines: tuple[str, ...] = fx.SPECIAL_LINES, materialize: bool = False, run: str | None = None):
        """``run`` names the roll-forward's run: a plan that ended half-way goes on where its ledger ends."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.batch_id = batch_id
        self.rate_end = rate_end
        self.special_lines = special_lines
        self.materialize = materialize
        self.run = run
        self.tag = f"plan{uuid.uuid4().hex[:12]}"  # the catalog entries of its bucketed tables
        self._folder: str | None = None
        self._guard = threading.Lock()
        self._locks: dict[str, threading.Lock] = {}
        self._kept: dict[str, DataFrame] = {}
        self._states: dict[str, DataFrame] = {}
        if materialize:
            from monthplan.session import scratch_table
            self._folder = scratch_table(spark, "load")
        self.t = fx.Tables(spark, sf_dir, keep=self.keep if materialize else None)

    def keep(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` to the load folder and read it back (only when materialising)."""
        if not self.materialize:
            return df
        with self._guard:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:  # one writer per table, even when two threads reach it first together
            if name not in self._kept:
                path = f"{self._folder}/{name}"
                writer = df.write.mode("overwrite")
                (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
                # with its schema: a table without rows has no folder to tell the partition columns from
                self._kept[name] = self.spark.read.schema(df.schema).parquet(path)
            return self._kept[name]

    LOADED = ("calendar", "opening_stock", "producibility", "safety_rules", "routes", "demand", "line_info",
              "line_hours", "production_rates", "line_priority", "org_snapshot", "factory_capacity")

    def build(self, names, threads: int = 8) -> None:
        """Build (and, when materialising, write) independent tables concurrently.

        Each table is its own Spark job submitted from its own driver thread, so small jobs overlap instead of
        queueing; on a cluster the scheduler interleaves their tasks.
        """
        from concurrent.futures import ThreadPoolExecutor

        names = list(names)
        if threads <= 1 or len(names) <= 1:
            for n in names:
                getattr(self, n)
            return
        with ThreadPoolExecutor(max_workers=min(threads, len(names))) as pool:
            for f in [pool.submit(getattr, self, n) for n in names]:
                f.result()

    # raw (warehouse-shaped) tables
    def raw(self, name: str) -> DataFrame:
        return fx.RAW_TABLES[name](self.t)

    # A1-A13 loaded tables
    @cached_property
    def calendar(self) -> DataFrame:
        return self.keep("calendar", ld.load_plan_calendar(self.raw("plan_config_raw"), self.batch_id))

    @cached_property
    def months(self) -> list[_dt.date]:
        return plan_months(self.calendar)

    @cached_property
    def opening_stock(self) -> DataFrame:
        return self.keep("opening_stock", ld.load_opening_stock(self.raw("stock_raw"), self.batch_id))

    @cached_property
    def producibility(self) -> DataFrame:
        return self.keep("producibility", ld.load_producibility(self.raw("producibility_raw"), self.batch_id))

    @cached_property
    def safety_rules(self) -> DataFrame:
        return self.keep("safety_rules", ld.load_safety_rules(self.raw("safety_raw"), self.batch_id))

    @cached_property
    def routes(self) -> DataFrame:
        return self.keep("routes", ld.load_transfer_routes(self.raw("route_raw"), self.batch_id))

    @cached_property
    def demand(self) -> DataFrame:
        return self.keep("demand", ld.load_demand(self.raw("demand_raw"), self.batch_id))

    @cached_property
    def line_info(self) -> DataFrame:
        return self.keep("line_info", ld.load_line_info(self.raw("line_info_raw"), self.batch_id))

    @cached_property
    def line_hours(self) -> DataFrame:
        return self.keep("line_hours", ld.load_line_hours(self.raw("line_capacity_raw"), self.batch_id))

    @cached_property
    def production_rates(self) -> DataFrame:
        return self.keep("production_rates", ld.load_production_rates(self.raw("rate_raw"), self.batch_id, self.rate_end))

    @cached_property
    def line_priority(self) -> DataFrame:
        return self.keep("line_priority", ld.load_line_priority(self.raw("priority_raw"), self.batch_id))

    @cached_property
    def org_snapshot(self) -> DataFrame:
        return self.keep("org_snapshot", ld.load_org_snapshot(self.raw("stockorg_dim_raw"), self.raw("plan_config_raw"), self.batch_id))

    @cached_property
    def factory_capacity(self) -> DataFrame:
        return self.keep("factory_capacity", ld.load_factory_capacity(self.raw("factory_capacity_raw"), self.batch_id))


class Plan(PlanInputs):
    """The stage outputs of one batch, each built once per instance."""

    # stage B1
    @cached_property
    def coverage(self) -> DataFrame:
        """When each (stock org, SKU) can be made: written once in buckets of the key, read by B1, B2 and B8."""
        from monthplan.operators.demand import coverage_index
        from monthplan.sources.buckets import BucketStore
        if not self.materialize:
            return coverage_index(self.producibility)
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        store = BucketStore(self.spark, f"{self._folder}/bucketed", ["stockorg_code", "sku_code"], n, self.tag)
        return store.table("coverage", lambda: coverage_index(self.producibility), spread=True)

    @cached_property
    def unproducible(self) -> DataFrame:
        from monthplan.operators.demand import unproducible_demand
        return unproducible_demand(self.demand, self.coverage)

    @cached_property
    def viable_routes(self) -> DataFrame:
        from monthplan.operators.demand import viable_routes
        return viable_routes(self.routes, self.coverage)

    @cached_property
    def best_transfer(self) -> DataFrame:
        from monthplan.operators.demand import best_transfer
        return self.keep("best_transfer", best_transfer(self.unproducible, self.viable_routes))

    @cached_property
    def safety(self) -> DataFrame:
        from monthplan.operators.demand import safety_stock
        return self.keep("safety", safety_stock(self.calendar, self.months, self.safety_rules, self.demand))

    @cached_property
    def stock0(self) -> DataFrame:
        from monthplan.operators.demand import first_month_stock
        return first_month_stock(self.opening_stock, self.months)

    @cached_property
    def todo(self) -> DataFrame:
        """B8 roll-forward (materialised month by month in the checkpoint folder)."""
        from monthplan.operators.rollforward import rollforward
        self.months
        self.build(["best_transfer", "safety", "stock0"])  # the first of them builds the coverage index
        return rollforward(self.months, self.stock0, self.demand, self.coverage, self.best_transfer, self.safety,
                           run=self.run, tag=self.tag)

    # stage B2 (line types)
    @cached_property
    def linetypes(self) -> DataFrame:
        from monthplan.operators.linetypes import classify_lines
        return classify_lines(self.line_info, self.special_lines)

    @cached_property
    def preferred(self) -> DataFrame:
        from monthplan.operators import linetypes as lt
        return lt.preferred_line(lt.producible_months(self.producibility, self.months), self.line_priority,
                                 self.linetypes)

    @cached_property
    def sku_linetype(self) -> DataFrame:
        from monthplan.operators.linetypes import sku_line_type
        return self.keep("sku_linetype", sku_line_type(self.preferred))

    @cached_property
    def rate_avg(self) -> DataFrame:
        from monthplan.operators import linetypes as lt
        return lt.line_rate_avg(lt.line_rates_month(self.production_rates, self.months), self.linetypes)

    @cached_property
    def linetype_capacity(self) -> DataFrame:
        from monthplan.operators import linetypes as lt
        return self.keep("linetype_capacity",
                         lt.linetype_capacity(lt.line_hours_month(self.line_hours, self.months), self.rate_avg))

    @cached_property
    def rollups(self) -> DataFrame:
        """L5, L11 and the monthly totals from one pass over the to-do, a folder for each grain."""
        from monthplan.operators.linetypes import todo_rollups
        return self.keep("rollups", todo_rollups(self.todo, self.sku_linetype, self.best_transfer), ("grain",))

    @cached_property
    def warehouse_linetype_todo(self) -> DataFrame:
        from monthplan.operators.linetypes import QTY_COLUMNS
        return self.rollups.where("grain = 'linetype'").select("stockorg_code", "linetype", "dt", *QTY_COLUMNS)

    @cached_property
    def factory_linetype_todo(self) -> DataFrame:
        from monthplan.operators.linetypes import factory_linetype_todo
        return self.keep("factory_linetype_todo", factory_linetype_todo(self.warehouse_linetype_todo, self.org_snapshot))

    @cached_property
    def factory_sku_todo(self) -> DataFrame:
        from monthplan.operators.linetypes import QTY_COLUMNS
        return self.rollups.where("grain = 'factory_sku'").select("factory_code", "dt", "sku_code", "linetype", *QTY_COLUMNS)

    # stage C (rebalance)
    @cached_property
    def capacity_table(self) -> DataFrame:
        """Line-type capacity as the rebalance stage loads it (A14), from a table that holds several batches."""
        from monthplan.sources.loaders import load_linetype_capacity
        return load_linetype_capacity(fx.linetype_capacity_raw(self.linetype_capacity), self.batch_id)

    @cached_property
    def cap_todo(self) -> DataFrame:
        from monthplan.operators import rebalance as rb
        return self.keep("cap_todo", rb.capacity_vs_todo(rb.capacity_with_rank(self.capacity_table, self.linetypes),
                                                         self.factory_linetype_todo))

    @cached_property
    def ceiling_month(self) -> DataFrame:
        from monthplan.operators.rebalance import factory_capacity_month
        return factory_capacity_month(self.factory_capacity, self.months)

    @cached_property
    def rebalanced(self) -> DataFrame:
        from monthplan.operators.rebalance import rebalance_capacity
        return rebalance_capacity(self.cap_todo, self.ceiling_month)

    @cached_property
    def capacity_gap(self) -> DataFrame:
        """G9 as stage D loads it (A12), from a table that holds several batches and some rows twice."""
        from monthplan.operators.rebalance import capacity_gap
        from monthplan.sources.loaders import load_capacity_gap
        return self.keep("capacity_gap", load_capacity_gap(fx.capacity_gap_raw(capacity_gap(self.cap_todo)), self.batch_id))

    # stage D (advance production)
    def advance_state(self, consume_surplus: bool = False) -> DataFrame:
        """The fold over the months, written once for all that read it."""
        from monthplan.operators.advance import advance_state
        name = f"advance_state_{consume_surplus}".lower()
        if name not in self._states:
            self._states[name] = self.keep(name, advance_state(self.capacity_gap, self.months, self.special_lines,
                                                               consume_surplus=consume_surplus))
        return self._states[name]

    def close(self) -> None:
        """Delete the written tables of this plan; DataFrames read from them can't be used any more."""
        from monthplan.sources.buckets import release
        release(self.spark, self.tag)
        if self._folder:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
