"""Benchmark: the planning pipeline stage by stage on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Stages (each timed separately, warm JVM, one batch):
  load                   -- fixtures -> the loaded input tables, written once as parquet (stage A)
  inventory_rollforward  -- demand, transfers, safety stock, month-by-month stock roll-forward (stage B)
  factory_linetype_todo  -- line types, line-type capacity, to-do by factory and line type (stage B2)
  factory_sku_todo       -- to-do charged to the producing factory and SKU (stage B2)
  rebalance_capacity     -- capacity vs ceiling with carry-back (stage C)
  early_moves     -- shortage moves to earlier months / other line types (stage D)
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from monthplan.plans.inputs import Plan  # noqa: E402
from monthplan.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="monthplan-bench",
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG"))  # stage/task times, no web UI

    # warm-up on the smallest data so JVM start-up and code generation are not charged to the first stage
    warm = Plan(spark, "/root/testdata/sf0.001", materialize=True)
    warm.best_transfer.count()

    p = Plan(spark, sf_dir, materialize=True)
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def stage(name, fn):
        t = time.perf_counter()
        df = fn()
        rows[name] = df.count()
        times[name] = round(time.perf_counter() - t, 3)

    def load():
        p.build(p.LOADED)  # the calendar is one of them; the plan months are collected from it afterwards
        p.months
        return p.demand

    stage("load", load)
    stage("inventory_rollforward", lambda: p.todo)
    stage("factory_linetype_todo", lambda: p.factory_linetype_todo)
    stage("factory_sku_todo", lambda: p.factory_sku_todo)
    stage("rebalance_capacity", lambda: p.rebalanced)
    stage("early_moves", lambda: p.advance_state())
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "planning_total", "value": total, "unit": "sec", "queries": times,
                      "rows": rows, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
