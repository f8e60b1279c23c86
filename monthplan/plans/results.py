"""T10 / A20 for the whole run: write every result table of one batch, replacing only that batch.

Each table is partitioned by ``batch_id`` and only the batch's folder is replaced, so re-running a batch replaces
exactly its rows (also by none) and leaves other batches alone. Totals are observed during the writes.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from monthplan.operators import advance as adv
from monthplan.plans.inputs import Plan
from monthplan.sources.io import overwrite_batch


def result_tables(plan: Plan) -> dict[str, DataFrame]:
    """The result tables of one batch (the names of the pipeline's outputs)."""
    st = plan.advance_state()
    return {
        "warehouse_sku_todo": plan.todo,
        "sku_linetype": plan.sku_linetype,
        "warehouse_linetype_todo": plan.warehouse_linetype_todo,
        "factory_linetype_todo": plan.factory_linetype_todo,
        "factory_sku_todo": plan.factory_sku_todo,
        "linetype_capacity": plan.linetype_capacity,
        "assigned_capacity": plan.rebalanced,
        "capacity_gap": plan.capacity_gap,
        "early_moves": adv.early_moves(st, plan.batch_id),
        "early_moves_month": adv.early_moves_month(st, plan.batch_id),
        "unfilled_shortage": adv.unfilled_shortage(st, plan.batch_id),
    }


def observed(df: DataFrame, months: Sequence[_dt.date] = (), by: str = "dt") -> tuple[DataFrame, Observation]:
    """``df`` with its rows, and the sum of each quantity column in each plan month, observed while it is written.

    There are as many metrics as quantity columns times plan months: bounded by the horizon, whatever the table's size.
    """
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if by in df.columns:
        sums = [c for c in df.columns if re.fullmatch(r".*(qty|capacity|qty_surplus|qty_shortage)", c)]
        metrics += [F.sum(F.when(F.col(by) == F.lit(m), F.col(c))).alias(f"{c} {m}") for c in sums for m in months]
    return df.observe(seen, *metrics), seen


def month_sums(seen: dict, column: str) -> dict[_dt.date, object]:
    """Month -> observed sum of a column (null where the month has no quantity)."""
    return {_dt.date.fromisoformat(k.rsplit(" ", 1)[1]): v for k, v in seen.items() if k.rsplit(" ", 1)[0] == column}


def write_results(plan: Plan, out_dir: str, metrics: dict[str, dict] | None = None) -> dict[str, str]:
    """Write all result tables of ``plan``'s batch under ``out_dir``; returns table name -> path.

    With ``metrics`` each table's observed rows and monthly sums are put there by name, so the sums per month (B9) and
    the reconciliation of the grains (L12) are known when the write ends, without reading a table again.
    """
    paths = {}
    for name, df in result_tables(plan).items():
        if "batch_id" in df.columns:
            df = df.drop("batch_id")
        path = f"{out_dir.rstrip('/')}/{name}"
        seen = None
        if metrics is not None:
            df, seen = observed(df, plan.months)
        overwrite_batch(df, path, plan.batch_id)
        paths[name] = path
        if seen is not None:
            metrics[name] = seen.get
    return paths


def reconcile(metrics: dict[str, dict]) -> list[dict]:
    """L12 from observed metrics: per month the to-do at three grains, and whether they agree.

    ``sku`` and ``factory_sku`` have to be equal; ``linetype`` may be less by the keys without a line type.
    """
    tables = {"sku": "warehouse_sku_todo", "factory_sku": "factory_sku_todo", "linetype": "factory_linetype_todo"}
    sums = {grain: month_sums(metrics[name], "todo_qty") for grain, name in tables.items()}
    out = []
    for m in sorted(sums["sku"]):
        row = {grain: sums[grain].get(m) or 0 for grain in tables}
        out.append({"dt": m, **row, "agrees": row["sku"] == row["factory_sku"] and row["linetype"] <= row["sku"]})
    return out
