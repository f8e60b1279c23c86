"""Stage C: rebalance line-type capacity against the factory ceiling, carrying unmet to-do one month back.

Per factory, months newest first; inside a month, line types by rank descending (ties: line type ascending):

* a line type whose to-do is NULL or 0 is skipped (no row, no ceiling used);
* ``assigned = min(capacity, ceiling left, to-do)``; the ceiling left shrinks by ``assigned``;
* ``to-do - assigned`` is added to the same line type's to-do one month earlier -- if that row exists and its
  to-do is not NULL (otherwise it is lost, as is the leftover of the first month, exposed as ``todo_left``).

Factories are independent, and a factory holds at most (line types x plan months) rows, a bound set by the plant, not
by the data volume.  So the whole stage is one shuffle by factory and a fold (SQL ``aggregate``) over the factory's
rows in processing order -- JVM-side, no per-row Python, all factories in parallel.  Factories with no ceiling
at all are left out; a missing month of one that has some counts as 0, and so does a NULL capacity.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthplan.functions.months import expand_to_months
from monthplan.functions.quantities import QTY

D = "decimal(38,3)"


def capacity_with_rank(capacity: DataFrame, linetypes: DataFrame) -> DataFrame:
    """G1: line-type capacity with the rank of its line type (taken from the line classification)."""
    rank = linetypes.select("factory_code", "linetype", F.col("linetype_rn").alias("_rn")).distinct()
    return (capacity.select("factory_code", "linetype", "dt", "capacity")
            .join(rank, ["factory_code", "linetype"], "left")
            .select("factory_code", "linetype", "dt", F.col("_rn").alias("linetype_rn"), "capacity"))


def capacity_vs_todo(capacity_ranked: DataFrame, linetype_todo: DataFrame) -> DataFrame:
    """Capacity rows with the factory line-type to-do of the same month (NULL when none)."""
    t = linetype_todo.select("factory_code", "linetype", "dt", F.col("todo_qty").cast(QTY).alias("todo_qty"))
    return (capacity_ranked.join(t, ["factory_code", "linetype", "dt"], "left")
            .select("factory_code", "linetype", "dt", "linetype_rn",
                    F.col("capacity").cast(QTY).alias("line_capacity"), "todo_qty"))


def factory_capacity_month(ceiling: DataFrame, months: Sequence[_dt.date]) -> DataFrame:
    """Factory ceiling per plan month."""
    c = ceiling.select("factory_code", "dt_start", "dt_end", "equilibrium_capacity")
    return (expand_to_months(c, months, "dt_start", "dt_end")
            .select("factory_code", "dt", F.col("equilibrium_capacity").cast(QTY).alias("factory_capacity")))


def _order(share_pure: bool) -> str:
    fam = ("WHEN l.linetype LIKE 'pure-%' AND r.linetype NOT LIKE 'pure-%' THEN -1 "
           "WHEN l.linetype NOT LIKE 'pure-%' AND r.linetype LIKE 'pure-%' THEN 1 ") if share_pure else ""
    return f"""(l, r) -> CASE WHEN l.dt > r.dt THEN -1 WHEN l.dt < r.dt THEN 1
                     WHEN l.rn > r.rn THEN -1 WHEN l.rn < r.rn THEN 1 {fam}
                     WHEN l.linetype < r.linetype THEN -1 WHEN l.linetype > r.linetype THEN 1 ELSE 0 END"""


def let(value_sql: str, var: str, body_sql: str) -> str:
    """SQL ``let``: evaluate ``value_sql`` once, bind it to ``var`` inside ``body_sql``."""
    return f"element_at(transform(array({value_sql}), {var} -> {body_sql}), 1)"


_EMPTY = f"CAST(map() AS map<string,{D}>)"
_OUT_T = f"array<struct<dt:date,linetype:string,capacity:{D},assigned:{D},todo:{D},todo_left:{D}>>"

# month state when row r is reached: carried to-do of r's month, carry being built for the month before, ceiling
# left, spare pure capacity per package
_MONTH = f"""named_struct(
    'cur', CASE WHEN acc.dt IS NULL OR r.dt <> acc.dt
                THEN CASE WHEN r.dt = add_months(acc.dt, -1) THEN acc.nxt ELSE {_EMPTY} END
                ELSE acc.cur END,
    'nxt', CASE WHEN acc.dt IS NULL OR r.dt <> acc.dt THEN {_EMPTY} ELSE acc.nxt END,
    'left', CASE WHEN acc.dt IS NULL OR r.dt <> acc.dt THEN r.ceiling ELSE acc.left END,
    'spare', CASE WHEN acc.dt IS NULL OR r.dt <> acc.dt THEN {_EMPTY} ELSE acc.spare END)"""
_TODO = f"CAST(r.todo + coalesce(try_element_at(m.cur, r.linetype), 0) AS {D})"


def _alloc(share_pure: bool) -> str:
    share = ("CASE WHEN r.linetype LIKE 'ordinary-%' "
             "THEN coalesce(try_element_at(m.spare, substring(r.linetype, 10)), 0) ELSE 0 END") if share_pure else "0"
    return f"""named_struct('share', CAST({share} AS {D}),
                          'assigned', CAST(least(r.capacity + {share}, m.left, t) AS {D}),
                          'skip', t IS NULL OR t = 0)"""


def _next(share_pure: bool) -> str:
    spare = "m.spare"
    if share_pure:
        pure_pkg, ord_pkg = "substring(r.linetype, 6)", "substring(r.linetype, 10)"
        used = f"CAST(CASE WHEN a.skip THEN 0 ELSE a.assigned END AS {D})"
        spare = f"""CASE WHEN r.linetype LIKE 'pure-%'
                         THEN map_concat(map_filter(m.spare, (k, v) -> k <> {pure_pkg}),
                                         map({pure_pkg}, CAST(r.capacity - {used} AS {D})))
                         WHEN r.linetype LIKE 'ordinary-%' AND a.share > 0 AND NOT a.skip
                         THEN map_concat(map_filter(m.spare, (k, v) -> k <> {ord_pkg}),
                                         map({ord_pkg}, CAST(a.share - greatest(a.assigned - r.capacity, 0) AS {D})))
                         ELSE m.spare END"""
    return f"""named_struct(
    'dt', r.dt,
    'left', CASE WHEN a.skip THEN m.left ELSE CAST(m.left - a.assigned AS {D}) END,
    'cur', m.cur,
    'nxt', CASE WHEN NOT a.skip AND t - a.assigned > 0
                THEN map_concat(m.nxt, map(r.linetype, CAST(t - a.assigned AS {D}))) ELSE m.nxt END,
    'spare', {spare},
    'out', CASE WHEN a.skip THEN acc.out
                ELSE concat(acc.out, array(named_struct(
                    'dt', r.dt, 'linetype', r.linetype, 'capacity', r.capacity, 'assigned', a.assigned,
                    'todo', t, 'todo_left', CAST(t - a.assigned AS {D})))) END)"""


def rebalance_fold_sql(share_pure: bool = False) -> str:
    """The per-factory fold (SQL ``aggregate``) over the factory's rows in processing order."""
    return f"""aggregate(
    array_sort(rows, {_order(share_pure)}),
    named_struct('dt', CAST(NULL AS date), 'left', CAST(0 AS {D}), 'cur', {_EMPTY}, 'nxt', {_EMPTY},
                 'spare', {_EMPTY}, 'out', CAST(array() AS {_OUT_T})),
    (acc, r) -> {let(_MONTH, "m", let(_TODO, "t", let(_alloc(share_pure), "a", _next(share_pure))))},
    acc -> acc.out)"""


def rebalance_capacity(cap_todo: DataFrame, ceiling_month: DataFrame, share_pure: bool = False) -> DataFrame:
    """Assigned capacity per (factory, line type, month), months newest first, with carry-back.

    Output: ``factory_code, linetype, dt, capacity, assigned_capacity``, the to-do after carry-back (``todo_qty``)
    and what was left of it (``todo_left``: moved to the month before, or lost when that month has no row).

    ``share_pure=True`` is the documented intent of the spare-pure-capacity rule: inside a rank, pure lines go first,
    and an ordinary line may also use the capacity its package's pure line left spare (a pure line without to-do
    leaves all of it), drawing on its remaining to-do and the remaining ceiling.
    """
    # a factory's ceilings travel as one small array, so both sides meet by factory, as the fold needs them anyway
    ceilings = ceiling_month.groupBy("factory_code").agg(
        F.collect_list(F.struct("dt", F.col("factory_capacity").cast(D).alias("c"))).alias("ceilings"))
    ceiling = F.expr(f"coalesce(array_max(transform(filter(ceilings, x -> x.dt = dt), x -> x.c)), CAST(0 AS {D}))")
    # an unknown rank sorts below every known one: the comparator needs a total order
    rows = (cap_todo.join(ceilings, "factory_code")
            .select("factory_code",
                    F.struct(F.col("dt"), F.coalesce("linetype_rn", F.lit(-(1 << 31))).cast("int").alias("rn"),
                             F.col("linetype"),
                             F.coalesce("line_capacity", F.lit(0)).cast(D).alias("capacity"),
                             F.col("todo_qty").cast(D).alias("todo"), ceiling.alias("ceiling")).alias("r")))
    per_factory = rows.groupBy("factory_code").agg(F.collect_list("r").alias("rows"))
    out = per_factory.select("factory_code", F.explode(F.expr(rebalance_fold_sql(share_pure))).alias("o"))
    return out.select("factory_code", "o.linetype", "o.dt",
                      F.col("o.capacity").cast(QTY).alias("capacity"),
                      F.col("o.assigned").cast(QTY).alias("assigned_capacity"),
                      F.col("o.todo").cast(QTY).alias("todo_qty"),
                      F.col("o.todo_left").cast(QTY).alias("todo_left"))


def capacity_gap(cap_todo: DataFrame) -> DataFrame:
    """Surplus and shortage of each line type against its to-do (a missing to-do counts as 0)."""
    cap = F.coalesce("line_capacity", F.lit(0))
    todo = F.coalesce("todo_qty", F.lit(0))
    return cap_todo.select("factory_code", "linetype", "dt",
                           F.greatest(cap - todo, F.lit(0)).cast(QTY).alias("qty_surplus"),
                           F.greatest(todo - cap, F.lit(0)).cast(QTY).alias("qty_shortage"))
