"""Stage D: cover line-type shortages from spare capacity, moving what is left to earlier months.

Months run newest first, per factory.  In month ``m``:

* T1 shortage per line type = that month's gap rows with a shortage, plus the shortage carried from ``m + 1``;
* T2/T3 the factory cap on moves = the total carried into ``m`` (NULL in the last month: nothing carried);
* T4-T6 donor rounds, in order, for (needy, donor) pairs: ``move = least(donor surplus, cap, shortage)``, skipped
  when the donor has no positive surplus; the needy shortage shrinks after each round; the cap does not;
* T5 special lines last, same line type as donor, only when the cap is positive;
* T7 what is still short moves to ``m - 1``; T8 those carries are the month-to-move rows (except after the first
  month); T9 what is left after the first month is written as ``qty_left`` on the factory's rows of that line type.

The donor surplus is not reduced between rounds (``consume_surplus=False``, the literal rule; one surplus can then be
promised to two line types); ``consume_surplus=True`` conserves it.

Every factory is independent, and a factory holds at most (line types x plan months) gap rows -- a bound of the
plant, not of the data.  So the stage is one shuffle by factory, then a fold over the plan months (SQL
``aggregate``) with an inner fold over the donor rounds; all JVM-side.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthplan.functions.quantities import QTY
from monthplan.operators.rebalance import let

D = "decimal(38,3)"

# The donor rounds of one month, in order, as (line type short of capacity, line type giving it).
# Ordinary lines may use spare pure capacity; pure lines never use ordinary capacity.
DONOR_ROUNDS = (
    ("pure-can", "pure-can"),
    ("ordinary-can", "ordinary-can"),
    ("ordinary-can", "pure-can"),
    ("pure-bottle", "pure-bottle"),
    ("ordinary-bottle", "ordinary-bottle"),
    ("ordinary-bottle", "pure-bottle"),
)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rounds_sql(rounds: Sequence[tuple[str, str]], special_lines: Sequence[str]) -> str:
    items = [f"named_struct('needy', {_sql_str(a)}, 'donor', {_sql_str(b)}, 'need_cap', false)" for a, b in rounds]
    items += [f"named_struct('needy', {_sql_str(x)}, 'donor', {_sql_str(x)}, 'need_cap', true)"
              for x in special_lines]
    return "array(" + ", ".join(items) + ")"


def _months_desc_sql(months: Sequence[_dt.date]) -> str:
    return "array(" + ", ".join(f"DATE'{m.isoformat()}'" for m in sorted(months, reverse=True)) + ")"


_MAP_T = f"map<string,{D}>"
_EMPTY = f"CAST(map() AS {_MAP_T})"
_MOVES_T = f"array<struct<dt:date,linetype:string,linetype2:string,qty:{D}>>"
_TOMOVE_T = f"array<struct<dt:date,linetype:string,qty:{D}>>"
_SHORT_T = f"array<struct<dt:date,linetype:string,qty_shortage:{D},qty_gap:{D}>>"


def _upsert(map_sql: str, key_sql: str, value_sql: str) -> str:
    return f"map_concat(map_filter({map_sql}, (k, v) -> k <> {key_sql}), map({key_sql}, CAST({value_sql} AS {D})))"


def advance_fold_sql(months: Sequence[_dt.date], rounds: Sequence[tuple[str, str]], special_lines: Sequence[str],
                     consume_surplus: bool = False) -> str:
    first = min(months)
    # one donor round: st = (S shortage map, U surplus map, moves), rd = round; bound: s, u, mv
    round_body = let(
        "named_struct('s', try_element_at(st.S, rd.needy), 'u', try_element_at(st.U, rd.donor))", "b",
        let(f"CASE WHEN b.s IS NOT NULL AND b.u > 0 AND (NOT rd.need_cap OR mo.cap > 0) "
            f"THEN CAST(least(b.u, mo.cap, b.s) AS {D}) END", "mv",
            f"""named_struct(
                'S', CASE WHEN mv > 0 THEN {_upsert('st.S', 'rd.needy', 'b.s - mv')} ELSE st.S END,
                'U', CASE WHEN {str(consume_surplus).lower()} AND mv > 0
                          THEN {_upsert('st.U', 'rd.donor', 'b.u - mv')} ELSE st.U END,
                'moves', CASE WHEN mv > 0 THEN concat(st.moves, array(named_struct(
                                  'dt', mo.dt, 'linetype', rd.needy, 'linetype2', rd.donor, 'qty', mv)))
                              ELSE st.moves END)"""))
    month_vals = f"""named_struct(
        'dt', m,
        'S', map_zip_with(
                 map_from_entries(transform(filter(rows, g -> g.dt = m AND g.shortage > 0),
                                            g -> struct(g.linetype, g.shortage))),
                 acc.carry, (k, v1, v2) -> CAST(coalesce(v1, 0) + coalesce(v2, 0) AS {D})),
        'U', map_from_entries(transform(filter(rows, g -> g.dt = m AND g.surplus > 0),
                                        g -> struct(g.linetype, g.surplus))),
        'cap', CASE WHEN cardinality(acc.carry) > 0
                    THEN aggregate(map_values(acc.carry), CAST(0 AS {D}), (s, v) -> CAST(s + v AS {D})) END)"""
    after_rounds = let(
        f"aggregate({_rounds_sql(rounds, special_lines)}, "
        f"named_struct('S', mo.S, 'U', mo.U, 'moves', acc.moves), (st, rd) -> {round_body})", "fin",
        let("map_filter(fin.S, (k, v) -> v > 0)", "rest",
            f"""named_struct(
                'carry', rest,
                'moves', fin.moves,
                'tomove', CASE WHEN mo.dt = DATE'{first.isoformat()}' THEN acc.tomove
                               ELSE concat(acc.tomove, transform(map_entries(rest), e -> named_struct(
                                   'dt', add_months(mo.dt, -1), 'linetype', e.key, 'qty', e.value))) END,
                'shortage', concat(acc.shortage, transform(map_entries(mo.S), e -> named_struct(
                                   'dt', mo.dt, 'linetype', e.key, 'qty_shortage', e.value, 'qty_gap', mo.cap))))"""))
    return f"""aggregate(
        {_months_desc_sql(months)},
        named_struct('carry', {_EMPTY}, 'moves', CAST(array() AS {_MOVES_T}),
                     'tomove', CAST(array() AS {_TOMOVE_T}), 'shortage', CAST(array() AS {_SHORT_T})),
        (acc, m) -> {let(month_vals, "mo", after_rounds)})"""


def advance_state(gap: DataFrame, months: Sequence[_dt.date], special_lines: Sequence[str],
                  rounds: Sequence[tuple[str, str]] = DONOR_ROUNDS, consume_surplus: bool = False) -> DataFrame:
    """One row per factory with the folded state (several gap rows of a line type and month are summed first): ``carry`` (left after the first month), ``moves``, ``tomove``,
    ``shortage`` (T1-T3 rows of every month)."""
    summed = gap.groupBy("factory_code", "linetype", "dt").agg(
        F.sum("qty_surplus").alias("qty_surplus"), F.sum("qty_shortage").alias("qty_shortage"))
    rows = summed.select("factory_code", F.struct(
        "dt", "linetype", F.col("qty_surplus").cast(D).alias("surplus"),
        F.col("qty_shortage").cast(D).alias("shortage")).alias("g"))
    per_factory = rows.groupBy("factory_code").agg(F.collect_list("g").alias("rows"))
    fold = advance_fold_sql(months, rounds, special_lines, consume_surplus)
    return per_factory.select("factory_code", F.expr(fold).alias("st"))


def early_moves(state: DataFrame, batch_id: int) -> DataFrame:
    """Every move with a positive quantity, tagged with the batch."""
    return (state.select("factory_code", F.explode("st.moves").alias("m"))
            .select("factory_code", "m.linetype", "m.linetype2", "m.dt",
                    F.col("m.qty").cast(QTY).alias("qty_tomove"), F.lit(batch_id).alias("batch_id")))


def early_moves_month(state: DataFrame, batch_id: int) -> DataFrame:
    """Shortage moved to the month before, per month, with what is left after the first month."""
    rows = state.select("factory_code", "st.carry", F.explode("st.tomove").alias("t"))
    return rows.select("factory_code", "t.linetype", "t.dt", F.col("t.qty").cast(QTY).alias("qty_tomove"),
                       F.coalesce(F.try_element_at("carry", F.col("t.linetype")), F.lit(0)).cast(QTY)
                       .alias("qty_left"),
                       F.lit(batch_id).alias("batch_id"))


def unfilled_shortage(state: DataFrame, batch_id: int) -> DataFrame:
    """T9, whole: every shortage left after the first month, also where nothing was moved on the way."""
    return (state.select("factory_code", F.explode("st.carry").alias("linetype", "qty"))
            .select("factory_code", "linetype", F.col("qty").cast(QTY).alias("qty_left"),
                    F.lit(batch_id).alias("batch_id")))


def month_shortage(state: DataFrame) -> DataFrame:
    """Shortage per (factory, line type, month) incl. carried shortage, with the factory cap on moves."""
    return (state.select("factory_code", F.explode("st.shortage").alias("s"))
            .select("factory_code", "s.linetype", "s.dt", F.col("s.qty_shortage").cast(QTY).alias("qty_shortage"),
                    F.col("s.qty_gap").cast(QTY).alias("qty_gap")))


def last_short_month(gap: DataFrame) -> DataFrame:
    """The last month each (factory, line type) is short; moves inside it are not early production."""
    return (gap.where(F.col("qty_shortage") > 0).groupBy("factory_code", "linetype")
            .agg(F.max("dt").alias("dt")))
