"""Hand-made frames for the edges the derived test data does not reach."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthplan.functions.months import expand_to_months, plan_months
from monthplan.operators import advance as adv
from monthplan.operators import demand as dm
from monthplan.operators import rebalance as rb
from monthplan.operators import rollforward as rf

J, FEB, MAR, APR = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2024, 4, 1)
Q = T.DecimalType(18, 3)

PROD_T = T.StructType([T.StructField(c, T.StringType()) for c in ("factory_code", "line_code", "sku_code")]
                      + [T.StructField("dt_start", T.DateType()), T.StructField("dt_end", T.DateType()),
                         T.StructField("stockorg_code", T.StringType())])
DEMAND_T = T.StructType([T.StructField("stockorg_code", T.StringType()), T.StructField("sku_code", T.StringType()),
                         T.StructField("dt", T.DateType()), T.StructField("demand_qty", Q)])
ROUTE_T = T.StructType([T.StructField(c, T.StringType()) for c in
                        ("receive_sku_code", "receive_stockorg_code", "send_sku_code", "send_stockorg_code")]
                       + [T.StructField("priority", T.IntegerType()), T.StructField("dt", T.DateType())])
SAFETY_T = T.StructType([T.StructField("stockorg_code", T.StringType()), T.StructField("sku_code", T.StringType()),
                         T.StructField("dt", T.DateType()), T.StructField("safety_stock_qty", Q)])
STOCK_T = T.StructType([T.StructField("stockorg_code", T.StringType()), T.StructField("sku_code", T.StringType()),
                        T.StructField("begin_stock_qty", Q), T.StructField("dt", T.DateType())])


def D(x):
    return Decimal(str(x)).quantize(Decimal("0.001"))


def test_interval_is_half_open(spark):
    prod = spark.createDataFrame([("F1", "L1", "S1", J, MAR, "warehouse.F1")], PROD_T)
    demand = spark.createDataFrame([("warehouse.F1", "S1", m, D(5)) for m in (J, FEB, MAR)], DEMAND_T)
    got = {r.dt for r in dm.unproducible_demand(demand, prod).collect()}
    assert got == {MAR}  # the end month is outside, the start month inside


def test_best_transfer_breaks_priority_ties_by_sender(spark):
    prod = spark.createDataFrame([("FA", "L", "S1", J, MAR, "warehouse.FA"), ("FB", "L", "S1", J, MAR, "warehouse.FB")],
                                 PROD_T)
    demand = spark.createDataFrame([("warehouse.FX", "S1", J, D(7))], DEMAND_T)
    routes = spark.createDataFrame([("S1", "warehouse.FX", "S1", "warehouse.FB", 1, J),
                                    ("S1", "warehouse.FX", "S1", "warehouse.FA", 1, J),
                                    ("S1", "warehouse.FX", "S1", "warehouse.FC", 0, J)], ROUTE_T)  # FC cannot make it
    best = dm.best_transfer(dm.unproducible_demand(demand, prod), dm.viable_routes(routes, prod)).collect()
    assert [(r.send_stockorg_code, r.priority) for r in best] == [("warehouse.FA", 1)]


@pytest.mark.parametrize("buckets", [None, 1, 5])
def test_rollforward_with_role_switch(spark, buckets):
    # R receives from B in January; in February R can produce and B cannot, so B receives from R.
    prod = spark.createDataFrame([("FB", "L", "S1", J, FEB, "warehouse.FB"), ("FR", "L", "S1", FEB, MAR, "warehouse.FR")],
                                 PROD_T)
    demand = spark.createDataFrame([("warehouse.FR", "S1", J, D(10)), ("warehouse.FR", "S1", FEB, D(5)),
                                    ("warehouse.FB", "S1", FEB, D(3))], DEMAND_T)
    routes = spark.createDataFrame([("S1", "warehouse.FR", "S1", "warehouse.FB", 1, J),
                                    ("S1", "warehouse.FB", "S1", "warehouse.FR", 1, FEB)], ROUTE_T)
    stock0 = spark.createDataFrame([("warehouse.FR", "S1", D(4), J), ("warehouse.FB", "S1", D(0), J)], STOCK_T)
    safety = spark.createDataFrame([], SAFETY_T)
    best = dm.best_transfer(dm.unproducible_demand(demand, prod), dm.viable_routes(routes, prod))
    out = rf.rollforward([J, FEB], stock0, demand, prod, best, safety, buckets=buckets)
    got = {(r.stockorg_code, r.dt): (r.begin_stock_qty, r.demand_qty, r.production_qty, r.trans_in_qty,
                                     r.trans_out_qty, r.todo_qty, r.end_stock_qty) for r in out.collect()}
    assert got == {
        ("warehouse.FR", J): (D(4), D(10), D(0), D(6), D(0), D(0), D(0)),
        ("warehouse.FB", J): (D(0), D(0), D(0), D(0), D(6), D(6), D(0)),
        ("warehouse.FR", FEB): (D(0), D(5), D(5), D(0), D(3), D(8), D(0)),
        ("warehouse.FB", FEB): (D(0), D(3), D(0), D(3), D(0), D(0), D(0)),
    }


def test_calendar_gap_is_rejected(spark):
    cal = spark.createDataFrame([(J,), (MAR,)], "dt date")
    with pytest.raises(ValueError):
        plan_months(cal)


def test_reversed_interval_expands_to_nothing(spark):
    df = spark.createDataFrame([(MAR, J), (J, J)], "s date, e date")
    assert expand_to_months(df, [J, FEB, MAR], "s", "e").count() == 0


def test_safety_fallback_and_february(spark):
    cal = spark.createDataFrame([(J, 2), (FEB, 1)], "dt date, dt_rn int")
    rules = spark.createDataFrame([("W", "S1", J, MAR, 4)],
                                  "stockorg_code string, sku_code string, dt_start date, dt_end date, safety_stock_days int")
    # February 2024 has 29 days: January's safety = 29 / 29 * 4 = 4; February repeats January's row.
    demand = spark.createDataFrame([("W", "S1", FEB, D(29))], DEMAND_T)
    got = {(r.dt, r.safety_stock_qty) for r in dm.safety_stock(cal, [J, FEB], rules, demand).collect()}
    assert got == {(J, D(4)), (FEB, D(4))}
    # with real demand past the horizon the last month keeps its own row (no doubling)
    demand2 = spark.createDataFrame([("W", "S1", FEB, D(29)), ("W", "S1", MAR, D(62))], DEMAND_T)
    got2 = sorted((r.dt, r.safety_stock_qty) for r in dm.safety_stock(cal, [J, FEB], rules, demand2).collect())
    assert got2 == [(J, D(4)), (FEB, D(8))]


CAP_T = T.StructType([T.StructField("factory_code", T.StringType()), T.StructField("linetype", T.StringType()),
                      T.StructField("dt", T.DateType()), T.StructField("linetype_rn", T.IntegerType()),
                      T.StructField("line_capacity", Q), T.StructField("todo_qty", Q)])
CEIL_T = T.StructType([T.StructField("factory_code", T.StringType()), T.StructField("dt", T.DateType()),
                       T.StructField("factory_capacity", Q)])


def reference_rebalance(rows, ceilings, share_pure=False):
    """Row-by-row loop: factories, months newest first, lines by rank descending (ties by line type).

    With ``share_pure`` pure lines of a rank go first and an ordinary line may also use the capacity its package's
    pure line left spare."""
    todo = {(f, lt, m): t for f, lt, m, rn, cap, t in rows}
    out = {}
    months = sorted({r[2] for r in rows}, reverse=True)
    fam = (lambda lt: 0 if lt.startswith("pure-") else 1) if share_pure else (lambda lt: 0)
    for f in sorted({r[0] for r in rows}):
        for m in months:
            left = ceilings.get((f, m), Decimal(0))
            spare = {}
            lines = sorted((r for r in rows if r[0] == f and r[2] == m), key=lambda r: (-r[3], fam(r[1]), r[1]))
            for _, lt, _, _, cap, _ in lines:
                t = todo[(f, lt, m)]
                cap = cap if cap is not None else Decimal(0)
                if not t:
                    if share_pure and lt.startswith("pure-"):
                        spare[lt[5:]] = cap
                    continue
                share = spare.get(lt[9:], Decimal(0)) if share_pure and lt.startswith("ordinary-") else Decimal(0)
                assigned = min(cap + share, left, t)
                left -= assigned
                if share_pure and lt.startswith("pure-"):
                    spare[lt[5:]] = cap - assigned
                if share > 0:
                    spare[lt[9:]] = share - max(assigned - cap, Decimal(0))
                out[(f, lt, m)] = (cap, assigned)
                rest = t - assigned
                prev = (f, lt, dt.date(m.year - (m.month == 1), (m.month - 2) % 12 + 1, 1))
                if rest > 0 and prev in todo and todo[prev] is not None:
                    todo[prev] = todo[prev] + rest
    return out


@pytest.mark.parametrize("share_pure", [False, True])
def test_rebalance_matches_row_by_row_loop(spark, share_pure):
    rnd = random.Random(7)
    months = [J, FEB, MAR, APR]
    rows, ceilings = [], {}
    for f in ("F1", "F2", "F3", "F4", "F5", "F6"):
        for lt, rn in (("SPECIAL_X", 1), ("ordinary-can", 2), ("pure-can", 2), ("pure-bottle", 2),
                       ("ordinary-bottle", 2), ("odd", 0)):
            for m in months:
                if rnd.random() < 0.15:
                    continue  # missing month row: carried to-do is lost
                t = rnd.choice([None, D(0), D(rnd.randint(1, 90)), D(rnd.randint(1, 30))])
                cap = rnd.choice([None, D(rnd.randint(0, 50))])
                if share_pure and lt.startswith("ordinary-"):  # short ordinary lines next to idle pure ones
                    t, cap = D(rnd.randint(30, 90)), D(rnd.randint(5, 40))
                elif share_pure and lt.startswith("pure-"):
                    t, cap = rnd.choice([None, D(0), D(rnd.randint(1, 20))]), D(rnd.randint(10, 50))
                rows.append((f, lt, m, rn, cap, t))
        for m in months:
            if rnd.random() < 0.8:
                # roomier ceilings for the spare-pure case, so ordinary lines actually borrow
                ceilings[(f, m)] = D(rnd.randint(0, 400 if share_pure else 120))
    cap_todo = spark.createDataFrame(rows, CAP_T)
    ceil = spark.createDataFrame([(f, m, c) for (f, m), c in ceilings.items()], CEIL_T)
    got = {(r.factory_code, r.linetype, r.dt): (r.capacity, r.assigned_capacity)
           for r in rb.rebalance_capacity(cap_todo, ceil, share_pure=share_pure).collect()}
    assert got == reference_rebalance(rows, ceilings, share_pure)
    # the ceiling is never exceeded
    per_month = {}
    for (f, _, m), (_, a) in got.items():
        per_month[(f, m)] = per_month.get((f, m), 0) + a
    assert all(v <= ceilings.get(k, 0) for k, v in per_month.items())


GAP_T = T.StructType([T.StructField("factory_code", T.StringType()), T.StructField("linetype", T.StringType()),
                      T.StructField("dt", T.DateType()), T.StructField("qty_surplus", Q),
                      T.StructField("qty_shortage", Q)])


def test_advance_rounds_and_carry(spark):
    # March (last): ordinary-can short 10; pure-can spare 4 -> 4 move (no cap in the last month), 6 carried.
    # February: cap = 6; ordinary-can own spare 5 -> 5 moves; 1 carried to January (first month) -> qty_left 1.
    gap = spark.createDataFrame([
        ("F1", "ordinary-can", MAR, D(0), D(10)), ("F1", "pure-can", MAR, D(4), D(0)),
        ("F1", "ordinary-can", FEB, D(5), D(0)), ("F1", "pure-can", FEB, D(0), D(0)),
        ("F1", "SPECIAL_A", FEB, D(9), D(0)),
    ], GAP_T)
    st = adv.advance_state(gap, [J, FEB, MAR], ["SPECIAL_A"])
    moves = sorted((r.linetype, r.linetype2, r.dt, r.qty_tomove) for r in adv.early_moves(st, 1).collect())
    assert moves == [("ordinary-can", "ordinary-can", FEB, D(5)), ("ordinary-can", "pure-can", MAR, D(4))]
    tomove = sorted((r.linetype, r.dt, r.qty_tomove, r.qty_left) for r in adv.early_moves_month(st, 1).collect())
    assert tomove == [("ordinary-can", J, D(1), D(1)), ("ordinary-can", FEB, D(6), D(1))]


def test_advance_literal_overpromises_and_conserving_mode_does_not(spark):
    # one pure-can surplus of 5 in the last month, two needy line types of 5 each
    gap = spark.createDataFrame([
        ("F1", "pure-can", MAR, D(5), D(0)), ("F1", "ordinary-can", MAR, D(0), D(5)),
        ("F1", "pure-bottle", MAR, D(0), D(0)),
    ], GAP_T)
    gap2 = gap.unionByName(spark.createDataFrame([("F1", "SPECIAL_A", MAR, D(0), D(5))], GAP_T))
    literal = adv.early_moves(adv.advance_state(gap2, [FEB, MAR], ["SPECIAL_A"]), 1)
    assert literal.agg(F.sum("qty_tomove")).first()[0] == D(5)
    gap3 = spark.createDataFrame([
        ("F1", "pure-can", MAR, D(5), D(3)), ("F1", "ordinary-can", MAR, D(0), D(5)),
    ], GAP_T)
    lit = adv.early_moves(adv.advance_state(gap3, [FEB, MAR], []), 1)
    cons = adv.early_moves(adv.advance_state(gap3, [FEB, MAR], [], consume_surplus=True), 1)
    # literal: pure-can takes 3 of its own 5, ordinary-can is still offered all 5 -> 8 promised from a surplus of 5
    assert lit.agg(F.sum("qty_tomove")).first()[0] == D(8)
    assert cons.agg(F.sum("qty_tomove")).first()[0] == D(5)


def test_line_classification_ranks(spark):
    from monthplan.operators.linetypes import classify_lines

    lines = spark.createDataFrame([("F1", "L0", "Y", "bottle"), ("F1", "L1", "N", "can"), ("F1", "L2", "N", "keg"),
                                   ("F1", "SPECIAL_A", "Y", "can")],
                                  "factory_code string, line_code string, is_pure_draft string, package_type string")
    got = {(r.line_code, r.linetype, r.linetype_rn) for r in classify_lines(lines, ["SPECIAL_A"]).collect()}
    assert got == {("L0", "pure-bottle", 2), ("L1", "ordinary-can", 2), ("L2", "ordinary-keg", 0),
                   ("SPECIAL_A", "SPECIAL_A", 1)}
    # the SKU line type is the minimum label: special < ordinary < pure
    assert sorted(["pure-can", "ordinary-can", "SPECIAL_A"]) == ["SPECIAL_A", "ordinary-can", "pure-can"]


def test_rate_interval_end_options(spark):
    from monthplan.operators.linetypes import line_rates_month
    from monthplan.sources.loaders import load_production_rates

    raw = spark.createDataFrame([(1, "F1", "L0", D(2), 2024, 1, 2024, 2), (1, "F1", "L0", D(0), 2024, 1, 2024, 3)],
                                "batch_id int, factory_code string, line_code string, production_rate decimal(18,3), "
                                "start_year int, start_month int, end_year int, end_month int")
    literal = load_production_rates(raw, 1)  # end built from the start month: live one month
    fixed = load_production_rates(raw, 1, rate_end="end")  # stored end month, inclusive
    assert literal.count() == 1  # the zero rate is dropped
    assert [r.dt for r in line_rates_month(literal, [J, FEB, MAR]).collect()] == [J]
    assert sorted(r.dt for r in line_rates_month(fixed, [J, FEB, MAR]).collect()) == [J, FEB]


def test_demand_next_month_needs_adjacent_month(spark):
    from monthplan.sources.loaders import load_demand

    raw = spark.createDataFrame([(1, "W", "S1", 2024, 1, D(5), 10), (1, "W", "S1", 2024, 3, D(7), 10),
                                 (1, "W", "S1", 2024, 4, D(9), 10), (1, "W", "S1", 2024, 4, D(1), 20)],
                                "batch_id int, stockorg_code string, sku_code string, year int, month int, "
                                "demand_qty decimal(18,3), demand_type int")
    got = sorted((r.dt, r.demand_qty_next, r.dt2) for r in load_demand(raw, 1).collect())
    # January has no February row: falls back to itself; March is followed by April
    assert got == [(J, D(5), J), (MAR, D(9), APR), (APR, D(9), APR)]


def reference_advance(rows, months, specials, consume):
    """Plain loop over one factory at a time: months newest first, donor rounds in order."""
    rounds = [(a, b, False) for a, b in adv.DONOR_ROUNDS] + [(x, x, True) for x in specials]
    first = min(months)
    moves, tomove, left = set(), set(), {}
    for f in sorted({r[0] for r in rows}):
        carry = {}
        for m in sorted(months, reverse=True):
            short, surplus = {}, {}
            for ff, lt, mm, su, sh in rows:
                if ff == f and mm == m and sh > 0:
                    short[lt] = short.get(lt, 0) + sh
                if ff == f and mm == m and su > 0:
                    surplus[lt] = su
            for lt, q in carry.items():
                short[lt] = short.get(lt, 0) + q
            cap = sum(carry.values()) if carry else None
            for a, b, need_cap in rounds:
                if a not in short or surplus.get(b, 0) <= 0 or (need_cap and not (cap is not None and cap > 0)):
                    continue
                mv = min(x for x in (surplus[b], cap, short[a]) if x is not None)
                if mv > 0:
                    moves.add((f, a, b, m, mv))
                    short[a] -= mv
                    if consume:
                        surplus[b] -= mv
            carry = {lt: q for lt, q in short.items() if q > 0}
            if m != first:
                prev = dt.date(m.year - (m.month == 1), (m.month - 2) % 12 + 1, 1)
                tomove |= {(f, lt, prev, q) for lt, q in carry.items()}
        left[f] = carry
    tomove = {(f, lt, d, q, left[f].get(lt, Decimal(0))) for f, lt, d, q in tomove}
    return moves, tomove


@pytest.mark.parametrize("consume", [False, True])
def test_advance_matches_plain_loop(spark, consume):
    rnd = random.Random(11 if consume else 5)
    months = [J, FEB, MAR, APR]
    types = ["pure-can", "ordinary-can", "pure-bottle", "ordinary-bottle", "SPECIAL_A", "other"]
    rows = []
    for f in ("F1", "F2", "F3", "F4", "F5"):
        for lt in types:
            for m in months:
                if rnd.random() < 0.2:
                    continue
                kind = rnd.random()
                su = D(rnd.randint(1, 40)) if kind < 0.5 else D(0)
                sh = D(rnd.randint(1, 40)) if kind >= 0.4 else D(0)
                rows.append((f, lt, m, su, sh))
    gap = spark.createDataFrame(rows, GAP_T)
    st = adv.advance_state(gap, months, ["SPECIAL_A"], consume_surplus=consume)
    got_moves = {(r.factory_code, r.linetype, r.linetype2, r.dt, r.qty_tomove)
                 for r in adv.early_moves(st, 1).collect()}
    got_tomove = {(r.factory_code, r.linetype, r.dt, r.qty_tomove, r.qty_left)
                  for r in adv.early_moves_month(st, 1).collect()}
    want_moves, want_tomove = reference_advance(rows, months, ["SPECIAL_A"], consume)
    assert got_moves == want_moves
    assert got_tomove == want_tomove


def reference_rollforward(months, stock0, demand, prod, routes, safety):
    """The six roll-forward formulas, month by month, over plain dicts."""
    def producible(k, m):
        return any(o == k[0] and s == k[1] and a <= m < b for o, s, a, b in prod)

    unprod = {(k, m): q for (k, m), q in demand.items() if q and q > 0 and not producible(k, m)}
    best = {}
    for rk, sk, m, prio in routes:
        if (rk, m) in unprod and producible(sk, m):
            cand = (prio, sk[0], sk[1])
            if (rk, m) not in best or cand < best[(rk, m)]:
                best[(rk, m)] = cand
    stock, out = {k: q or D(0) for k, q in stock0.items()}, {}
    for m in months:
        need = {}
        for (k, mm), (prio, so, ss) in best.items():
            if mm == m:
                need[k] = (max(demand[(k, m)] + safety.get((k, m), 0) - stock.get(k, 0), 0), (so, ss))
        sent = {}
        for k, (q, sk) in need.items():
            sent[sk] = sent.get(sk, 0) + q
        keys = (set(stock) | {k for (k, mm) in demand if mm == m} | {k for (k, mm) in safety if mm == m}
                | set(need) | set(sent))
        nxt = {}
        for k in keys:
            b, d, s = stock.get(k, 0), demand.get((k, m)) or D(0), safety.get((k, m), 0)
            p = d if (k, m) in demand and producible(k, m) else 0
            i, o = need.get(k, (0, None))[0], sent.get(k, 0)
            todo = 0 if i > 0 else max(d + o + s - b - i, 0)
            end = max(b + i + todo - d - o, 0)
            out[(k, m)] = tuple(D(x) for x in (b, d, p, i, o, s, todo, end))
            nxt[k] = end
        stock = nxt
    return out


@pytest.mark.parametrize("buckets", [None, 1, 5])
def test_rollforward_matches_plain_loop(spark, buckets):
    rnd = random.Random(3)
    months = [J, FEB, MAR, APR]
    after = [J, FEB, MAR, APR, dt.date(2024, 5, 1)]
    keys = [(f"warehouse.F{o}", f"S{s}") for o in range(6) for s in range(3)]
    prod = []
    for k in keys:
        for _ in range(rnd.choice([0, 1, 1, 2])):
            a = rnd.randrange(0, 4)
            prod.append((k[0], k[1], after[a], after[rnd.randrange(a + 1, 5)]))
    demand = {(k, m): D(rnd.randint(0, 30)) if rnd.random() < 0.9 else None
              for k in keys for m in months if rnd.random() < 0.7}
    safety = {(k, m): D(rnd.randint(0, 9)) for k in keys for m in months if rnd.random() < 0.5}
    stock0 = {k: D(rnd.randint(0, 25)) if rnd.random() < 0.9 else None for k in keys if rnd.random() < 0.6}
    routes = [(rk, sk, m, rnd.randint(1, 2)) for rk in keys for m in months for sk in rnd.sample(keys, 3)
              if sk != rk]
    got = rf.rollforward(
        months,
        spark.createDataFrame([(k[0], k[1], q, J) for k, q in stock0.items()], STOCK_T),
        spark.createDataFrame([(k[0], k[1], m, q) for (k, m), q in demand.items()], DEMAND_T),
        spark.createDataFrame([("F", "L", s, a, b, o) for o, s, a, b in prod], PROD_T),
        dm.best_transfer(
            dm.unproducible_demand(spark.createDataFrame([(k[0], k[1], m, q) for (k, m), q in demand.items()],
                                                         DEMAND_T),
                                   spark.createDataFrame([("F", "L", s, a, b, o) for o, s, a, b in prod], PROD_T)),
            dm.viable_routes(spark.createDataFrame([(rk[1], rk[0], sk[1], sk[0], p, m) for rk, sk, m, p in routes],
                                                   ROUTE_T),
                             spark.createDataFrame([("F", "L", s, a, b, o) for o, s, a, b in prod], PROD_T))),
        spark.createDataFrame([(k[0], k[1], m, q) for (k, m), q in safety.items()], SAFETY_T), buckets=buckets)
    rows = {((r.stockorg_code, r.sku_code), r.dt): (r.begin_stock_qty, r.demand_qty, r.production_qty,
                                                    r.trans_in_qty, r.trans_out_qty, r.safety_stock_qty,
                                                    r.todo_qty, r.end_stock_qty) for r in got.collect()}
    want = reference_rollforward(months, stock0, demand, prod, routes, safety)
    assert rows == want


def test_a_route_without_priority_comes_last(spark):
    prod = spark.createDataFrame([(f, "L", "S1", J, MAR, f"warehouse.{f}") for f in ("FA", "FB")], PROD_T)
    demand = spark.createDataFrame([("warehouse.FR", "S1", J, D(5))], DEMAND_T)
    routes = spark.createDataFrame([("S1", "warehouse.FR", "S1", "warehouse.FA", 1, J),
                                    ("S1", "warehouse.FR", "S1", "warehouse.FB", None, J)], ROUTE_T)
    best = dm.best_transfer(dm.unproducible_demand(demand, prod), dm.viable_routes(routes, prod)).collect()
    assert [(r.send_stockorg_code, r.priority) for r in best] == [("warehouse.FA", 1)]


def test_next_month_without_quantity_falls_back(spark):
    from monthplan.sources.loaders import load_demand

    raw = spark.createDataFrame([(1, "W", "S", 2024, 1, D(7), 10), (1, "W", "S", 2024, 2, None, 10)],
                                "batch_id int, stockorg_code string, sku_code string, year int, month int,"
                                " demand_qty decimal(18,3), demand_type int")
    got = {r.dt: (r.demand_qty, r.demand_qty_next, r.dt2) for r in load_demand(raw, 1).collect()}
    assert got == {J: (D(7), D(7), FEB), FEB: (None, None, FEB)}


CAP_T = ("factory_code string, linetype string, dt date, linetype_rn int, line_capacity decimal(18,3),"
         " todo_qty decimal(18,3)")


def test_unknown_rank_goes_last_and_factories_without_ceiling_are_left_out(spark):
    cap = spark.createDataFrame([("F1", "a", J, 1, D(10), D(10)), ("F1", "m", J, None, D(10), D(10)),
                                 ("F1", "z", J, 2, D(10), D(10)), ("F2", "a", J, 1, D(10), D(10))], CAP_T)
    ceiling = spark.createDataFrame([("F1", J, D(15))], "factory_code string, dt date, factory_capacity decimal(18,3)")
    got = {(r.factory_code, r.linetype): r.assigned_capacity for r in rb.rebalance_capacity(cap, ceiling).collect()}
    assert got == {("F1", "z"): D(10), ("F1", "a"): D(5), ("F1", "m"): D(0)}


def test_two_gap_rows_of_one_line_type_are_summed(spark):
    gap = spark.createDataFrame([("F1", "pure-can", J, D(0), D(2)), ("F1", "pure-can", J, D(0), D(3))], GAP_T)
    st = adv.advance_state(gap, [J, FEB], [])
    assert [(r.linetype, r.qty_shortage) for r in adv.month_shortage(st).collect()] == [("pure-can", D(5))]
    assert [(r.linetype, r.qty_left) for r in adv.unfilled_shortage(st, 1).collect()] == [("pure-can", D(5))]
    assert adv.early_moves_month(st, 1).count() == 0
