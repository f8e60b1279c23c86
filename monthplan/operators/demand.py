"""Stage B1: who cannot make its own demand, where it can get it, safety stock, first month's stock.

Producibility is first coalesced to one row per (stock org, SKU) with the disjoint intervals that some line covers
(``coverage_index``). Every test is then a semi / anti join on that key with one row on the right, and the month is looked
up in the row's intervals. A plan writes the index once in buckets of the key, so no test shuffles it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthplan.functions.joins import shuffled
from monthplan.functions.months import days_in_next_month
from monthplan.functions.quantities import QTY


def coverage_index(producibility: DataFrame) -> DataFrame:
    """(stock org, SKU, spans): the sorted, disjoint half-open intervals in which some line can make the SKU there.

    Touching and overlapping intervals of all lines are merged; reversed, empty and open ones cover nothing. A key's
    distinct intervals are gathered map-side first, so a key that holds most of the rows sends one short set a task.
    """
    spans = F.sort_array(F.collect_set(F.struct("dt_start", "dt_end")))

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["dt_start"].alias("dt_start"), F.greatest(last["dt_end"], s["dt_end"]).alias("dt_end"))
        return (F.when(F.size(acc) == 0, F.array(s))
                .when(s["dt_start"] <= last["dt_end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined)))
                .otherwise(F.concat(acc, F.array(s))))

    held = producibility.where(F.col("dt_start") < F.col("dt_end")).groupBy("stockorg_code", "sku_code").agg(spans.alias("spans"))
    none = F.array().cast("array<struct<dt_start:date,dt_end:date>>")
    return held.withColumn("spans", F.aggregate("spans", none, merge))


def covered(spans: Column, dt: Column) -> Column:
    """Whether the month lies in one of the intervals; not for a null month or a key without intervals."""
    return F.coalesce(F.exists(spans, lambda s: (dt >= s["dt_start"]) & (dt < s["dt_end"])), F.lit(False))


def as_coverage(producibility: DataFrame) -> DataFrame:
    """Line intervals (A3) as their coverage index; an index stays as it is."""
    return producibility if "spans" in producibility.columns else coverage_index(producibility)


def _producible_at(left: DataFrame, producibility: DataFrame, org: str, sku: str, how: str) -> DataFrame:
    p = as_coverage(producibility).select(F.col("stockorg_code").alias("_p_org"), F.col("sku_code").alias("_p_sku"),
                                          F.col("spans").alias("_p_spans"))
    cond = (left[org] == p._p_org) & (left[sku] == p._p_sku) & covered(p._p_spans, left["dt"])
    return left.join(shuffled(p), cond, how)


def unproducible_demand(demand: DataFrame, producibility: DataFrame) -> DataFrame:
    """B1: positive demand whose (stock org, SKU) has no producible line in that month."""
    d = demand.where(F.col("demand_qty") > 0)
    return _producible_at(d, producibility, "stockorg_code", "sku_code", "left_anti")


def producible_demand(demand: DataFrame, producibility: DataFrame) -> DataFrame:
    """Demand rows whose (stock org, SKU) can be made here in that month."""
    return _producible_at(demand, producibility, "stockorg_code", "sku_code", "left_semi")


def viable_routes(routes: DataFrame, producibility: DataFrame) -> DataFrame:
    """B2: transfer routes whose *sender* can make the SKU in the route's month."""
    return _producible_at(routes, producibility, "send_stockorg_code", "send_sku_code", "left_semi")


def best_transfer(unproducible: DataFrame, routes: DataFrame) -> DataFrame:
    """For each need (stock org, SKU, month) the viable route with the lowest priority (a NULL priority last).

    Ties are broken by sender stock org, then sender SKU.  The best route of a (receiver, month) does not depend on
    the demand row, so routes are reduced to one per receiver and month first -- ``min`` over a struct is an ordinary
    aggregate, combined map-side, so a receiver holding a third of all routes costs one row per task -- and the need
    is then joined one-to-one.
    """
    r = (routes.groupBy(F.col("receive_stockorg_code").alias("stockorg_code"),
                        F.col("receive_sku_code").alias("sku_code"), "dt")
         .agg(F.min(F.struct(F.col("priority").isNull().alias("unranked"), "priority", "send_stockorg_code", "send_sku_code")).alias("_best")))
    need = unproducible.select("stockorg_code", "sku_code", "dt", "demand_qty")
    return (need.join(shuffled(r), ["stockorg_code", "sku_code", "dt"])
            .select("stockorg_code", "sku_code", "dt", "demand_qty",
                    F.col("_best.send_sku_code").alias("send_sku_code"),
                    F.col("_best.send_stockorg_code").alias("send_stockorg_code"),
                    F.col("_best.priority").alias("priority")))


def safety_stock(calendar: DataFrame, months: Sequence[_dt.date], rules: DataFrame, demand: DataFrame) -> DataFrame:
    """Safety stock per (stock org, SKU, plan month).

    ``qty = next month's demand / days of next month * rule days``, rounded to three places.  A key without demand
    next month gets no row (inner join).  The last plan month has no next month in the plan, so it repeats the
    second-last month's row -- unless real demand beyond the horizon gave it a row of its own.
    """
    rn = calendar.select("dt", "dt_rn")
    key = ["stockorg_code", "sku_code"]
    d = demand.select(*key, F.add_months("dt", -1).alias("dt"), F.col("demand_qty").alias("_next_qty")).where(
        F.col("dt").isin(list(months)))
    # a rule meets its key's months by its interval, not by a row for each month; all that follows stays on the key
    c = (rules.select(*key, "dt_start", "dt_end", "safety_stock_days").join(shuffled(d), key)
         .where((F.col("dt") >= F.col("dt_start")) & (F.col("dt") < F.col("dt_end"))).join(F.broadcast(rn), "dt"))
    qty = (F.col("_next_qty") / days_in_next_month("dt") * F.col("safety_stock_days")).cast(QTY)
    own = F.struct(F.col("dt"), F.lit(0).alias("fallback"))
    shifted = F.struct(F.add_months("dt", 1).alias("dt"), F.lit(1).alias("fallback"))
    rows = c.select(*key, qty.alias("qty"),
                    F.explode(F.when(F.col("dt_rn") == 2, F.array(own, shifted)).otherwise(F.array(own))).alias("at")).select(
        *key, F.col("at.dt").alias("dt"), "qty", F.col("at.fallback").alias("fallback"))
    # one pass: a key's own rows of a month win over the rows repeated from the month before
    least = F.min("fallback").over(Window.partitionBy(*key, "dt"))
    return (rows.withColumn("_least", least).where(F.col("fallback") == F.col("_least"))
            .select(*key, "dt", F.col("qty").alias("safety_stock_qty")))


def first_month_stock(opening: DataFrame, months: Sequence[_dt.date]) -> DataFrame:
    """Opening stock per (stock org, SKU), stamped with the first plan month."""
    return (opening.groupBy("stockorg_code", "sku_code")
            .agg(F.sum("begin_stock_qty").cast(QTY).alias("begin_stock_qty"))
            .withColumn("dt", F.lit(months[0])))
