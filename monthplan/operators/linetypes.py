"""Stage B2: line types, line-type capacity, and to-do roll-ups.

A line type is ``pure-<package>`` / ``ordinary-<package>`` or, for a special line, the line code itself.  The
labels must sort ``special < ordinary-* < pure-*`` (upper-case codes sort first), because the SKU's line type is the
minimum of its candidates ("ordinary wins over pure").

Line, hour, rate and ceiling tables are keyed by factory and line: their size is bounded by the plant count, not by
demand volume.  Only the line classification (one row per line) is broadcast explicitly; every other join is left to
AQE, which broadcasts a side whose finished shuffle stage measured small and keeps the shuffle join otherwise.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthplan.functions.joins import shuffled
from monthplan.functions.months import expand_to_months
from monthplan.functions.quantities import QTY, RATE

QTY_COLUMNS = ["begin_stock_qty", "demand_qty", "production_qty", "trans_in_qty", "trans_out_qty",
               "safety_stock_qty", "todo_qty", "end_stock_qty"]


SUM_QTY = "decimal(28,3)"  # what a sum of quantities has; a sum of such sums keeps it


def classify_lines(line_info: DataFrame, special_lines: Sequence[str], pure_flag: str = "Y",
                   packages: Sequence[str] = ("bottle", "can"),
                   pure_label: str = "pure-", ordinary_label: str = "ordinary-") -> DataFrame:
    """L1: line type and rank per line: rank 1 special, 2 a known package, 0 otherwise."""
    special = F.col("line_code").isin(list(special_lines))
    family = F.when(F.col("is_pure_draft") == pure_flag, F.lit(pure_label)).otherwise(F.lit(ordinary_label))
    return line_info.select(
        "factory_code", "line_code",
        F.when(special, F.col("line_code")).otherwise(F.concat(family, F.col("package_type"))).alias("linetype"),
        F.when(special, F.lit(1)).when(F.col("package_type").isin(list(packages)), F.lit(2))
        .otherwise(F.lit(0)).alias("linetype_rn"))


def producible_months(producibility: DataFrame, months: Sequence[_dt.date]) -> DataFrame:
    """L2: producibility expanded to the plan months inside each interval."""
    p = producibility.select("factory_code", "line_code", "stockorg_code", "sku_code", "dt_start", "dt_end")
    return expand_to_months(p, months, "dt_start", "dt_end").drop("dt_start", "dt_end")


def preferred_line(prod_months: DataFrame, priority: DataFrame, linetypes: DataFrame) -> DataFrame:
    """L3: per (factory, SKU, month) the producible line with the lowest priority (NULL last; ties: lowest
    line code)."""
    pr = priority.select("factory_code", "line_code", "sku_code", "dt", "priority")
    cand = (prod_months.join(shuffled(pr), ["factory_code", "line_code", "sku_code", "dt"])
            .select("factory_code", "sku_code", "dt", F.struct(F.col("priority").isNull().alias("unranked"), "priority", "line_code").alias("_c")))
    best = (cand.groupBy("factory_code", "sku_code", "dt").agg(F.min("_c").alias("_c"))
            .select("factory_code", F.col("_c.line_code").alias("line_code"), "sku_code", "dt",
                    F.col("_c.priority").alias("priority")))
    return best.join(linetypes.select("factory_code", "line_code", "linetype"), ["factory_code", "line_code"])


def sku_line_type(preferred: DataFrame) -> DataFrame:
    """L4: one line type per (factory, SKU, month): the sorted distinct candidates and their minimum."""
    return (preferred.groupBy("factory_code", "sku_code", "dt")
            .agg(F.sort_array(F.collect_set("linetype")).alias("linetypes"), F.min("linetype").alias("linetype"))
            .select("factory_code", F.concat(F.lit("warehouse."), F.col("factory_code")).alias("stockorg_code"),
                    "sku_code", "dt", "linetypes", "linetype"))


def _sums() -> list:
    return [F.sum(c).alias(c) for c in QTY_COLUMNS]


def warehouse_linetype_todo(todo: DataFrame, sku_linetype: DataFrame) -> DataFrame:
    """Roll-forward quantities summed per (stock org, line type, month); keys without a line type drop out."""
    lt = sku_linetype.select("stockorg_code", "sku_code", "dt", "linetype")
    return (todo.join(shuffled(lt), ["stockorg_code", "sku_code", "dt"])
            .groupBy("stockorg_code", "linetype", "dt").agg(*_sums()))


def line_hours_month(hours: DataFrame, months: Sequence[_dt.date]) -> DataFrame:
    """Available hours per line and plan month."""
    h = hours.select("factory_code", "line_code", "start_dt", "end_dt", "max_hour")
    return expand_to_months(h, months, "start_dt", "end_dt").select("factory_code", "line_code", "dt", "max_hour")


def line_rates_month(rates: DataFrame, months: Sequence[_dt.date]) -> DataFrame:
    """Production rates per line and plan month, live for ``start <= dt < end + 1 month``."""
    r = rates.select("factory_code", "line_code", "production_rate", "start_dt", "end_dt")
    return (expand_to_months(r, months, "start_dt", "end_dt", end_shift=1)
            .select("factory_code", "line_code", "production_rate", "dt"))


def line_rate_avg(rates_month: DataFrame, linetypes: DataFrame) -> DataFrame:
    """Mean rate per (factory, line, line type, month, rank), six places."""
    return (rates_month.join(linetypes, ["factory_code", "line_code"])
            .groupBy("factory_code", "line_code", "linetype", "dt", "linetype_rn")
            .agg(F.avg("production_rate").cast(RATE).alias("avg_rate")))


def linetype_capacity(hours_month: DataFrame, rate_avg: DataFrame) -> DataFrame:
    """Line-type capacity ``sum(max_hour * avg_rate)`` per (factory, line type, rank, month)."""
    return (hours_month.join(rate_avg, ["factory_code", "line_code", "dt"])
            .groupBy("factory_code", "linetype", "linetype_rn", "dt")
            .agg(F.sum(F.col("max_hour") * F.col("avg_rate")).cast(RATE).alias("capacity")))


def factory_linetype_todo(warehouse_todo: DataFrame, org: DataFrame) -> DataFrame:
    """The warehouse roll-up (L5) summed per (factory, line type, month); the factory is the stock org's parent.

    Summing L5 again instead of the roll-forward keeps the large table to one join and one shuffle.
    """
    o = org.select("stockorg_code", F.col("parent_org_code").alias("factory_code"))
    sums = [F.sum(c).cast(SUM_QTY).alias(c) for c in QTY_COLUMNS]
    return warehouse_todo.join(o, "stockorg_code").groupBy("factory_code", "linetype", "dt").agg(*sums)


def factory_sku_todo(todo: DataFrame, sku_linetype: DataFrame, transfers: DataFrame) -> DataFrame:
    """Roll-forward quantities charged to the factory that makes them.

    A key that receives a transfer is charged to its sender: factory = second part of the sender's stock-org code,
    SKU = sender SKU, line type = sender's line type; every other key is charged to itself.  Keys without any line
    type keep a NULL line type.  The sender's line type is joined to the transfers first, so the to-do table is
    shuffled on its own key only (most of its rows have no sender, which would be one hot key).
    """
    key = ["stockorg_code", "sku_code", "dt"]
    lines = sku_linetype.select(*key, "linetype")
    sent = transfers.select(*key, "send_stockorg_code", "send_sku_code").join(
        shuffled(lines.select(F.col("stockorg_code").alias("send_stockorg_code"), F.col("sku_code").alias("send_sku_code"), "dt",
                              F.col("linetype").alias("_send_lt"))), ["send_stockorg_code", "send_sku_code", "dt"], "left")
    charge = sent.select(*key, "send_stockorg_code", "send_sku_code", "_send_lt")
    j = todo.join(shuffled(lines.withColumnRenamed("linetype", "_own_lt")), key, "left").join(shuffled(charge), key, "left")
    return (j.groupBy(F.split_part(F.coalesce("send_stockorg_code", "stockorg_code"), F.lit("."), F.lit(2))
                      .alias("factory_code"),
                      "dt",
                      F.coalesce("send_sku_code", "sku_code").alias("sku_code"),
                      F.coalesce("_send_lt", "_own_lt").alias("linetype"))
            .agg(*_sums()))


ROLLUP_GRAINS = ("linetype", "factory_sku", "sku")


def todo_rollups(todo: DataFrame, sku_linetype: DataFrame, transfers: DataFrame) -> DataFrame:
    """L5, L11 and L12's totals in one pass over the roll-forward: rows of three grains, told apart by ``grain``.

    * ``linetype``: sums per (stock org, own line type, month); keys without a line type drop out (L5)
    * ``factory_sku``: sums per (factory, SKU, line type, month) after the charge to the sender (L11)
    * ``sku``: sums per month (L12)

    A key's line types and charges are gathered to one row per (stock org, SKU) and looked up by month, so the to-do is
    joined on its bucket key alone and stays in its buckets up to the grouping sets, which are combined map-side.
    ``transfers`` holds at most one row per key and month.
    """
    key = ["stockorg_code", "sku_code"]
    lines = sku_linetype.select(*key, "dt", "linetype")
    own = lines.groupBy(*key).agg(F.collect_list(F.struct("dt", "linetype")).alias("_own"))
    sent = transfers.select(*key, "dt", "send_stockorg_code", "send_sku_code").join(
        shuffled(lines.select(F.col("stockorg_code").alias("send_stockorg_code"), F.col("sku_code").alias("send_sku_code"), "dt",
                              F.col("linetype").alias("send_linetype"))), ["send_stockorg_code", "send_sku_code", "dt"], "left")
    charge = sent.groupBy(*key).agg(F.collect_list(F.struct("dt", "send_stockorg_code", "send_sku_code", "send_linetype")).alias("_sent"))

    def at_month(found: str) -> Column:
        return F.get(F.filter(found, lambda x: x["dt"] == F.col("dt")), F.lit(0))

    j = (todo.join(shuffled(own), key, "left").join(shuffled(charge), key, "left")
         .withColumn("_line", at_month("_own")["linetype"]).withColumn("_to", at_month("_sent")))
    j = j.select("dt", F.col("stockorg_code").alias("org"), F.col("_line").alias("own_linetype"),
                 F.split_part(F.coalesce(F.col("_to.send_stockorg_code"), "stockorg_code"), F.lit("."), F.lit(2)).alias("factory_code"),
                 F.coalesce(F.col("_to.send_sku_code"), "sku_code").alias("charged_sku"),
                 F.coalesce(F.col("_to.send_linetype"), "_line").alias("charged_linetype"), *QTY_COLUMNS)
    by_line, by_sku, total = ["org", "own_linetype", "dt"], ["factory_code", "charged_sku", "charged_linetype", "dt"], ["dt"]
    every = ["dt", "org", "own_linetype", "factory_code", "charged_sku", "charged_linetype"]
    rolled = j.groupingSets([by_line, by_sku, total], *every).agg(F.grouping("org").alias("_no_org"), F.grouping("factory_code").alias("_no_factory"), *_sums())
    grain = F.when(F.col("_no_org") == 0, "linetype").when(F.col("_no_factory") == 0, "factory_sku").otherwise("sku")
    return (rolled.withColumn("grain", grain).where("grain <> 'linetype' OR own_linetype IS NOT NULL")
            .select("grain", "dt", F.col("org").alias("stockorg_code"), "factory_code", F.col("charged_sku").alias("sku_code"),
                    F.coalesce("own_linetype", "charged_linetype").alias("linetype"), *QTY_COLUMNS))


def rollup_reconciliation(rollups: DataFrame, by_linetype: DataFrame) -> DataFrame:
    """L12 from the grains of ``todo_rollups`` and L10: nothing is read that isn't summed already, but the factory SKUs."""
    totals = rollups.where("grain <> 'linetype'").groupBy("grain", "dt").agg(F.sum("todo_qty").cast(SUM_QTY).alias("todo_qty"))
    by_line = by_linetype.groupBy("dt").agg(F.sum("todo_qty").cast(SUM_QTY).alias("todo_qty")).withColumn("grain", F.lit("linetype"))
    return totals.unionByName(by_line).select("grain", "dt", "todo_qty")


def todo_reconciliation(todo: DataFrame, by_linetype: DataFrame, by_factory_sku: DataFrame) -> DataFrame:
    """To-do totals per month at three grains; ``sku`` = ``factory_sku`` >= ``linetype`` is the invariant."""
    parts = [(todo, "sku"), (by_linetype, "linetype"), (by_factory_sku, "factory_sku")]
    out = None
    for df, grain in parts:
        g = df.groupBy("dt").agg(F.sum("todo_qty").alias("todo_qty")).withColumn("grain", F.lit(grain))
        out = g if out is None else out.unionByName(g)
    return out.select("grain", "dt", "todo_qty")
