"""Batch loaders: raw warehouse-shaped tables of one ``batch_id`` -> planning inputs.

Each loader is a filter + projection, so Spark pushes the ``batch_id`` predicate and the column list into the scan
(parquet row groups, or the JDBC query when the raw table comes from ``read_source``).  Whole-number year / month
parts become month-start dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthplan.functions.months import month_date
from monthplan.functions.quantities import QTY


def _batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.where(F.col("batch_id") == F.lit(batch_id))


def load_plan_calendar(raw: DataFrame, batch_id: int) -> DataFrame:
    """A1: plan months of the batch; ``dt_rn = 1`` is the last month.

    The calendar holds one row per plan month, so the global window runs on a handful of rows.
    """
    cal = _batch(raw, batch_id).select("batch_id", F.col("start_date").alias("dt"))
    return cal.withColumn("dt_rn", F.row_number().over(Window.orderBy(F.desc("dt"))))


def load_opening_stock(raw: DataFrame, batch_id: int) -> DataFrame:
    """A2: stock on hand, one row per (stock org, SKU, date): duplicate source rows are summed here."""
    return (_batch(raw, batch_id)
            .groupBy("batch_id", "stockorg_code", "sku_code", F.col("stock_date").alias("dt"))
            .agg(F.sum("available_qty").cast(QTY).alias("begin_stock_qty")))


def load_producibility(raw: DataFrame, batch_id: int) -> DataFrame:
    """A3: producible (factory, line, SKU) intervals; the factory's own stock org is ``warehouse.<factory>``."""
    return (_batch(raw, batch_id).where(F.col("producibility") == 1)
            .select("batch_id", "factory_code", "line_code", "sku_code",
                    month_date("start_year", "start_month").alias("dt_start"),
                    month_date("end_year", "end_month").alias("dt_end"),
                    F.concat(F.lit("warehouse."), F.col("factory_code")).alias("stockorg_code")))


def load_safety_rules(raw: DataFrame, batch_id: int) -> DataFrame:
    """A4: safety-stock days per (stock org, SKU) and interval."""
    return _batch(raw, batch_id).select(
        "batch_id", "stockorg_code", "sku_code",
        month_date("start_year", "start_month").alias("dt_start"),
        month_date("end_year", "end_month").alias("dt_end"), "safety_stock_days")


def load_transfer_routes(raw: DataFrame, batch_id: int) -> DataFrame:
    """A5: receiver <- sender routes per month with a priority (lower wins)."""
    return _batch(raw, batch_id).select(
        "batch_id", "receive_sku_code", "receive_stockorg_code", "send_sku_code", "send_stockorg_code",
        "priority", month_date("year", "month").alias("dt"))


def load_demand(raw: DataFrame, batch_id: int, demand_type: int = 10) -> DataFrame:
    """Month demand with next month's demand of the same key.

    ``demand_qty_next`` / ``dt2`` are the quantity and month of the row one month later, falling back to the row's
    own values (a next month whose quantity is NULL falls back on the quantity, not on the month).  Duplicate demand rows
    of a key and month are summed.  Keys are unique per month after the aggregate, so the self join on ``dt + 1 month`` becomes a
    ``lead`` over the key's months: one shuffle by key instead of a join.
    """
    d = (_batch(raw, batch_id).where(F.col("demand_type") == F.lit(demand_type))
         .groupBy("batch_id", "stockorg_code", "sku_code", month_date("year", "month").alias("dt"))
         .agg(F.sum("demand_qty").cast(QTY).alias("demand_qty")))
    w = Window.partitionBy("stockorg_code", "sku_code").orderBy("dt")
    nxt_dt = F.lead("dt").over(w)
    nxt_qty = F.lead("demand_qty").over(w)
    return (d.withColumn("_nd", nxt_dt).withColumn("_nq", nxt_qty)
            .withColumn("_adj", F.coalesce(F.col("_nd") == F.add_months(F.col("dt"), 1), F.lit(False)))
            .select("batch_id", "stockorg_code", "sku_code", "dt", "demand_qty",
                    F.coalesce(F.when(F.col("_adj"), F.col("_nq")), F.col("demand_qty")).alias("demand_qty_next"),
                    F.when(F.col("_adj"), F.col("_nd")).otherwise(F.col("dt")).alias("dt2")))


def load_line_info(raw: DataFrame, batch_id: int) -> DataFrame:
    """Production lines of the batch."""
    return _batch(raw, batch_id).select("batch_id", "factory_code", "line_code", "is_pure_draft", "package_type")


def load_line_hours(raw: DataFrame, batch_id: int) -> DataFrame:
    """Available hours per line and interval (``max_hour > 0``)."""
    return (_batch(raw, batch_id).where(F.col("max_hour") > 0)
            .select("factory_code", "line_code",
                    month_date("start_year", "start_month").alias("start_dt"),
                    month_date("end_year", "end_month").alias("end_dt"), "max_hour"))


def load_production_rates(raw: DataFrame, batch_id: int, rate_end: str = "start") -> DataFrame:
    """Production rates (``production_rate > 0``).

    ``rate_end="start"`` reproduces the literal loader, whose interval end is built from the *start* month (a rate is
    then live for that one month); ``rate_end="end"`` uses the stored end month.
    """
    end = (month_date("start_year", "start_month") if rate_end == "start"
           else month_date("end_year", "end_month"))
    return (_batch(raw, batch_id).where(F.col("production_rate") > 0)
            .select("batch_id", "factory_code", "line_code", "production_rate",
                    month_date("start_year", "start_month").alias("start_dt"), end.alias("end_dt")))


def load_line_priority(raw: DataFrame, batch_id: int) -> DataFrame:
    """A10: line preference per (factory, line, SKU, month); lower wins."""
    return _batch(raw, batch_id).select("batch_id", "factory_code", "line_code", "sku_code",
                                        month_date("year", "month").alias("dt"), "priority")


def load_org_snapshot(dim_raw: DataFrame, plan_raw: DataFrame, batch_id: int) -> DataFrame:
    """Stock-org dimension at the batch's snapshot day (the latest ``day_date`` of the batch's plan rows).

    The snapshot day is one scalar: a one-row aggregate joined back (broadcast by size), not a driver round trip.
    """
    day = _batch(plan_raw, batch_id).agg(F.max("day_date").alias("_day"))
    return (dim_raw.join(F.broadcast(day), dim_raw.day_date == day._day)
            .select("stockorg_code", "stockorg_name", "parent_org_code"))


def load_capacity_gap(raw: DataFrame, batch_id: int) -> DataFrame:
    """Surplus / shortage per (factory, line type, month) of the batch."""
    return _batch(raw, batch_id).select("factory_code", "linetype", "dt", "qty_surplus", "qty_shortage")


def load_factory_capacity(raw: DataFrame, batch_id: int) -> DataFrame:
    """The factory's total capacity ceiling per interval."""
    return _batch(raw, batch_id).select(
        "factory_code", month_date("start_year", "start_month").alias("dt_start"),
        month_date("end_year", "end_month").alias("dt_end"), "equilibrium_capacity")


def load_linetype_capacity(raw: DataFrame, batch_id: int) -> DataFrame:
    """Line-type capacity of the batch with the capacity as a quantity decimal."""
    return _batch(raw, batch_id).select("batch_id", "factory_code", "linetype", "dt", "linetype_rn",
                                        F.col("capacity").cast(QTY).alias("capacity"))
