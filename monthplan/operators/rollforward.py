"""Stage B8: monthly stock roll-forward.

For each plan month, oldest first, over keys (stock org, SKU):

1. ``need(r) = max(demand + safety - begin, 0)`` for every receiver with a best transfer that month;
2. ``trans_in(r) = need(r)``; ``trans_out(s) = sum of need`` over the receivers routed to sender ``s``;
3. ``production`` = demand where the key is producible (informational);
4. ``todo = 0 if trans_in > 0 else max(demand + trans_out + safety - begin - trans_in, 0)``;
5. ``end = max(begin + trans_in + todo - demand - trans_out, 0)``;
6. ``begin(m + 1) = end(m)`` for every key seen in month ``m``.

Only keys that receive or send in some month of the horizon depend on other keys, and so on the order of the months. So
keys are split by role. All rows of a key are brought together once (``key_history``: a row per key with its months as
an array). Keys without transfers are folded over that array where they stand (``fold_months``). The others go month by
month (``month_step``): their tables are bucketed by key and partitioned by month, so a month reads its own inputs only,
joins them bucket by bucket, and moves nothing but the receivers' needs, summed map-side, to their senders.
``transfer_need`` / ``stack_quantities`` / ``pivot_quantities`` / ``todo_and_end`` are the month written the long way.

Every step is written before the next reads it and then entered in a ledger: that cuts the lineage, survives lost
executors, and lets a run that ended half-way go on after its last finished month (``run``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthplan.functions.joins import shuffled
from monthplan.functions.months import months_literal
from monthplan.functions.quantities import QTY
from monthplan.operators.demand import as_coverage, covered
from monthplan.session import run_folder, scratch_table
from monthplan.sources.buckets import BucketStore

KEY = ["stockorg_code", "sku_code"]
KIND_COLUMNS = {
    "stock": "begin_stock_qty",
    "demand": "demand_qty",
    "production": "production_qty",
    "trans_in": "trans_in_qty",
    "trans_out": "trans_out_qty",
    "safety": "safety_stock_qty",
}
RESULT_COLUMNS = ["stockorg_code", "sku_code", "dt", "begin_stock_qty", "demand_qty", "production_qty",
                  "trans_in_qty", "trans_out_qty", "safety_stock_qty", "todo_qty", "end_stock_qty"]


def transfer_need(transfers: DataFrame, stock: DataFrame, safety: DataFrame) -> DataFrame:
    """``need = max(demand + safety - begin, 0)`` per best transfer; missing stock / safety count as 0."""
    s = stock.select(*KEY, "dt", "begin_stock_qty")
    sf = safety.select(*KEY, "dt", "safety_stock_qty")
    need = (F.coalesce("demand_qty", F.lit(0)) + F.coalesce("safety_stock_qty", F.lit(0))
            - F.coalesce("begin_stock_qty", F.lit(0)))
    return (transfers.join(shuffled(s), [*KEY, "dt"], "left").join(shuffled(sf), [*KEY, "dt"], "left")
            .select(*KEY, "dt", "demand_qty", "send_sku_code", "send_stockorg_code", "priority",
                    F.greatest(need, F.lit(0)).cast(QTY).alias("qty")))


def stack_quantities(stock: DataFrame, demand: DataFrame, production: DataFrame, need: DataFrame,
                     safety: DataFrame) -> DataFrame:
    """The six quantity kinds of a month as (key, dt, qty, qty_type) rows."""
    parts = [
        stock.select(*KEY, "dt", F.col("begin_stock_qty").alias("qty"), F.lit("stock").alias("qty_type")),
        demand.select(*KEY, "dt", F.col("demand_qty").alias("qty"), F.lit("demand").alias("qty_type")),
        production.select(*KEY, "dt", F.col("demand_qty").alias("qty"), F.lit("production").alias("qty_type")),
        need.select(*KEY, "dt", "qty", F.lit("trans_in").alias("qty_type")),
        need.select(F.col("send_stockorg_code").alias("stockorg_code"), F.col("send_sku_code").alias("sku_code"),
                    "dt", "qty", F.lit("trans_out").alias("qty_type")),
        safety.select(*KEY, "dt", F.col("safety_stock_qty").alias("qty"), F.lit("safety").alias("qty_type")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("qty", F.col("qty").cast(QTY))


def pivot_quantities(stacked: DataFrame) -> DataFrame:
    """B8d: one row per (key, dt) with the six kinds summed; a missing kind is 0."""
    aggs = [F.coalesce(F.sum(F.when(F.col("qty_type") == k, F.col("qty"))), F.lit(0)).cast(QTY).alias(c)
            for k, c in KIND_COLUMNS.items()]
    return stacked.groupBy(*KEY, "dt").agg(*aggs)


def todo_qty(begin: Column, demand: Column, trans_in: Column, trans_out: Column, safety: Column) -> Column:
    """What is to be made: nothing where the key receives, else what the month needs beyond its stock."""
    short = F.greatest(demand + trans_out + safety - begin - trans_in, F.lit(0))
    return F.when(trans_in > 0, F.lit(0)).otherwise(short).cast(QTY)


def end_qty(begin: Column, demand: Column, trans_in: Column, trans_out: Column, todo: Column) -> Column:
    return F.greatest(begin + trans_in + todo - demand - trans_out, F.lit(0)).cast(QTY)


def todo_and_end(pivot: DataFrame, *more: str) -> DataFrame:
    """B8e: to-do and closing stock of a month (one projection), with ``more`` columns passed along."""
    begin, demand, _, trans_in, trans_out, safety = (F.col(c) for c in KIND_COLUMNS.values())
    todo = todo_qty(begin, demand, trans_in, trans_out, safety)
    end = end_qty(begin, demand, trans_in, trans_out, todo)
    return pivot.select(*RESULT_COLUMNS[:-2], todo.alias("todo_qty"), end.alias("end_stock_qty"), *more)


def key_history(months: Sequence[_dt.date], stock0: DataFrame, demand: DataFrame, coverage: DataFrame, transfers: DataFrame,
                safety: DataFrame, buckets: int) -> DataFrame:
    """One row per key that ever appears: its months as an array, its opening stock, and whether transfers touch it.

    ``months`` holds (dt, demand_qty, production_qty, safety_stock_qty, transfer) for each month in which the key has a
    demand, a safety stock or a best route, whatever its quantity; ``held`` says that it has opening stock; ``moves``
    that it receives or sends in some month. Rows move to their key's bucket once; the coverage index is read where
    it lies if it has the same buckets.
    """
    plan = F.col("dt").isin(list(months))
    dem = demand.where(plan).select(*KEY, "dt", F.col("demand_qty").cast(QTY).alias("demand_qty"), F.lit(True).alias("here"))
    saf = safety.where(plan).select(*KEY, "dt", F.col("safety_stock_qty").cast(QTY).alias("safety_stock_qty"), F.lit(True).alias("here"))
    routed = transfers.where(plan)
    rec = routed.select(*KEY, "dt", F.struct(F.col("demand_qty").cast(QTY).alias("demand_qty"), "send_stockorg_code",
                                             "send_sku_code").alias("transfer"), F.lit(True).alias("here"), F.lit(True).alias("moves"))
    # a sender that very many receivers share is one row a task
    snd = routed.select(F.col("send_stockorg_code").alias("stockorg_code"), F.col("send_sku_code").alias("sku_code")).distinct().select(
        *KEY, F.lit(True).alias("moves"))
    stk = stock0.groupBy(*KEY).agg(F.sum("begin_stock_qty").cast(QTY).alias("begin_stock_qty")).select(
        *KEY, "begin_stock_qty", F.lit(True).alias("held"))
    rows = dem
    for kind in (saf, rec, snd, stk):
        rows = rows.unionByName(kind, allowMissingColumns=True)
    by_month = rows.repartition(buckets, *KEY).groupBy(*KEY, "dt").agg(
        *[F.sum(c).cast(QTY).alias(c) for c in ("demand_qty", "safety_stock_qty", "begin_stock_qty")],
        F.max("transfer").alias("transfer"), *[F.max(c).alias(c) for c in ("here", "held", "moves")])
    month = F.struct("dt", "demand_qty", "safety_stock_qty", "transfer")
    by_key = by_month.groupBy(*KEY).agg(
        F.collect_list(F.when(F.col("here"), month)).alias("found"), F.max("begin_stock_qty").alias("begin_stock_qty"),
        F.coalesce(F.max("held"), F.lit(False)).alias("held"), F.coalesce(F.max("moves"), F.lit(False)).alias("moves"))
    made = by_key.join(shuffled(coverage.select(*KEY, "spans")), KEY, "left")
    full = F.transform("found", lambda h: F.struct(
        h["dt"].alias("dt"), h["demand_qty"].alias("demand_qty"),
        F.when(covered(F.col("spans"), h["dt"]), h["demand_qty"]).alias("production_qty"),
        h["safety_stock_qty"].alias("safety_stock_qty"), h["transfer"].alias("transfer")))
    return made.select(*KEY, full.alias("months"), F.coalesce("begin_stock_qty", F.lit(0)).cast(QTY).alias("begin_stock_qty"), "held", "moves")


def fold_months(keys: DataFrame, months: Sequence[_dt.date]) -> DataFrame:
    """B8e / B8f over a key's own months, for keys without transfers: the result rows from its first month on.

    One projection: each plan month takes its inputs out of the key's array, then the stock is carried over them.
    """
    zero = F.lit(0).cast(QTY)

    def quantity(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast(QTY)

    plan = F.transform(months_literal(months), lambda m: F.struct(
        m.alias("dt"), F.get(F.filter("months", lambda h: h["dt"] == m), F.lit(0)).alias("h")))
    lined = keys.select(*KEY, "begin_stock_qty", "held", plan.alias("plan"))
    row_type = ("array<struct<dt:date,begin_stock_qty:decimal(18,3),demand_qty:decimal(18,3),production_qty:decimal(18,3),"
                "trans_in_qty:decimal(18,3),trans_out_qty:decimal(18,3),safety_stock_qty:decimal(18,3),todo_qty:decimal(18,3),"
                "end_stock_qty:decimal(18,3)>>")
    start = F.struct(F.col("begin_stock_qty").alias("begin"), F.col("held").alias("seen"), F.array().cast(row_type).alias("rows"))

    def step(acc: Column, x: Column) -> Column:
        begin, h = acc["begin"], x["h"]
        demand, production, safety = (quantity(h[c]) for c in ("demand_qty", "production_qty", "safety_stock_qty"))
        todo = todo_qty(begin, demand, zero, zero, safety)
        end = end_qty(begin, demand, zero, zero, todo)
        seen = acc["seen"] | h.isNotNull()
        row = F.struct(x["dt"].alias("dt"), begin.alias("begin_stock_qty"), demand.alias("demand_qty"), production.alias("production_qty"),
                       zero.alias("trans_in_qty"), zero.alias("trans_out_qty"), safety.alias("safety_stock_qty"),
                       todo.alias("todo_qty"), end.alias("end_stock_qty"))
        return F.struct(end.alias("begin"), seen.alias("seen"),
                        F.concat(acc["rows"], F.when(seen, F.array(row)).otherwise(F.array().cast(row_type))).alias("rows"))

    folded = lined.select(*KEY, F.aggregate("plan", start, step, lambda acc: acc["rows"]).alias("rows"))
    return folded.select(*KEY, F.explode("rows").alias("r")).select(*KEY, "r.*")


def month_step(state: DataFrame, inputs: DataFrame, month: _dt.date) -> DataFrame:
    """One month from the carried state (key, begin, seen) and that month's inputs, both in the same buckets.

    Rows of keys that have not appeared so far are carried with ``active`` false.
    """
    c, zero = F.col, F.lit(0)
    j = state.join(shuffled(inputs), KEY, "left").withColumn("need", F.when(
        c("transfer").isNotNull(),
        F.greatest(F.coalesce(c("transfer.demand_qty"), zero) + F.coalesce(c("safety_stock_qty"), zero)
                   - c("begin_stock_qty"), zero).cast(QTY)))
    sent = (j.where(c("transfer").isNotNull())
            .groupBy(c("transfer.send_stockorg_code").alias("stockorg_code"),
                     c("transfer.send_sku_code").alias("sku_code"))
            .agg(F.sum("need").cast(QTY).alias("trans_out_qty"), F.lit(True).alias("sends")))
    k = j.join(shuffled(sent), KEY, "left")
    active = c("seen") | F.coalesce("here", "sends", F.lit(False))
    quantities = [F.coalesce(c(n), zero).cast(QTY).alias(m) for n, m in (
        ("demand_qty", "demand_qty"), ("production_qty", "production_qty"), ("need", "trans_in_qty"),
        ("trans_out_qty", "trans_out_qty"), ("safety_stock_qty", "safety_stock_qty"))]
    pivot = k.select(*KEY, F.lit(month).alias("dt"), "begin_stock_qty", *quantities, active.alias("active"))
    return todo_and_end(pivot, "active")


def rollforward(months: Sequence[_dt.date], stock0: DataFrame, demand: DataFrame, producibility: DataFrame,
                transfers: DataFrame, safety: DataFrame, buckets: int | None = None, run: str | None = None,
                tag: str = "rf") -> DataFrame:
    """The roll-forward over all plan months (see module doc).

    ``stock0`` is the first month's stock (B7), ``transfers`` the best transfers (B3), ``safety`` the safety stock
    (B6), ``producibility`` the line intervals (A3) or their coverage index. ``buckets`` defaults to
    ``spark.sql.shuffle.partitions``: then the needs, summed by their sender, arrive in the buckets' own partitioning, and
    a month has exactly one exchange, that of the needs.

    With ``run`` the tables stand in a folder of that name under the checkpoint folder. Called again with the same name
    and inputs, after the driver was lost, it builds only what its ledger doesn't list; other months or buckets are
    refused. ``drop_run`` deletes the folder. The result reads a catalog table (partitioned by month and role, bucketed
    by key) named after ``tag``, which ``sources.buckets.release`` takes away.
    """
    spark = demand.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not months:
        return spark.createDataFrame([], todo_and_end_schema(spark))
    store = BucketStore(spark, run_folder(spark, run) if run else scratch_table(spark, "rollforward"), KEY, n, tag)
    store.agree(months=list(months))
    try:
        keys = store.table("keys", lambda: key_history(months, stock0, demand, as_coverage(producibility), transfers, safety, n),
                           partition_by=["moves"], spread=False)
        todo = store.table("todo", lambda: fold_months(keys.where("NOT moves"), months).select(
            *KEY, *RESULT_COLUMNS[3:], F.lit(True).alias("active"), "dt", F.lit(False).alias("moves")), partition_by=["dt", "moves"])
        moving = keys.where("moves")
        if not moving.isEmpty():
            inputs = store.table("inputs", lambda: moving.select(*KEY, F.explode("months").alias("m")).select(
                *KEY, "m.*", F.lit(True).alias("here")), partition_by=["dt"])
            state = moving.select(*KEY, "begin_stock_qty", F.col("held").alias("seen"))
            for m in months:
                rows = store.table(f"month_{m:%Y_%m}", lambda: month_step(state, inputs.where(F.col("dt") == F.lit(m)).drop("dt"), m).drop("dt"),
                                   path=f"{store.path('todo')}/dt={m}/moves=true")
                state = rows.select(*KEY, F.col("end_stock_qty").alias("begin_stock_qty"), F.col("active").alias("seen"))
        store.recover(store.tables["todo"])
        todo = spark.table(store.tables["todo"])
    except BaseException:
        store.forget()
        raise
    store.forget("todo")
    return todo.where("active").select(*RESULT_COLUMNS)


def todo_and_end_schema(spark: SparkSession):
    fields = [T.StructField("stockorg_code", T.StringType()), T.StructField("sku_code", T.StringType()),
              T.StructField("dt", T.DateType())]
    fields += [T.StructField(c, QTY) for c in RESULT_COLUMNS[3:]]
    return T.StructType(fields)


def month_totals(result: DataFrame, pattern: str = r".*qty$") -> DataFrame:
    """The sum of every column whose name matches ``pattern``, per month."""
    import re

    rx = re.compile(pattern)
    cols = [c for c in result.columns if rx.fullmatch(c)]
    return result.groupBy("dt").agg(*[F.sum(c).alias(c) for c in cols])
