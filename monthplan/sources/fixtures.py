"""Raw (pre-load) planning inputs derived from the TPC-H-style test tables.

The planning inputs of a real run come from a warehouse, one ``batch_id`` per run.  Here they are derived from
``/root/testdata/sf*/`` with plain column arithmetic, so a Spark query and an SQL oracle can each rebuild them from the
same parquet files.  Every shipped line counts: a half-year is a batch, a SKU is a part, and all raw tables hold all
batches, so a loader's ``batch_id`` filter picks rows of data.  Producibility, rules, routes and priorities are built
from the (nation, part, month) triples that occur, never from a grid.

Each raw table also carries rows that exactly one loader filter must drop (``producibility = 0``, ``demand_type = 20``,
``max_hour = 0``, ``production_rate = 0``, an older ``day_date``) and awkward ones that must stay: NULL demand, NULL
priorities, factories without a ceiling, gap rows that come twice.

Fixed values of the fixture recipe (shared with the SQL oracle in ``monthplan.plans.oracle``):
"""

from __future__ import annotations

import datetime as dt
import threading
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthplan.functions.joins import counted
from monthplan.functions.quantities import QTY

# --- fixed values of the fixture recipe -------------------------------------------------------------------------
FIRST_YEAR = 1990                     # batch ids count half-years from here: 1990 H1 is 1
HORIZON_START = dt.date(1997, 1, 1)   # first plan month of the planned batch
HORIZON_MONTHS = 6                    # plan months of a batch
BATCH = 15                            # the planned batch: 1997 H1
STOCK_MONTH = dt.date(1996, 12, 1)    # a batch opens with half of the shipments of the month before it
N_LINES = 5                           # lines 0..4 per factory; 0,1 pure; 0,2 bottle; line 4 may be special
SENDERS = 3                           # a part may also be made by the next three nations, which send it
UNROUTABLE = (40, 7)                  # no transfer route for parts k % 40 = 7
NULL_DEMAND = (17, 5)                 # demand is NULL for parts k % 17 = 5 in even months
NULL_ROUTE = (11, 3)                  # the nearest sender's priority is NULL for parts k % 11 = 3
NULL_LINE = (13, 4)                   # lines 0 and 1 have a NULL priority for parts k % 13 = 4
NO_CEILING = (6, 4)                   # nations n % 6 = 4 have no ceiling
TWICE = (4, 2)                        # nations n % 4 = 2 have a second gap row for this line type, short of 5
TWICE_LINETYPE = "ordinary-can"
SPECIAL_LINES = ("SPECIAL_A", "SPECIAL_B")  # line 4 of nations n % 5 = 0 and n % 5 = 1
PURE_FLAG = "Y"
# ------------------------------------------------------------------------------------------------------------------


class Tables:
    """Lazy readers of the test tables, each with only the columns the fixtures need (one relation per table)."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.keep = keep  # optional (name, DataFrame) -> DataFrame that materialises a shared intermediate
        self._rel: dict[str, DataFrame] = {}
        self._memo: dict[str, DataFrame] = {}
        self._lock = threading.Lock()  # loaders may run on several driver threads at once
        self._memo_locks: dict[str, threading.Lock] = {}

    def memo(self, name: str, build, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """A fixture intermediate shared by several raw tables, built (and optionally written) once."""
        with self._lock:
            lock = self._memo_locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._memo:
                df = build()
                self._memo[name] = self.keep(name, df, partition_by) if self.keep else df
            return self._memo[name]

    def read(self, name: str, *cols: str) -> DataFrame:
        with self._lock:
            if name not in self._rel:
                self._rel[name] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
            df = self._rel[name]
        return df.select(*cols) if cols else df


def _code(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), 2, "0"))


def factory_code(n: str | Column = "n") -> Column:
    return _code("F", F.col(n) if isinstance(n, str) else n)


def stockorg_code(n: str | Column = "n") -> Column:
    return F.concat(F.lit("warehouse."), factory_code(n))


def sku_code(k: str | Column = "k") -> Column:
    return F.concat(F.lit("S"), (F.col(k) if isinstance(k, str) else k).cast("string"))


def line_code(n: str = "n", i: str = "i") -> Column:
    return (F.when((F.col(i) == 4) & (F.col(n) % 5 == 0), F.lit(SPECIAL_LINES[0]))
            .when((F.col(i) == 4) & (F.col(n) % 5 == 1), F.lit(SPECIAL_LINES[1]))
            .otherwise(F.concat(factory_code(n), F.lit("_L"), F.col(i).cast("string"))))


def _horizon(start: dt.date, months: int) -> tuple[dt.date, dt.date]:
    end_y, end_m = divmod(start.month - 1 + months, 12)
    return start, dt.date(start.year + end_y, end_m + 1, 1)


def _range(col: str, n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(col)


def _is(col: str, rule: tuple[int, int]) -> Column:
    return F.col(col) % rule[0] == rule[1]


def batch_of(d: Column) -> Column:
    """The half-year of a date, counted from FIRST_YEAR."""
    return ((F.year(d) - FIRST_YEAR) * 2 + F.when(F.month(d) <= 6, 1).otherwise(2)).cast("int")


def batch_start(batch: str = "batch_id") -> Column:
    b = F.col(batch) - 1
    return F.make_date(F.floor(b / 2).cast("int") + FIRST_YEAR, (b % 2 * 6 + 1).cast("int"), F.lit(1))


def _month_cols(d: Column, prefix: str = "") -> list[Column]:
    return [F.year(d).alias(f"{prefix}year"), F.month(d).alias(f"{prefix}month")]


def nations(t: Tables) -> DataFrame:
    return t.read("nation", "n_nationkey", "n_name").withColumnRenamed("n_nationkey", "n")


def n_nations(t: Tables) -> int:
    """How many nations there are: senders wrap around."""
    if "n_nations" not in t.__dict__:
        t.n_nations = nations(t).count()
    return t.n_nations


def shipments(t: Tables) -> DataFrame:
    """Shipped quantity per (batch, nation of the supplier, part, ship month): the one scan of ``lineitem``.

    Written with a folder for each batch, so that a loader's batch filter reads its own batch's files.
    """
    return t.memo("shipments", lambda: _shipments(t), ("batch_id",))


def _shipments(t: Tables) -> DataFrame:
    # dealt by part and month, which both sums share: a line is shuffled once
    li = (t.read("lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
          .select("l_suppkey", "l_partkey", F.trunc(F.to_date("l_shipdate"), "month").alias("dt"), "l_quantity")
          .repartition("l_partkey", "dt").groupBy("l_suppkey", "l_partkey", "dt")
          .agg(F.sum("l_quantity").alias("qty")))  # combined before the join: only sums meet the suppliers
    sup = t.read("supplier", "s_suppkey", "s_nationkey")
    return (li.join(counted(sup), li.l_suppkey == sup.s_suppkey)
            .groupBy(F.col("s_nationkey").alias("n"), F.col("l_partkey").alias("k"), "dt")
            .agg(F.sum("qty").cast("bigint").alias("qty"))
            .withColumn("batch_id", batch_of(F.col("dt"))))


def _pairs(t: Tables) -> DataFrame:
    """(batch, n, k) that occur."""
    return shipments(t).select("batch_id", "n", "k").distinct()


def _makers(df: DataFrame, t: Tables) -> DataFrame:
    """``df`` for its own nation and for those that may send to it, each row once."""
    return df.withColumn("n", F.explode(F.array(*[(F.col("n") + h) % n_nations(t) for h in range(SENDERS + 1)]))).distinct()


def _with_lines(df: DataFrame) -> DataFrame:
    """Each part is made on the lines of its parity."""
    return df.select("*", _range("i", N_LINES)).where((F.col("k") + F.col("i")) % 2 == 0)


def plan_config_raw(t: Tables) -> DataFrame:
    """Plan months per batch: the ship months."""
    return (shipments(t).select("batch_id", F.col("dt").alias("start_date")).distinct()
            .withColumn("day_date", batch_start()))


def demand_raw(t: Tables) -> DataFrame:
    qty = F.when(~(_is("k", NULL_DEMAND) & (F.month("dt") % 2 == 0)), F.col("qty").cast(QTY))
    base = shipments(t).select("batch_id", stockorg_code().alias("stockorg_code"), sku_code().alias("sku_code"),
                               *_month_cols(F.col("dt")), qty.alias("demand_qty"))
    return base.select("*", F.explode(F.array(F.lit(10), F.lit(20))).alias("demand_type"))


def factory_totals(t: Tables) -> DataFrame:
    """Shipped quantity per batch and factory (``batch_id``, ``n``, ``total``)."""
    return shipments(t).groupBy("batch_id", "n").agg(F.sum("qty").alias("total"))


def stock_raw(t: Tables) -> DataFrame:
    opens = F.add_months("dt", 1)
    return shipments(t).where(F.month("dt") % 6 == 0).select(
        batch_of(opens).alias("batch_id"), stockorg_code().alias("stockorg_code"), sku_code().alias("sku_code"),
        opens.alias("stock_date"), (F.col("qty").cast(QTY) * F.lit(0.5)).cast(QTY).alias("available_qty"))


def line_info_raw(t: Tables) -> DataFrame:
    lines = _makers(shipments(t).select("batch_id", "n").distinct(), t).select("*", _range("i", N_LINES))
    pure = F.when(F.col("i").isin(0, 1), F.lit(PURE_FLAG)).otherwise(F.lit("N"))
    package = F.when(F.col("i").isin(0, 2), F.lit("bottle")).otherwise(F.lit("can"))
    return lines.select("batch_id", factory_code().alias("factory_code"), line_code().alias("line_code"),
                        pure.alias("is_pure_draft"), package.alias("package_type"))


def producibility_raw(t: Tables) -> DataFrame:
    months = F.when((F.col("n") + F.col("k")) % 10 == 1, F.lit(3)).otherwise(F.lit(HORIZON_MONTHS))
    g = _with_lines(_makers(_pairs(t), t)).withColumn("first", batch_start()).withColumn(
        "last", F.add_months("first", months))
    return g.select("batch_id", factory_code().alias("factory_code"), line_code().alias("line_code"),
                    sku_code().alias("sku_code"), *_month_cols(F.col("first"), "start_"),
                    *_month_cols(F.col("last"), "end_"),
                    F.when((F.col("k") + F.col("n")) % 4 != 0, F.lit(1)).otherwise(F.lit(0)).alias("producibility"))


def safety_raw(t: Tables) -> DataFrame:
    g = _pairs(t).withColumn("first", batch_start()).select(
        "batch_id", "n", "k", F.explode(F.array(
            F.struct(F.col("first").alias("a"), F.add_months("first", 3).alias("b"), (3 + F.col("k") % 5).alias("days")),
            F.struct(F.add_months("first", 3).alias("a"), F.add_months("first", 6).alias("b"),
                     (5 + F.col("k") % 3).alias("days")))).alias("q"))
    return g.select("batch_id", stockorg_code().alias("stockorg_code"), sku_code().alias("sku_code"),
                    *_month_cols(F.col("q.a"), "start_"), *_month_cols(F.col("q.b"), "end_"),
                    F.col("q.days").alias("safety_stock_days"))


def route_raw(t: Tables) -> DataFrame:
    g = shipments(t).where(~_is("k", UNROUTABLE)).select("batch_id", "n", "k", "dt", _range("j", SENDERS)).withColumn(
        "h", F.col("j") + 1)
    priority = F.when(~((F.col("h") == 1) & _is("k", NULL_ROUTE)), F.floor((F.col("h") + 1) / 2).cast("int"))
    return g.select("batch_id", sku_code().alias("receive_sku_code"), stockorg_code().alias("receive_stockorg_code"),
                    sku_code().alias("send_sku_code"),
                    stockorg_code((F.col("n") + F.col("h")) % n_nations(t)).alias("send_stockorg_code"),
                    priority.alias("priority"), *_month_cols(F.col("dt")))


def line_capacity_raw(t: Tables) -> DataFrame:
    g = factory_totals(t).select("batch_id", "n", _range("i", N_LINES)).withColumn("first", batch_start())
    base = g.select("batch_id", factory_code().alias("factory_code"), line_code().alias("line_code"),
                    *_month_cols(F.col("first"), "start_"), *_month_cols(F.add_months("first", HORIZON_MONTHS), "end_"),
                    (F.lit(8) + 2 * F.col("i") + F.col("n") % 4).alias("max_hour"))
    return base.unionByName(base.withColumn("max_hour", F.col("max_hour") * 0))


def _thousandths(total: Column, factor: int, divisor: int) -> Column:
    """``total * factor / divisor`` truncated to three places, exactly (whole-number arithmetic)."""
    return (F.floor(total * F.lit(factor * 1000) / F.lit(divisor)).cast("decimal(18,0)")
            * F.lit(0.001).cast("decimal(4,3)")).cast(QTY)


def rate_raw(t: Tables) -> DataFrame:
    """One rate per line and month, ``total/6/60 * (1 + i/10)``; line 0 has a second rate x1.2 (so the mean matters)."""
    g = (factory_totals(t).select("batch_id", "n", "total", _range("i", N_LINES))
         .select("*", _range("m", HORIZON_MONTHS)).withColumn("dt", F.add_months(batch_start(), F.col("m"))))
    keys = ["batch_id", factory_code().alias("factory_code"), line_code().alias("line_code")]
    when = [*_month_cols(F.col("dt"), "start_"), *_month_cols(F.col("dt"), "end_")]
    main = g.select(*keys, _thousandths(F.col("total") * (10 + F.col("i")), 1, 3600).alias("production_rate"), *when)
    second = g.where(F.col("i") == 0).select(
        *keys, _thousandths(F.col("total"), 12, 3600).alias("production_rate"), *when)
    zero = g.where(F.col("i") == 1).select(*keys, F.lit(0).cast(QTY).alias("production_rate"), *when)
    return main.unionByName(second).unionByName(zero)


def priority_raw(t: Tables) -> DataFrame:
    g = _with_lines(_makers(shipments(t).select("batch_id", "n", "k", "dt"), t))
    value = ((F.col("i") * 7 + F.col("k") * 3 + F.month("dt")) % 5) * 10 + F.col("i")
    return g.select("batch_id", factory_code().alias("factory_code"), line_code().alias("line_code"),
                    sku_code().alias("sku_code"), *_month_cols(F.col("dt")),
                    F.when(~(_is("k", NULL_LINE) & (F.col("i") <= 1)), value.cast("int")).alias("priority"))


def stockorg_dim_raw(t: Tables) -> DataFrame:
    nat = nations(t)
    cur = nat.select(stockorg_code().alias("stockorg_code"), F.col("n_name").alias("stockorg_name"),
                     factory_code().alias("parent_org_code"), F.lit(HORIZON_START).alias("day_date"))
    old = nat.select(stockorg_code().alias("stockorg_code"), F.col("n_name").alias("stockorg_name"),
                     factory_code((F.col("n") + 1) % n_nations(t)).alias("parent_org_code"),
                     F.lit(STOCK_MONTH).alias("day_date"))
    return cur.unionByName(old)


def factory_capacity_raw(t: Tables) -> DataFrame:
    """Factory ceiling ``0.9 * total / 6`` over the whole horizon; some factories have none."""
    tot = factory_totals(t).where(~_is("n", NO_CEILING)).withColumn("first", batch_start())
    return tot.select("batch_id", factory_code().alias("factory_code"), *_month_cols(F.col("first"), "start_"),
                      *_month_cols(F.add_months("first", HORIZON_MONTHS), "end_"),
                      _thousandths(F.col("total"), 3, 20).alias("equilibrium_capacity"))


def linetype_capacity_raw(capacity: DataFrame) -> DataFrame:
    """Line-type capacity as a table of several batches holds it: the planned one, and another run's."""
    other = capacity.withColumn("capacity", F.lit(1).cast(capacity.schema["capacity"].dataType))
    return capacity.withColumn("batch_id", F.lit(BATCH)).unionByName(other.withColumn("batch_id", F.lit(BATCH + 1)))


def capacity_gap_raw(gap: DataFrame) -> DataFrame:
    """Gap rows of several batches; some factories report one line type in two rows."""
    number = F.substring("factory_code", 2, 10).cast("int")
    second = gap.where((F.col("linetype") == TWICE_LINETYPE) & (number % TWICE[0] == TWICE[1])).select(
        "factory_code", "linetype", "dt", F.lit(0).cast(QTY).alias("qty_surplus"), F.lit(5).cast(QTY).alias("qty_shortage"))
    rows = gap.select("factory_code", "linetype", "dt", "qty_surplus", "qty_shortage").unionByName(second)
    other = rows.withColumn("qty_shortage", (F.col("qty_shortage") * 2).cast(QTY))
    return rows.withColumn("batch_id", F.lit(BATCH)).unionByName(other.withColumn("batch_id", F.lit(BATCH + 1)))


RAW_TABLES = {
    "plan_config_raw": plan_config_raw,
    "stock_raw": stock_raw,
    "producibility_raw": producibility_raw,
    "safety_raw": safety_raw,
    "route_raw": route_raw,
    "demand_raw": demand_raw,
    "line_info_raw": line_info_raw,
    "line_capacity_raw": line_capacity_raw,
    "rate_raw": rate_raw,
    "priority_raw": priority_raw,
    "stockorg_dim_raw": stockorg_dim_raw,
    "factory_capacity_raw": factory_capacity_raw,
}
