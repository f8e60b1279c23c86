"""The typed result tables of the pipeline, as explicit ``StructType``s.

The stages return DataFrames rather than filling pre-created empty tables; these schemas state what each result
holds (names and types; quantities ``decimal(18,3)``, roll-up sums ``decimal(28,3)``), and the tests check the
operators against them.
"""

from __future__ import annotations

from pyspark.sql import types as T

from monthplan.functions.quantities import QTY

S, D = T.StringType(), T.DateType()
SUM_QTY = T.DecimalType(28, 3)  # a sum of decimal(18,3) quantities: ten more integer digits, still exact


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


QTY8 = [(c, QTY) for c in ("begin_stock_qty", "demand_qty", "production_qty", "trans_in_qty", "trans_out_qty",
                           "safety_stock_qty", "todo_qty", "end_stock_qty")]

SUM8 = [(c, SUM_QTY) for c, _ in QTY8]

ROLLFORWARD = _struct(("stockorg_code", S), ("sku_code", S), ("dt", D), *QTY8)
SKU_LINETYPE = _struct(("factory_code", S), ("stockorg_code", S), ("sku_code", S), ("dt", D),
                       ("linetypes", T.ArrayType(S)), ("linetype", S))
WAREHOUSE_LINETYPE_TODO = _struct(("stockorg_code", S), ("linetype", S), ("dt", D), *SUM8)
FACTORY_LINETYPE_TODO = _struct(("factory_code", S), ("linetype", S), ("dt", D), *SUM8)
FACTORY_SKU_TODO = _struct(("factory_code", S), ("dt", D), ("sku_code", S), ("linetype", S), *SUM8)
ASSIGNED_CAPACITY = _struct(("factory_code", S), ("linetype", S), ("dt", D), ("capacity", QTY),
                            ("assigned_capacity", QTY), ("todo_qty", QTY), ("todo_left", QTY))
MOVES = _struct(("factory_code", S), ("linetype", S), ("linetype2", S), ("dt", D), ("qty_tomove", QTY),
                ("batch_id", T.IntegerType()))
MONTH_TO_MOVE = _struct(("factory_code", S), ("linetype", S), ("dt", D), ("qty_tomove", QTY), ("qty_left", QTY),
                        ("batch_id", T.IntegerType()))


def shape(schema: T.StructType) -> list[tuple[str, str]]:
    """Names and types, ignoring nullability (Spark derives that from the plan)."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
