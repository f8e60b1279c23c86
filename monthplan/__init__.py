"""Monthly production planning on Spark.

Every operator is a function from DataFrames to a DataFrame.  Sub-packages:

* ``sources``   -- test-data fixtures, batch loaders, parquet / JDBC readers and writers
* ``functions`` -- month arithmetic, interval expansion, quantity types
* ``operators`` -- the planning stages: demand and transfers, stock roll-forward,
                   line types and capacity, capacity rebalance, advance production
* ``plans``     -- named queries wired from the operators, and their SQL oracles
* ``streaming`` -- a micro-batch trigger that re-plans each batch as it lands
"""

__version__ = "0.1.0"
