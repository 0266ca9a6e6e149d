"""Adapter: the driver's TPC-H-style parquet tables as a sales warehouse.

Mapping (see FIXTURES.md section 3):

* headers  <- orders: dockey=o_orderkey, docdate=date(o_orderdate),
              debtorcode = nation name of the ordering customer
* lines    <- lineitem: dockey=l_orderkey, itemcode=l_partkey,
              amount=l_extendedprice, projno='RET' for returned lines else null
* items    <- part: itemcode=p_partkey, itemtype=p_type
* channel2 <- orders: debtorcode as above, docdate=date(o_orderdate),
              amount=o_totalprice, category=o_orderpriority,
              invtype='Return' when o_orderstatus='P' else 'Normal'

The nation table has a fixed size (25 rows) so it is broadcast; the
orders-customer join is left to the planner (sort-merge at scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .warehouse import Warehouse

# --- fixed values -----------------------------------------------------------
# Run date that makes the test data "current": orders end 2001-08-01, so the
# closed months end at 2001-07 and the activity window starts 2001-05-01.
TESTDATA_AS_OF = "2001-08-15"
TESTDATA_CUTOFF = "2001-07"
# --- end of fixed values ----------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _debtor_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cust_nation = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    orders = table(spark, sf_dir, "orders")
    return orders.join(cust_nation, orders.o_custkey == cust_nation.c_custkey)


def warehouse_from_testdata(spark: SparkSession, sf_dir: str, debtor: str = "n_name", amount: str = "l_extendedprice") -> Warehouse:
    """``debtor``: the customer code (the nation's name, or ``o_custkey``); ``amount``: SQL of a line's amount."""
    orders = _debtor_of_order(spark, sf_dir)
    code = F.col(debtor).cast("string")
    headers = orders.select(
        F.col("o_orderkey").cast("long").alias("dockey"),
        F.col("o_orderdate").cast("date").alias("docdate"),
        code.alias("debtorcode"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("dockey"),
        F.col("l_partkey").cast("long").alias("itemcode"),
        F.expr(amount).cast("double").alias("amount"),
        F.when(F.col("l_returnflag") == "R", F.lit("RET")).alias("projno"),
    )
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("itemcode"),
        F.col("p_type").alias("itemtype"),
    )
    channel2 = orders.select(
        code.alias("debtorcode"),
        F.col("o_orderdate").cast("date").alias("docdate"),
        F.col("o_totalprice").cast("double").alias("amount"),
        F.col("o_orderpriority").alias("category"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Return")).otherwise(F.lit("Normal")).alias("invtype"),
    )
    return Warehouse(headers=headers, lines=lines, items=items, channel2=channel2)


# The same adapter as DuckDB SQL views (used by the oracle queries).
ORACLE_ADAPTER_SQL = """
iv AS (
  SELECT CAST(o.o_orderkey AS BIGINT) AS dockey, CAST(o.o_orderdate AS DATE) AS docdate, n.n_name AS debtorcode
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
ivdtl AS (
  SELECT CAST(l_orderkey AS BIGINT) AS dockey, CAST(l_partkey AS BIGINT) AS itemcode,
         CAST(l_extendedprice AS DOUBLE) AS amount,
         CASE WHEN l_returnflag = 'R' THEN 'RET' END AS projno
  FROM lineitem),
item AS (SELECT CAST(p_partkey AS BIGINT) AS itemcode, p_type AS itemtype FROM part),
ch2 AS (
  SELECT n.n_name AS debtorcode, CAST(o.o_orderdate AS DATE) AS docdate, CAST(o.o_totalprice AS DOUBLE) AS amount,
         o.o_orderpriority AS category,
         CASE WHEN o.o_orderstatus = 'P' THEN 'Return' ELSE 'Normal' END AS invtype
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""
