"""Sources of raw transaction lines.

``transactions_from_tpch`` derives the raw retail table from the star-schema
test tables (one lineitem row becomes one transaction line).  It is the
input of every registered query; it is written with the DataFrame API so
that column pruning and filters reach each parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_TRANSACTIONS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def transactions_from_tpch(spark: SparkSession, sf_dir: str, item_column: str = "p_brand") -> DataFrame:
    """Raw transaction lines (schema ``RAW_TRANSACTIONS``) from the test tables.

    Mapping: returned-and-final lines become cancellations (``C`` invoice,
    negative quantity); the brand (25 values; or ``item_column``, such as the
    part key) is the item code and the part name its description; the date string is padded ``' dd-MM-yyyy HH:mm'``; every
    tenth order is anonymous.
    """
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    # what a line needs of its own columns, before the joins: the rows that are shuffled stay narrow
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", cancelled.alias("_cancelled"),
        F.when(cancelled, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("_quantity"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_tax") == 0), F.lit(0.05)).otherwise(F.col("l_extendedprice")).alias("_price"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")

    # nation is a fixed 25-row code table, so broadcasting it is bounded;
    # the other joins are left to the planner (AQE converts them to
    # broadcast joins only when the runtime size is under the threshold).
    # Customers are joined to the orders, which are fewer than the lines; the
    # join by order comes last, so the lines of an order leave it side by side.
    placed = (orders.join(customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")),
                          F.col("o_custkey") == F.col("c_custkey"))
                    .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    j = li.join(part, F.col("l_partkey") == F.col("p_partkey")).join(placed, F.col("l_orderkey") == F.col("o_orderkey"))

    key = F.col("l_orderkey").cast("string")
    return j.select(
        F.when(F.col("_cancelled"), F.concat(F.lit("C"), key)).otherwise(key).alias("InvoiceNo"),
        F.col(item_column).cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("_quantity").cast("int").alias("Quantity"),
        F.concat(F.lit(" "), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(" "),
                 _two_digits(F.col("l_orderkey") % 24), F.lit(":"),
                 _two_digits(F.col("l_orderkey") % 60)).alias("InvoiceDate"),
        F.col("_price").cast("decimal(12,2)").alias("UnitPrice"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def read_raw_table(spark: SparkSession, name: str) -> DataFrame:
    """The catalog form of the source: ``spark.read.table`` with the fixed columns."""
    return spark.read.table(name).select(*[f.name for f in RAW_TRANSACTIONS.fields])


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_TRANSACTIONS).parquet(path)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw export as CSV (header, fixed schema, malformed records fail)."""
    from .files import load_csv
    return load_csv(spark, path, RAW_TRANSACTIONS)
