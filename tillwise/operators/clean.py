"""Staging, cleaning, dimensions and the two profiling queries.

All are narrow transformations except the dimensions (one shuffle each on
the distinct key) and the profiles (global aggregates with map-side
partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import repair_date, repair_timestamp

STAGE_COLUMNS = ["invoice_number", "item_code", "item_description", "quantity",
                 "invoice_date", "invoice_timestamp", "price", "customer_id", "country"]

CLEAN_COLUMNS = ["invoice_number", "item_code", "item_description", "quantity",
                 "invoice_date", "invoice_timestamp", "price", "revenue", "customer_id",
                 "is_anonymous", "is_return", "country"]


def stage(raw: DataFrame, extra_date_formats: list[str] | None = None) -> DataFrame:
    """Rename to snake case and repair the date string into a date and a timestamp.

    By default only the positional repair is applied (a value it cannot read
    becomes null); ``extra_date_formats`` adds fallback patterns.
    """
    return raw.select(
        F.col("InvoiceNo").alias("invoice_number"),
        F.col("StockCode").alias("item_code"),
        F.col("Description").alias("item_description"),
        F.col("Quantity").alias("quantity"),
        repair_date(F.col("InvoiceDate"), extra_date_formats).alias("invoice_date"),
        repair_timestamp(F.col("InvoiceDate"), extra_date_formats).alias("invoice_timestamp"),
        F.col("UnitPrice").alias("price"),
        F.col("CustomerID").alias("customer_id"),
        F.col("Country").alias("country"),
    )


def clean(staged: DataFrame) -> DataFrame:
    """Add revenue (negative for negative quantities) and the 0/1 flags.

    ``is_return`` is a case-sensitive ``LIKE 'C%'`` on the invoice number.
    """
    return staged.select(
        "invoice_number", "item_code", "item_description", "quantity",
        "invoice_date", "invoice_timestamp", "price",
        (F.col("quantity") * F.col("price")).alias("revenue"),
        "customer_id",
        F.when(F.col("customer_id").isNull(), 1).otherwise(0).alias("is_anonymous"),
        F.when(F.col("invoice_number").like("C%"), 1).otherwise(0).alias("is_return"),
        "country",
    )


def customer_dim(cleaned: DataFrame) -> DataFrame:
    """Distinct (customer_id, country) of known customers; not unique by customer."""
    return (cleaned.filter(F.col("is_anonymous") == 0)
                   .select("customer_id", "country").distinct())


def product_dim(cleaned: DataFrame) -> DataFrame:
    """Distinct (item_code, item_description) of plausible lines (quantity > 0, price >= 0.1)."""
    return (cleaned.filter((F.col("quantity") > 0) & (F.col("price") >= F.lit(0.1)))
                   .select("item_code", "item_description").distinct())


def profile(staged: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Row count, date range and three distinct counts in one pass.

    Exact distinct counts are planned by Catalyst as an Expand followed by
    a two-phase aggregate (partial dedup before the shuffle).  At scale
    ``approximate=True`` uses HyperLogLog++ sketches instead: one stage, a
    few KB of state per column.
    """
    distinct = ((lambda c: F.approx_count_distinct(c, rsd)) if approximate
                else F.countDistinct)
    return staged.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("invoice_date").alias("min_invoice_date"),
        F.max("invoice_date").alias("max_invoice_date"),
        distinct("customer_id").alias("customers"),
        distinct("item_code").alias("items"),
        distinct("country").alias("countries"),
    )


def with_month(cleaned: DataFrame) -> DataFrame:
    """Add ``invoice_month`` (its first day), to partition the cleaned table by; lines without a date have none."""
    return cleaned.withColumn("invoice_month", F.trunc("invoice_date", "month"))


#: Logarithm of the registers of a distinct-count sketch: about 0.8 % standard error in 16 KB.
SKETCH_BITS = 14


def profile_sketch(staged: DataFrame, load: str) -> DataFrame:
    """One row for a load of lines: its counts, dates and mergeable distinct-count sketches.

    Append it to a small table at every load; ``profile_of_sketches`` then gives the profile
    of the grown table without reading its lines.
    """
    sketch = lambda c: F.hll_sketch_agg(F.col(c), F.lit(SKETCH_BITS))
    return staged.agg(
        F.lit(load).alias("load"), F.count(F.lit(1)).alias("row_count"), F.min("invoice_date").alias("min_invoice_date"),
        F.max("invoice_date").alias("max_invoice_date"), *[sketch(c).alias(c) for c in ("customer_id", "item_code", "country")])


def profile_of_sketches(sketches: DataFrame) -> DataFrame:
    """The profile of all loads together; the distinct counts are estimates (see ``SKETCH_BITS``)."""
    distinct = lambda c: F.hll_sketch_estimate(F.hll_union_agg(F.col(c)))
    return sketches.agg(
        F.sum("row_count").alias("row_count"), F.min("min_invoice_date").alias("min_invoice_date"),
        F.max("max_invoice_date").alias("max_invoice_date"), distinct("customer_id").alias("customers"),
        distinct("item_code").alias("items"), distinct("country").alias("countries"))


def sanity(staged: DataFrame, fixed_returns: bool = False) -> DataFrame:
    """Total revenue, returns and lines without customer -- one scan.

    ``returns`` keeps the source's predicate ``quantity < 0 OR
    lower(invoice_number) LIKE 'C%'``; the second arm can never be true (a
    lower-cased string has no upper-case ``C``), so only negative quantities
    count.  ``fixed_returns=True`` gives the evident intent instead: negative
    quantity or an invoice number starting with ``C`` in either case.  The
    output column name keeps the source's spelling.
    """
    prefix = F.upper("invoice_number") if fixed_returns else F.lower("invoice_number")
    return staged.agg(
        F.sum(F.col("quantity") * F.col("price")).cast("double").alias("revenue"),
        F.count_if((F.col("quantity") < 0) | prefix.like("C%")).alias("returns"),
        # Fixed value: this spelling is the column's name.
        F.count_if(F.col("customer_id").isNull()).alias("invaild_customers"),
    )
