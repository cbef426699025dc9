"""Acquisition cohorts, monthly activity and retention.

No line is joined to a cohort table.  One aggregate by customer, combined
on the map side, gives the first month and the set of sales months (bounded
by the number of calendar months), which is then exploded:

* the cohort month is the first month of *any* line (returns included);
* activity counts known customers' sales months only;
* a cohort whose members first appear with a return may have no index 0,
  leaving size and rate null, and a rate can exceed 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start


def cohort(cleaned: DataFrame) -> DataFrame:
    """customer_id, cohort_month -- including the one null-customer group."""
    return (cleaned.groupBy("customer_id")
                   .agg(month_start(F.min("invoice_date")).alias("cohort_month")))


def cohort_activity(cleaned: DataFrame) -> DataFrame:
    """cohort_month, index (months since the cohort month, double), active_customers."""
    month = month_start(F.col("invoice_date"))
    sale = F.col("is_return") == 0
    # a sale without a date counts in the month null, as its own element of the set
    per_customer = cleaned.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min(month).alias("cohort_month"),
        F.collect_set(F.when(sale, F.struct(month.alias("m")))).alias("_months"))
    cm = per_customer.select("cohort_month", F.explode("_months").alias("_s"))
    # (customer, month) is unique here, so counting rows counts distinct customers
    return (cm.groupBy("cohort_month", F.months_between("_s.m", "cohort_month").alias("index"))
              .agg(F.count(F.lit(1)).alias("active_customers")))


def cohort_retention(activity: DataFrame) -> DataFrame:
    """Add cohort_size (active customers at index 0) and retention_rate.

    The activity table has one row per (cohort, index) -- months squared at
    most -- so a window by cohort replaces the source's self-join.  A null
    cohort month never matched in that join, so it is dropped here.
    """
    by_cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("index") == 0, F.col("active_customers"))).over(by_cohort)
    return (activity.filter(F.col("cohort_month").isNotNull())
                    .withColumn("cohort_size", size)
                    .withColumn("retention_rate",
                                F.col("active_customers").cast("double") / F.col("cohort_size")))


# ------------------------------------------------------------------ growing tables

MONTHS_A_WORD = 60


def month_bits(cleaned: DataFrame) -> DataFrame:
    """The months of every known customer as bits, which later lines are merged into.

    One row for each customer and stretch of 60 months (``era``; null holds lines without a date):
    ``first_month`` (12 x year + month) of any line there, and ``sale_bits`` with a bit
    for each month with a sale.  Both are mergeable, so a new month of lines
    needs the old bits only, never the old lines (``merge_month_bits``).
    """
    number = F.year("invoice_date") * 12 + F.month("invoice_date") - 1
    sale = F.col("is_return") == 0
    at = F.coalesce(F.col("_m") % MONTHS_A_WORD, F.lit(0)).cast("int")
    lines = cleaned.filter(F.col("customer_id").isNotNull()).select("customer_id", number.alias("_m"), sale.alias("_sale"))
    bit = F.when(F.col("_sale"), F.call_function("shiftleft", F.lit(1).cast("bigint"), at)).otherwise(F.lit(0).cast("bigint"))
    return lines.groupBy("customer_id", F.floor(F.col("_m") / MONTHS_A_WORD).cast("int").alias("era")).agg(
        F.min("_m").alias("first_month"), F.bit_or(bit).alias("sale_bits"))


def merge_month_bits(*tables: DataFrame) -> DataFrame:
    """The bits of all lines that any of the tables was made from."""
    both = reduce(DataFrame.unionByName, tables)
    return both.groupBy("customer_id", "era").agg(F.min("first_month").alias("first_month"), F.bit_or("sale_bits").alias("sale_bits"))


def activity_from_bits(bits: DataFrame) -> DataFrame:
    """The table of ``cohort_activity``, from bits instead of lines."""
    eras = bits.groupBy("customer_id").agg(
        F.min("first_month").alias("_joined"), F.collect_list(F.struct("era", "sale_bits")).alias("_eras"))   # a few stretches a customer
    each = eras.select("_joined", F.explode("_eras").alias("_e")).select("_joined", "_e.era", "_e.sale_bits")
    months = F.filter(F.sequence(F.lit(0), F.lit(MONTHS_A_WORD - 1)), lambda k: F.col("sale_bits").bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), k)) != 0)
    active = each.select("_joined", "era", F.explode(months).alias("_k"))
    month = F.col("era") * MONTHS_A_WORD + F.col("_k")
    joined = F.make_date(F.floor(F.col("_joined") / 12).cast("int"), (F.col("_joined") % 12 + 1).cast("int"), F.lit(1))
    return active.groupBy(month_start(joined).alias("cohort_month"), (month - F.col("_joined")).cast("double").alias("index")).agg(
        F.count(F.lit(1)).alias("active_customers"))
