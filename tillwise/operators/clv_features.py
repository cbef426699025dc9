"""CLV feature table: history before a cutoff, revenue in the window after it.

The source scans the lines twice (history CTE, future CTE) and left-joins
the two aggregates.  Both are conditional aggregates over the same sales
lines grouped by the same key, so here they are one ``groupBy`` with
``when``-guarded aggregates: one shuffle, map-side partial aggregation, no
join.  Customers with no history line get no row (the source's LEFT JOIN
starts from history), future revenue defaults to 0.

``avg_order_value`` keeps the source's meaning: the mean *line* revenue.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def default_end(cleaned: DataFrame):
    """Scalar subquery: the last invoice date (the default end of the window)."""
    return cleaned.agg(F.max("invoice_date")).scalar()


def clv_features(cleaned: DataFrame, cutoff: str | _dt.date | None = None,
                 end: str | _dt.date | None = None) -> DataFrame:
    """Per known customer with history: orders, revenue, mean line revenue,
    first/last dates, days since first/last (to the cutoff), future revenue.

    ``cutoff``/``end`` default to (last date - 6 months, last date); the
    history window is ``date < cutoff``, the future window
    ``cutoff <= date <= end`` (closed at both ends).  On a table partitioned
    by ``invoice_month`` (``clean.with_month``) the end also prunes partitions.
    """
    sales = cleaned.filter((F.col("is_anonymous") == 0) & (F.col("is_return") == 0))
    last = default_end(cleaned) if (cutoff is None or end is None) else None
    e_val = F.lit(end).cast("date") if end is not None else last
    c_val = F.lit(cutoff).cast("date") if cutoff is not None else F.add_months(last, -6)
    # lines after the window are never used; the bound reaches the scan
    # (a literal, or a runtime scalar-subquery filter)
    sales = (sales.filter(F.col("invoice_date") <= e_val)
                  .withColumns({"_cutoff": c_val, "_end": e_val}))

    if "invoice_month" in cleaned.columns:   # a table partitioned by month: later months are not read
        sales = sales.filter(F.col("invoice_month") <= F.trunc(e_val, "month"))

    hist = F.col("invoice_date") < F.col("_cutoff")
    fut = (F.col("invoice_date") >= F.col("_cutoff")) & (F.col("invoice_date") <= F.col("_end"))
    hist_rev = F.when(hist, F.col("revenue"))
    agg = sales.groupBy("customer_id").agg(
        F.countDistinct(F.when(hist, F.col("invoice_number"))).alias("total_orders"),
        F.sum(hist_rev).alias("_rev"),
        F.count(hist_rev).alias("_n_hist"),
        F.count_if(hist).alias("_hist_lines"),
        F.min(F.when(hist, F.col("invoice_date"))).alias("first_order_date"),
        F.max(F.when(hist, F.col("invoice_date"))).alias("last_order_date"),
        F.sum(F.when(fut, F.col("revenue"))).alias("_future"),
        F.max("_cutoff").alias("_cutoff"),
    )
    return (agg.filter(F.col("_hist_lines") > 0).select(
        "customer_id", "total_orders",
        F.col("_rev").cast("double").alias("total_revenue"),
        (F.col("_rev").cast("double") / F.col("_n_hist")).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        F.datediff("_cutoff", "first_order_date").alias("days_since_first"),
        F.datediff("_cutoff", "last_order_date").alias("days_since_last"),
        F.coalesce(F.col("_future"), F.lit(0)).cast("double").alias("future_6M_revenue"),
    ))
