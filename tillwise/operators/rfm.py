"""Recency / frequency / monetary metrics, quartile scores and segments.

Semantics kept from the source on purpose:

* the reference date is ``max(invoice_date) + 1`` over *all* lines,
  anonymous ones included;
* monetary sums sales only, but last purchase and frequency count returns;
* all three scores order DESC, so ``r_score = 1`` are the *oldest*
  customers while ``f_score = 1`` / ``m_score = 1`` are the *best*;
* the segment CASE is evaluated in order (first match wins).

Ties in the NTILE order are broken by ``customer_id`` so scores repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import ntiles

# The segment labels, in the order the CASE tests them.
SEGMENTS = ["Lost", "Needs Attention", "High Value", "Growth Potential"]


def rfm_raw(cleaned: DataFrame) -> DataFrame:
    """customer_id, recency (days), frequency (distinct invoices), monetary (2 dp).

    The reference date is a scalar subquery over one column of all lines
    (its scan reads only ``invoice_date``); the per-customer aggregate reads
    known customers only, the anonymous filter reaching the scan.  The
    distinct count is planned as a two-level aggregate on (customer,
    invoice), so a customer with a third of all lines is spread over many
    tasks before the final, per-customer step.
    """
    ref_date = cleaned.agg(F.date_add(F.max("invoice_date"), 1)).scalar()
    base = (cleaned.filter(F.col("is_anonymous") == 0)
                   .groupBy("customer_id").agg(
                       F.max("invoice_date").alias("last_purchase"),
                       F.countDistinct("invoice_number").alias("frequency"),
                       F.sum(F.when(F.col("is_return") == 0, F.col("revenue")).otherwise(F.lit(0)))
                        .alias("monetary")))
    return base.select(
        "customer_id",
        F.datediff(ref_date, F.col("last_purchase")).alias("recency"),
        "frequency",
        F.round("monetary", 2).cast("double").alias("monetary"))


def rfm_score(raw: DataFrame, keep_metrics: bool = False,
              num_partitions: int | None = None) -> DataFrame:
    """Quartile scores 1..4 per metric, all ordered DESC (tie-break customer_id)."""
    # one global rank serves the three scores: the metrics are stacked once
    # per metric, range-shuffled and checkpointed once, and put back together
    # by a hash aggregate on the (unique) customer_id
    s = ntiles(raw.select("customer_id", "recency", "frequency", "monetary"), 4, "customer_id",
               ["recency", "frequency", "monetary"], ["r_score", "f_score", "m_score"],
               num_partitions)
    if keep_metrics:
        return s
    return s.select("customer_id", "r_score", "f_score", "m_score")


def segment_label(r, f, m):
    """The ordered CASE that maps (r, f, m) scores to a segment."""
    lost, attention, high, growth = SEGMENTS
    return (F.when((r == 1) & m.isin(3, 4), F.lit(lost))
             .when(((r == 1) & m.isin(1, 2)) | ((r == 2) & m.isin(3, 4)), F.lit(attention))
             .when(r.isin(3, 4) & m.isin(1, 2) & f.isin(1, 2), F.lit(high))
             .otherwise(F.lit(growth)))


def rfm_segment(raw: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Metrics, scores and segment per customer.

    The scores are computed on the metrics frame itself, so the source's
    LEFT JOIN of scores back to metrics (1:1 on customer_id) is not needed.
    """
    s = rfm_score(raw, keep_metrics=True, num_partitions=num_partitions)
    return s.select(
        "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        segment_label(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("segment"))
