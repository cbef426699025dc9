"""Business measures named by the dashboard narrative (definitions are ours).

Every measure is a small aggregate or window over the operator outputs.
Money stays decimal until the final cast, so sums do not depend on row
order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .basket import mode_by
from .ranking import exact_quantiles

_MONEY = "decimal(20,2)"


def _money(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(_MONEY)


def opportunity_gap(segments: DataFrame, target: str = "Growth Potential",
                    peer: str = "High Value") -> DataFrame:
    """R1. Revenue to gain if every ``target`` customer spent like the average
    ``peer`` customer: sum over target customers of max(0, peer mean - own).

    Computed as n_below * mean - sum(own below), so the sum is exact.
    """
    peer_mean = (segments.filter(F.col("segment") == peer)
                 .agg(F.sum(_money("monetary")).cast("double") / F.count(F.lit(1))).scalar())
    t = segments.filter(F.col("segment") == target)
    below = F.col("monetary") < peer_mean
    return t.agg(
        F.count(F.lit(1)).alias("target_customers"),
        F.count_if(below).alias("under_monetised"),
        F.sum(F.when(below, _money("monetary"))).alias("_s")).select(
        "target_customers", "under_monetised", peer_mean.alias("peer_mean_monetary"),
        F.coalesce(F.col("under_monetised") * peer_mean - F.col("_s").cast("double"),
                   F.lit(0.0)).alias("opportunity_gap"))


def revenue_at_risk(segments: DataFrame, segment: str = "Needs Attention") -> DataFrame:
    """R2. Customers and their total monetary value in the at-risk segment."""
    return (segments.filter(F.col("segment") == segment)
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.coalesce(F.sum(_money("monetary")), F.lit(0).cast(_MONEY))
                  .cast("double").alias("revenue_at_risk")))


def return_survival(cleaned: DataFrame, segments: DataFrame, days_a_month: int = 30) -> DataFrame:
    """R2. Churn risk: by segment and month since a purchase, the product-limit estimate of not having come back.

    Each purchase day of a customer starts a gap.  It ends at the next purchase day, or is
    censored at the last day of all lines.  ``at_risk`` gaps have lasted that many months
    of 30 days, ``returned`` of them end in it; ``hazard`` is their share and
    ``not_returned`` the product of (1 - hazard) up to and including the month.
    The window by customer holds purchase days, so a customer with a third of
    the lines has as many rows as days; the other windows run over months.
    """
    last = cleaned.agg(F.max("invoice_date")).scalar()
    days = (cleaned.filter((F.col("is_anonymous") == 0) & (F.col("is_return") == 0) & F.col("invoice_date").isNotNull())
                   .select("customer_id", "invoice_date").distinct())
    following = F.lead("invoice_date").over(Window.partitionBy("customer_id").orderBy("invoice_date"))
    gaps = days.withColumn("_next", following).withColumn("_last", last)
    month = F.floor(F.datediff(F.coalesce("_next", "_last"), "invoice_date") / days_a_month).cast("int")
    per_month = (gaps.join(segments.select("customer_id", "segment"), "customer_id")
                     .groupBy("segment", month.alias("month"))
                     .agg(F.count(F.lit(1)).alias("_ended"), F.count("_next").alias("returned")))
    later = Window.partitionBy("segment").orderBy(F.col("month").desc()).rowsBetween(Window.unboundedPreceding, 0)
    risk = per_month.withColumn("at_risk", F.sum("_ended").over(later)).withColumn("hazard", F.col("returned") / F.col("at_risk"))
    up = Window.partitionBy("segment").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    kept = F.collect_list(1 - F.col("hazard")).over(up)   # as many as months
    return risk.select("segment", "month", "at_risk", "returned", "hazard",
                       F.aggregate(kept, F.lit(1.0), lambda p, x: p * x).alias("not_returned"))


def customer_items(cleaned: DataFrame) -> DataFrame:
    """Distinct (customer_id, item_code) a known customer has bought."""
    return (cleaned.filter((F.col("is_anonymous") == 0) & (F.col("is_return") == 0)
                           & (F.col("quantity") > 0) & F.col("item_code").isNotNull())
                   .select("customer_id", "item_code").distinct())


def next_best_offer(cleaned: DataFrame, rules: DataFrame, k: int = 3) -> DataFrame:
    """R3. Per customer, the k best rules whose antecedent the customer has
    fully bought and whose consequent is not yet fully bought (by confidence,
    then lift, then codes).

    All relational, no per-customer item arrays:

    * candidates come from an equi-join of owned (customer, item) pairs with the antecedent
      item that the fewest customers own, so each (customer, rule) pair is
      produced once and a popular item does not draw all its owners;
    * a candidate carries its rule, so its items are exploded in place and
      left-joined to the owned pairs on (customer, item); a count of matches
      per side is the subset test;
    * the top-k is a ``row_number`` filter, which Spark plans with a partial
      per-partition limit before the shuffle (``WindowGroupLimit``), so a
      customer with many candidates never sends more than k rows per map
      task to the final window.

    The owned pairs are written once (a checkpoint) and read by every join.
    """
    ensure_checkpoint_dir(cleaned.sparkSession)
    owned = customer_items(cleaned).checkpoint(eager=True)
    owners = owned.groupBy("item_code").agg(F.count(F.lit(1)).alias("_owners"))
    # a rule is identified by its two sorted item arrays (exact even if a
    # code contained the ", " separator of the printed codes)
    rule_key = ["antecedents", "consequents"]
    rarest = (rules.select(*rule_key, "confidence", "lift", F.explode("antecedents").alias("item_code"))
                   .join(owners, "item_code")
                   .groupBy(*rule_key, "confidence", "lift")
                   .agg(F.min(F.struct("_owners", "item_code"))["item_code"].alias("item_code")))
    cand = owned.join(rarest, "item_code").drop("item_code")
    side = lambda arr, a: F.transform(arr, lambda x: F.struct(x.alias("item_code"),
                                                             F.lit(a).alias("in_a")))
    members = cand.select("customer_id", *rule_key, "confidence", "lift",
                          F.explode(F.concat(side("antecedents", True), side("consequents", False))).alias("_m"))
    hits = (members.select("customer_id", *rule_key, "confidence", "lift", "_m.item_code", "_m.in_a")
                   .join(owned.withColumn("_own", F.lit(True)), ["customer_id", "item_code"], "left"))
    owned_a = F.count_if(F.col("in_a") & F.col("_own").isNotNull())
    owned_c = F.count_if(~F.col("in_a") & F.col("_own").isNotNull())
    tested = (hits.groupBy("customer_id", *rule_key, "confidence", "lift")
                  .agg(owned_a.alias("_ha"), owned_c.alias("_hc"))
                  .filter((F.col("_ha") == F.size("antecedents")) & (F.col("_hc") < F.size("consequents")))
                  .select("customer_id", "confidence", "lift",
                          F.array_join("antecedents", ", ").alias("antecedent_codes"),
                          F.array_join("consequents", ", ").alias("consequent_codes")))
    w = Window.partitionBy("customer_id").orderBy(
        F.col("confidence").desc(), F.col("lift").desc(), "antecedent_codes", "consequent_codes")
    return (tested.withColumn("offer_rank", F.row_number().over(w))
                  .filter(F.col("offer_rank") <= k)
                  .select("customer_id", "offer_rank", "antecedent_codes", "consequent_codes",
                          "confidence", "lift"))


def retention_cliff(retention: DataFrame) -> DataFrame:
    """R4. Per cohort: the step between successive months with the largest
    drop in retention rate (ties: the earliest).

    A month without activity inside the span of all months is a rate of zero, so
    a fall to zero is a step like any other; months after the last one any
    cohort reaches have not happened and are no step.  A cohort without a
    size (no member bought in its first month) has no rates and no cliff.
    """
    sized = retention.filter(F.col("cohort_size").isNotNull() & F.col("index").isNotNull())
    last = sized.agg(F.max(F.expr("add_months(cohort_month, CAST(index AS INT))"))).scalar()
    spine = sized.groupBy("cohort_month").agg(F.first("cohort_size").alias("cohort_size")).select(
        "cohort_month", F.explode(F.sequence(
            F.lit(0), F.round(F.months_between(last, F.col("cohort_month"))).cast("int"))).alias("index")).withColumn(
        "index", F.col("index").cast("double"))
    filled = spine.join(sized.select("cohort_month", "index", "retention_rate"), ["cohort_month", "index"], "left") \
                  .withColumn("retention_rate", F.coalesce("retention_rate", F.lit(0.0)))
    by_cohort = Window.partitionBy("cohort_month").orderBy("index")
    steps = (filled.withColumn("prev_rate", F.lag("retention_rate").over(by_cohort))
                   .withColumn("drop", F.col("prev_rate") - F.col("retention_rate"))
                   .filter(F.col("drop").isNotNull()))
    best = Window.partitionBy("cohort_month").orderBy(F.col("drop").desc(), F.col("index").asc())
    return (steps.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") == 1)
                 .select("cohort_month", F.col("index").alias("cliff_index"),
                         "prev_rate", "retention_rate", "drop"))


def reengagement_audience(raw_rfm: DataFrame, min_days: int = 30) -> DataFrame:
    """R5. One-invoice customers whose purchase is at least ``min_days`` old."""
    return (raw_rfm.filter((F.col("frequency") == 1) & (F.col("recency") >= min_days))
                   .select("customer_id", "recency", "monetary"))


def campaign_audience(cleaned: DataFrame, rules: DataFrame, days: int = 30) -> DataFrame:
    """R5 with R3. The day-30 campaign of every calendar day: customer_id, campaign_day, and the best offer.

    A customer is written to ``days`` days after the first purchase, unless a second purchase day came
    before; campaign days after the last day of the lines have not come yet.  The
    offer is the best rule for what the customer had bought by that day (null if no rule fits):
    lines and audience are joined on the customer with the day as a range, so no
    calendar is crossed with customers.
    """
    ensure_checkpoint_dir(cleaned.sparkSession)
    bought = cleaned.filter((F.col("is_anonymous") == 0) & (F.col("is_return") == 0) & F.col("invoice_date").isNotNull())
    first_two = bought.groupBy("customer_id").agg(F.slice(F.array_sort(F.collect_set("invoice_date")), 1, 2).alias("_days"))
    day = F.date_add(F.element_at("_days", 1), days)
    audience = (first_two.select("customer_id", day.alias("campaign_day"), F.get("_days", F.lit(1)).alias("_second"))
                         .filter(F.col("_second").isNull() | (F.col("_second") > F.col("campaign_day")))
                         .filter(F.col("campaign_day") <= cleaned.agg(F.max("invoice_date")).scalar())
                         .select("customer_id", "campaign_day").checkpoint(eager=True))
    held = cleaned.join(audience, "customer_id").filter(F.col("invoice_date") <= F.col("campaign_day")).drop("campaign_day")
    best = next_best_offer(held, rules, k=1).drop("offer_rank")
    return audience.join(best, "customer_id", "left")


def audience_by_day(audience: DataFrame) -> DataFrame:
    """campaign_day, customers, with_offer: every calendar day from the first campaign to the last, empty days included."""
    counts = audience.groupBy("campaign_day").agg(F.count(F.lit(1)).alias("n"), F.count("consequent_codes").alias("o"))
    spine = counts.agg(F.min("campaign_day").alias("a"), F.max("campaign_day").alias("b")).filter("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b")).alias("campaign_day"))
    zero = F.lit(0).cast("bigint")
    return spine.join(counts, "campaign_day", "left").select("campaign_day", F.coalesce("n", zero).alias("customers"), F.coalesce("o", zero).alias("with_offer"))


def time_intelligence(cleaned: DataFrame, months: int = 3) -> DataFrame:
    """R6. Revenue by month with the rolling sum of ``months`` calendar months and the same month of the year before.

    The frames are ranges of month numbers, not of rows: a month without lines has no row and
    still counts as a month, so the sum never reaches further back and the year before is
    null if that month had no lines.  They run over the small table of months.
    """
    m = (cleaned.filter(F.col("invoice_date").isNotNull())
                .groupBy(F.trunc("invoice_date", "month").alias("month"))
                .agg(F.sum("revenue").cast(_MONEY).alias("_rev"))
                .withColumn("_n", F.year("month") * 12 + F.month("month")))
    by_number = Window.orderBy("_n")
    rolling = F.sum("_rev").over(by_number.rangeBetween(1 - months, 0))
    before = F.sum("_rev").over(by_number.rangeBetween(-12, -12))
    return m.select("month", F.col("_rev").cast("double").alias("revenue"), rolling.cast("double").alias("rolling_revenue"),
                    before.cast("double").alias("year_before"),
                    F.try_divide((F.col("_rev") - before).cast("double"), before.cast("double")).alias("yoy_pct"))


def monthly_revenue(cleaned: DataFrame) -> DataFrame:
    """R6. Net revenue by month, change on the previous month, year-to-date.

    Every calendar month between the first and the last is there; one without
    lines has revenue zero, so the previous month is always the month before.
    The two windows run over that small table only.
    """
    m = (cleaned.filter(F.col("invoice_date").isNotNull())
                .groupBy(F.trunc("invoice_date", "month").alias("month"))
                .agg(F.sum("revenue").cast(_MONEY).alias("_rev")))
    spine = m.agg(F.min("month").alias("a"), F.max("month").alias("b")).filter("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    m = spine.join(m, "month", "left").select("month", F.coalesce("_rev", F.lit(0).cast(_MONEY)).alias("_rev"))
    prev = F.lag("_rev").over(Window.orderBy("month"))
    ytd = F.sum("_rev").over(Window.partitionBy(F.year("month")).orderBy("month")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return m.select(
        "month", F.col("_rev").cast("double").alias("revenue"),
        (F.col("_rev") - prev).cast("double").alias("mom_change"),
        F.try_divide((F.col("_rev") - prev).cast("double"), prev.cast("double")).alias("mom_pct"),
        ytd.cast("double").alias("ytd_revenue"))


def customer_dim_unique(cleaned: DataFrame) -> DataFrame:
    """R7. One row per known customer: the most frequent country (ties: smallest; null if there is none)."""
    return mode_by(cleaned.filter(F.col("is_anonymous") == 0), "customer_id", "country")


def product_dim_unique(cleaned: DataFrame) -> DataFrame:
    """R7. One row per item over plausible lines: the most frequent description."""
    plausible = cleaned.filter((F.col("quantity") > 0) & (F.col("price") >= F.lit(0.1)))
    return mode_by(plausible, "item_code", "item_description")


def sales_fact(cleaned: DataFrame) -> DataFrame:
    """R7. The star schema's fact table: every line with the one country of its
    customer and the one description of its item.

    Lines without a known customer or a plausible item keep null there.  Left
    joins, so no line is lost; a customer or an item that holds a large share
    of the lines is left to AQE's skew join (the dimension side is unique).
    """
    customers = customer_dim_unique(cleaned).withColumnRenamed("country", "customer_country")
    products = product_dim_unique(cleaned).withColumnRenamed("item_description", "product_description")
    return (cleaned.select("invoice_number", "invoice_date", "item_code", "customer_id", "quantity",
                           "price", "revenue", "is_return")
                   .join(customers, "customer_id", "left").join(products, "item_code", "left"))


def drop_revenue_outliers(cleaned: DataFrame, q: float = 0.99) -> DataFrame:
    """R8. Sales lines with revenue at most the exact q-quantile of sales-line revenue."""
    sales = cleaned.filter(F.col("quantity") > 0)
    # the three passes read one pruned column of the input; a copy on executor disks would cost more
    bound = exact_quantiles(sales, "revenue", [q], ["b"], materialize_input=False).scalar()
    return sales.filter(F.col("revenue").cast("double") <= bound)


def dedupe(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """R9. One row per key: the smallest by ``order`` (then by all other columns).

    ``min`` of a struct is an ordinary aggregate with map-side partial
    aggregation, so a key holding a third of the rows is reduced before
    the shuffle (a ``row_number`` window would send it to one task).
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(*key).agg(F.min(packed).alias("_row"))
              .select(*key, *[F.col(f"_row.{c}").alias(c) for c in order + rest])
              .select(*df.columns))


def clv_funnel(quintiles: DataFrame, segments: DataFrame) -> DataFrame:
    """R10. Customers and predicted value by CLV quintile x RFM segment."""
    j = quintiles.join(segments.select("customer_id", "segment"), "customer_id")
    return j.groupBy("clv_quintile", "segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(_money("clv_prediction")).cast("double").alias("predicted_value"))
