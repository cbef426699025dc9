"""Facts of the fixture view at sf0.01, as stated with the test data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise.operators import basket as B
from tillwise.operators import rfm as R
from tillwise.operators.clv_features import clv_features
from tillwise.plans.registry import cleaned

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def clean(spark):
    return cleaned(spark, SF).checkpoint(eager=True)


def test_lines_returns_anonymous_prices_dates(clean):
    f = clean.agg(F.count(F.lit(1)).alias("n"), F.sum("is_return").alias("ret"),
                  F.sum("is_anonymous").alias("anon"), F.count_if(F.col("price") < 0.1).alias("cheap"),
                  F.min("invoice_date").alias("lo"), F.max("invoice_date").alias("hi"),
                  F.countDistinct("customer_id").alias("cust")).first()
    assert (f.n, f.ret, f.anon, f.cheap) == (60000, 10009, 6038, 536)
    assert (f.lo, f.hi) == (dt.date(1995, 1, 1), dt.date(2001, 8, 1))
    assert f.cust == 1499


def test_segment_sizes(clean):
    seg = {r.segment: r.n for r in R.rfm_segment(R.rfm_raw(clean))
           .groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert seg == {"Growth Potential": 592, "High Value": 344, "Needs Attention": 317, "Lost": 246}


def test_clv_cutoff_and_customers(clean):
    f = clv_features(clean)
    assert f.count() == 1498
    # days_since_last = cutoff - last history date, and the cutoff is 2001-02-01
    r = f.select(F.date_add("last_order_date", F.col("days_since_last")).alias("c")).distinct().collect()
    assert [x.c for x in r] == [dt.date(2001, 2, 1)]


def test_rule_counts_by_threshold(clean):
    b = B.baskets(B.preprocess(clean)).checkpoint(eager=True)
    pairs = B.association_rules(B.frequent_itemsets(b, 0.01, max_len=2), 0.05)
    assert pairs.count() == 170
    assert B.association_rules(B.frequent_itemsets(b, 0.01), 0.2).count() == 0
    low = B.association_rules(B.frequent_itemsets(b, 0.001), 0.05)
    shapes = {(r.antecedent_len, r.consequent_len): r.n for r in
              low.groupBy("antecedent_len", "consequent_len").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(shapes.values()) == 2975
    assert shapes == {(1, 1): 170, (2, 1): 2798, (2, 2): 3, (3, 1): 4}
