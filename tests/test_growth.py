"""Growing tables, calendar frames, survival, campaign and star schema: small fixtures and plans."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import clean_frame, line, rows
from tillwise.operators import clean as C
from tillwise.operators import cohort as H
from tillwise.operators import measures as X
from tillwise.operators import rfm as R
from tillwise.operators import star as S
from tillwise.operators.clv_features import clv_features
from tillwise.sources.sinks import read_table, replace_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some_lines(spark, seed=0, n=300):
    rnd = random.Random(seed)
    day = lambda: dt.date(1993, 11, 3) + dt.timedelta(days=rnd.randint(0, 4200))
    made = [line(f"{rnd.choice(['', 'C'])}{i}", rnd.choice([None, *range(25)]), rnd.choice([None, day(), day(), day()])) for i in range(n)]
    return clean_frame(spark, made)


@pytest.mark.parametrize("parts", [1, 4])
def test_activity_from_bits_of_any_loads(spark, parts):
    df = some_lines(spark)
    loads = [df.filter(F.pmod(F.xxhash64("invoice_number"), F.lit(parts)) == k) for k in range(parts)]
    got = H.activity_from_bits(H.merge_month_bits(*[H.month_bits(x) for x in loads], H.month_bits(df.filter("false"))))
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(H.cohort_activity(df))))
    again = H.merge_month_bits(H.month_bits(df), H.month_bits(df))   # a load that came twice
    assert sorted(map(str, rows(H.activity_from_bits(again)))) == sorted(map(str, rows(got)))


def test_time_frames_are_calendar_months(spark):
    df = clean_frame(spark, [line("1", 1, "2020-01-05", price="1.00"), line("2", 1, "2020-02-05", price="2.00"),
                             line("3", 1, "2020-05-05", price="4.00"), line("4", 1, "2021-02-01", price="8.00"), line("5", 1, None)])
    got = [tuple(r) for r in X.time_intelligence(df).orderBy("month").collect()]
    d = dt.date
    assert got == [(d(2020, 1, 1), 1.0, 1.0, None, None), (d(2020, 2, 1), 2.0, 3.0, None, None), (d(2020, 5, 1), 4.0, 4.0, None, None),
                   (d(2021, 2, 1), 8.0, 8.0, 2.0, 3.0)]


def test_survival_by_hand(spark):
    df = clean_frame(spark, [line("1", 1, "2020-01-01"), line("2", 1, "2020-01-01"), line("3", 1, "2020-02-15"), line("4", 2, "2020-03-01"), line("5", None, "2020-06-30")])
    seg = spark.createDataFrame([(1, "a"), (2, "a")], "customer_id bigint, segment string")
    # gaps: 45 days (came back), 136 days and 121 days (censored)
    got = [tuple(r) for r in X.return_survival(df, seg).orderBy("month").collect()]
    assert got == [("a", 1, 3, 1, 1 / 3, pytest.approx(2 / 3)), ("a", 4, 2, 0, 0.0, pytest.approx(2 / 3))]


def test_campaign_by_hand(spark):
    df = clean_frame(spark, [line("1", 1, "2020-01-01", item="A"), line("2", 2, "2020-01-01", item="B"), line("3", 2, "2020-01-31", item="A"),
                             line("4", 3, "2020-01-02", item="A"), line("5", 3, "2020-02-02", item="B"), line("6", 4, "2020-02-20", item="A"), line("C7", 1, "2020-01-15")])
    rules = spark.createDataFrame([(["A"], ["B"], 0.5, 1.5)], "antecedents array<string>, consequents array<string>, confidence double, lift double")
    got = X.campaign_audience(df, rules)
    # customer 2 came back on day 30, customer 3 the day after (and bought the offer only then), customer 4's day has not come
    assert rows(got.select("customer_id", "campaign_day", "consequent_codes")) == [(1, dt.date(2020, 1, 31), "B"), (3, dt.date(2020, 2, 1), "B")]
    assert "Cartesian" not in plan(got) and "NestedLoop" not in plan(got)
    assert [tuple(r) for r in X.audience_by_day(got).orderBy("campaign_day").collect()] == [(dt.date(2020, 1, 31), 1, 1), (dt.date(2020, 2, 1), 1, 1)]


def test_sketches_of_loads_equal_one_pass(spark):
    df = spark.range(60_000).selectExpr("id % 40000 AS customer_id", "CAST(id % 3000 AS string) AS item_code", "CAST(id % 7 AS string) AS country",
                                        "date_add(DATE'2020-01-01', CAST(id % 100 AS int)) AS invoice_date")
    whole = C.profile_of_sketches(C.profile_sketch(df, "all")).first()
    loads = [C.profile_sketch(df.filter(F.pmod(F.xxhash64("customer_id", "item_code"), F.lit(5)) == k), str(k)) for k in range(5)]
    united = C.profile_of_sketches(loads[0].union(loads[1]).union(loads[2]).union(loads[3]).union(loads[4])).first()
    assert united["row_count"] == whole["row_count"] == 60_000
    for c, exact in (("customers", 40_000), ("items", 3_000), ("countries", 7)):
        assert abs(united[c] - exact) <= 0.03 * exact and abs(whole[c] - exact) <= 0.03 * exact
        assert abs(united[c] - whole[c]) <= 0.01 * exact
    empty = C.profile_of_sketches(C.profile_sketch(df.filter("false"), "none").union(loads[0])).first()
    assert empty["row_count"] == loads[0].first()["row_count"]


def test_a_window_reads_its_months_only(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tillwise-month-"), "clean")
    df = some_lines(spark, 3)
    replace_table(C.with_month(df), path=path, partition_by=["invoice_month"])
    stored = read_table(spark, path)
    got = clv_features(stored, "1996-01-01", "1996-06-30")
    assert "PartitionFilters: [isnotnull(invoice_month" in plan(got) and "invoice_month#" in plan(got)
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(clv_features(df, "1996-01-01", "1996-06-30"))))
    assert stored.count() == df.count()


def test_star_joins_without_moving_the_fact(spark):
    df = some_lines(spark, 5)
    folder = tempfile.mkdtemp(prefix="tillwise-star-")
    seg = R.rfm_segment(R.rfm_raw(df))
    quintiles = spark.createDataFrame([(1, 5.0, 1), (2, 3.0, 2)], "customer_id bigint, clv_prediction double, clv_quintile int")
    star = S.write_star(spark, df, seg, quintiles, f"star_test_{os.getpid()}", folder, buckets=4)
    keys = [r["customer_key"] for r in star.customers.orderBy("customer_id").collect()]
    assert keys == list(range(len(keys))) and star.fact.count() == df.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.fact.join(star.customers, "customer_key", "left")
        assert "Exchange" not in plan(joined)
        assert joined.filter("customer_id IS NULL").count() == df.filter("customer_id IS NULL").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert star.customers.filter("clv_quintile IS NOT NULL").count() == 2
