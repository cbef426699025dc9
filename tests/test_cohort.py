import datetime as dt

from helpers import clean_frame, line
from tillwise.operators import cohort as H

JAN = dt.datetime(2011, 1, 1)
FEB = dt.datetime(2011, 2, 1)
MAR = dt.datetime(2011, 3, 1)


def test_cohort_without_index_zero(spark):
    lines = [line("C1", 1, "2011-01-10", -1), line("2", 1, "2011-02-03", 1),
             line("C3", 2, "2011-03-05", -1), line("4", None, "2010-12-01", 1)]
    c = clean_frame(spark, lines)
    cohorts = {r.customer_id: r.cohort_month for r in H.cohort(c).collect()}
    assert cohorts == {1: JAN, 2: MAR, None: dt.datetime(2010, 12, 1)}  # the null group stays
    act = H.cohort_activity(c)
    assert [(r.cohort_month, r["index"], r.active_customers) for r in act.collect()] == [(JAN, 1.0, 1)]
    ret = H.cohort_retention(act).first()
    assert ret.cohort_size is None and ret.retention_rate is None


def test_cohort_rate_above_one(spark):
    lines = [line("1", 1, "2011-01-10"), line("2", 1, "2011-02-10"),
             line("C3", 2, "2011-01-15", -1), line("4", 2, "2011-02-20")]
    act = H.cohort_activity(clean_frame(spark, lines))
    ret = {r["index"]: (r.active_customers, r.cohort_size, r.retention_rate)
           for r in H.cohort_retention(act).collect()}
    assert ret == {0.0: (1, 1, 1.0), 1.0: (2, 1, 2.0)}


def test_activity_counts_distinct_customers(spark):
    lines = [line(str(i), 1 + i % 2, "2011-01-0%d" % (1 + i % 9)) for i in range(20)]
    act = H.cohort_activity(clean_frame(spark, lines)).collect()
    assert [(r["index"], r.active_customers) for r in act] == [(0.0, 2)]
