"""The plan shapes the scale design relies on (checked on the physical plan)."""

from pyspark.sql import functions as F

from helpers import clean_frame, line
from tillwise.operators import basket as B
from tillwise.operators import cohort as H
from tillwise.operators import measures as X
from tillwise.operators import rfm as R
from tillwise.operators.clv_features import clv_features
from tillwise.operators.ranking import global_rank


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark):
    # customer 1 holds a third of all lines
    rows = [line(str(i), 1 if i % 3 == 0 else 1000 + i, "2011-0%d-01" % (1 + i % 9), 1 + i % 4)
            for i in range(300)]
    return clean_frame(spark, rows)


def test_distinct_count_is_two_level(spark):
    p = _plan(R.rfm_raw(_lines(spark)))
    assert "hashpartitioning(customer_id" in p and "invoice_number" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_cohort_and_clv_features_have_no_line_join(spark):
    for df in (H.cohort_activity(_lines(spark)), clv_features(_lines(spark))):
        p = _plan(df)
        assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p


def test_rank_uses_range_partitioning_not_one_partition(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(100)], "id bigint, v int")
    r = global_rank(df, [F.col("v"), F.col("id")], num_partitions=4, materialize_input=False)
    assert r.count() == 100
    scores = R.rfm_score(R.rfm_raw(_lines(spark)))
    assert "ntile" not in _plan(scores).lower()


def test_dedupe_and_mode_aggregate_without_windows(spark):
    d = X.dedupe(_lines(spark), ["invoice_number", "item_code"], ["quantity"])
    assert "Window" not in _plan(d)
    m = B.item_mode(_lines(spark))
    assert "Window" not in _plan(m)


def test_hot_customer_results_whole(spark):
    lines = _lines(spark)
    raw = {r.customer_id: r.frequency for r in R.rfm_raw(lines).collect()}
    assert raw[1] == 100 and len(raw) == 201
    act = H.cohort_activity(lines).agg(F.sum("active_customers")).first()[0]
    assert act == lines.select("customer_id", F.trunc("invoice_date", "month")).distinct().count()


def test_cluster_conf_scales_with_input():
    from tillwise.session import cluster_conf
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # floor: 2 x cores
    assert int(big["spark.sql.shuffle.partitions"]) == 102_400        # one a GB
    assert "spark.checkpoint.dir" not in big


def test_next_best_offer_has_no_item_arrays_and_a_partial_top_k(spark):
    lines = _lines(spark)
    rules = spark.createDataFrame(
        [(["A"], ["B"], 0.9, 2.0), (["A", "B"], ["C"], 0.5, 1.5)],
        "antecedents array<string>, consequents array<string>, confidence double, lift double")
    p = _plan(X.next_best_offer(lines, rules, 3))
    assert "collect_set" not in p and "array_contains" not in p
    assert "WindowGroupLimit" in p


def test_next_best_offer_hot_customer_gets_every_qualifying_rule(spark):
    # customer 1 holds a third of the lines and owns items A and B
    rows = [line(str(i), 1 if i % 3 == 0 else 1000 + i, "2011-01-01", 1,
                 item="A" if i % 2 else "B") for i in range(300)]
    rules = spark.createDataFrame(
        [(["A"], ["C"], 0.9, 2.0), (["B"], ["C", "D"], 0.8, 1.5), (["A"], ["B"], 0.7, 1.2),
         (["A", "B"], ["D"], 0.6, 1.1)],
        "antecedents array<string>, consequents array<string>, confidence double, lift double")
    got = [(r.offer_rank, r.antecedent_codes, r.consequent_codes)
           for r in X.next_best_offer(clean_frame(spark, rows), rules, 10)
           .filter("customer_id = 1").orderBy("offer_rank").collect()]
    # A -> B is excluded: the consequent is already owned
    assert got == [(1, "A", "C"), (2, "B", "C, D"), (3, "A, B", "D")]
