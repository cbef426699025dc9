import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import clean_frame, line
from tillwise.operators import clv_model as M
from tillwise.operators.clv_features import clv_features


def test_clv_window_bounds(spark):
    lines = [line("1", 1, "2011-06-08", 1, "2.00"),   # cutoff - 1: history
             line("2", 1, "2011-06-09", 1, "3.00"),   # cutoff: future
             line("3", 1, "2011-12-09", 1, "5.00"),   # end: future (closed)
             line("4", 1, "2011-12-10", 1, "7.00"),   # end + 1: neither
             line("5", 2, "2011-07-01", 1, "9.00"),   # after the cutoff only: no row
             line("C6", 1, "2011-01-01", -1, "4.00")]  # return: ignored
    f = clv_features(clean_frame(spark, lines), cutoff="2011-06-09", end="2011-12-09").collect()
    assert len(f) == 1
    r = f[0]
    assert (r.customer_id, r.total_orders, r.total_revenue, r.avg_order_value) == (1, 1, 2.0, 2.0)
    assert (r.days_since_first, r.days_since_last, r.future_6M_revenue) == (1, 1, 8.0)


def test_clv_default_window(spark):
    lines = [line("1", 1, "2011-01-15", 1, "2.00"), line("2", 1, "2011-08-01", 1, "3.00"),
             line("3", 2, "2011-02-02", 2, "1.50")]
    f = {r.customer_id: r for r in clv_features(clean_frame(spark, lines)).collect()}
    # end = 2011-08-01, cutoff = 2011-02-01
    assert set(f) == {1} and f[1].future_6M_revenue == 3.0 and f[1].days_since_last == 17


def _prep_input(spark):
    rows = [("1", "2", "10.0", "5.0", "30", "3", "100.0"),
            ("2", "abc", "20.0", "10.0", "40", "4", "200.0"),   # unparsable feature
            ("3", "4", "30.0", "7.5", "50", "5", None),        # null target: dropped
            ("4", "6", "40.0", "6.6", "60", "6", "5000.0"),    # outlier
            ("5", "8", None, "4.0", "70", "7", "50.0")]
    return spark.createDataFrame(
        rows, "Customer_ID string, TOTAL_ORDERS string, total_revenue string, Avg_Order_Value string, "
              "days_since_first string, DAYS_SINCE_LAST string, future_6m_REVENUE string")


def test_prepare_mapping_impute_clip(spark):
    p = M.prepare(_prep_input(spark)).orderBy("CustomerID").toPandas()
    assert list(p.columns) == ["CustomerID", *M.FEATURES, "future_6m_revenue", "future_6m_revenue_raw"]
    assert list(p.CustomerID) == ["1", "2", "4", "5"]
    # medians over the remaining rows, as pandas computes them
    assert p.hist_orders.tolist() == [2.0, float(np.median([2, 6, 8])), 6.0, 8.0]
    assert p.hist_revenue.tolist()[3] == float(np.median([10.0, 20.0, 40.0]))
    q99 = pd.Series([100.0, 200.0, 5000.0, 50.0]).quantile(0.99)
    assert p.future_6m_revenue.tolist()[2] == pytest.approx(q99, rel=1e-12)
    assert p.future_6m_revenue_raw.tolist()[2] == 5000.0


def test_prepare_missing_columns(spark):
    with pytest.raises(ValueError, match="lacks the columns"):
        M.prepare(spark.createDataFrame([(1,)], "customer_id int"))


def test_split_exact_size_and_repeatable(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 103)], "CustomerID long, x double")
    s1 = M.train_test_split(df, 0.2, 42)
    tests = sorted(r.CustomerID for r in s1.filter("is_test").collect())
    assert len(tests) == math.ceil(0.2 * 102)
    s2 = M.train_test_split(df.repartition(5), 0.2, 42)
    assert sorted(r.CustomerID for r in s2.filter("is_test").collect()) == tests
    assert sorted(r.CustomerID for r in M.train_test_split(df, 0.2, 7).filter("is_test").collect()) != tests
    with pytest.raises(ValueError):
        M.train_test_split(df, 1.0)


def test_param_sampling_and_mapping():
    a = M.sample_param_sets(20, 42)
    assert a == M.sample_param_sets(20, 42) and len({tuple(sorted(p.items())) for p in a}) == 20
    g = M.gbt_params({"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1,
                      "min_samples_leaf": 1, "min_samples_split": 10, "subsample": 0.8})
    assert g == {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "minInstancesPerNode": 5,
                 "subsamplingRate": 0.8}


def test_regression_metrics(spark):
    y = np.array([1.0, 2.0, 3.0, 10.0])
    p = np.array([1.5, 2.0, 2.0, 8.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    m = M.regression_metrics(df, "y", "p").first()
    assert m.rmse == pytest.approx(math.sqrt(np.mean((y - p) ** 2)))
    assert m.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert m.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_small_pipeline_runs_and_beats_nothing_silly(spark):
    rng = np.random.default_rng(0)
    n = 120
    x = rng.uniform(0, 100, n)
    rows = [(i, float(i % 5 + 1), float(x[i]), float(x[i] / 3), float(100 + i), float(i % 30),
             float(2 * x[i] + rng.normal(0, 1))) for i in range(n)]
    feats = spark.createDataFrame(rows, "customer_id long, total_orders double, total_revenue double, "
                                        "avg_order_value double, days_since_first double, "
                                        "days_since_last double, future_6M_revenue double")
    space = {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.1], "min_samples_leaf": [1],
             "min_samples_split": [2], "subsample": [1.0]}
    res = M.clv_pipeline(feats, n_iter=1, space=space, parallelism=1)
    assert res.predictions.count() == n
    q = res.segments.groupBy("clv_quintile").count().collect()
    assert sorted(r["count"] for r in q) == [24] * 5
    assert res.test_metrics.first().r2 > 0.5
    assert res.search.table.count() == 1


def test_preparation_report_and_describe(spark):
    rep = M.preparation_report(_prep_input(spark)).first()
    assert (rep.rows_read, rep.rows_dropped, rep.null_hist_orders, rep.null_hist_revenue) == (5, 1, 1, 1)
    assert rep.clipped_targets == 1
    assert rep.clip_bound == pytest.approx(pd.Series([100.0, 200.0, 5000.0, 50.0]).quantile(0.99))
    y = pd.Series([1.0, 2.0, 3.0, 10.0])
    df = spark.createDataFrame([(v,) for v in y], "y double")
    d = M.describe(df, "y").first()
    assert (d.mean, d.std, d.min, d.max) == (round(y.mean(), 2), round(y.std(), 2), 1.0, 10.0)
    assert M.describe(df, "y", population=True).first().std == round(float(np.std(y.values)), 2)


def test_prepare_approximate_quantiles(spark):
    exact = M.prepare(_prep_input(spark)).orderBy("CustomerID").toPandas()
    approx = M.prepare(_prep_input(spark), approx_accuracy=10000).orderBy("CustomerID").toPandas()
    # a sketch returns an observed value, not an interpolation: the median of
    # three values agrees; the 0.99 bound of four values is the largest one
    assert approx.hist_orders.tolist() == exact.hist_orders.tolist()
    assert approx.future_6m_revenue.tolist()[2] == 5000.0 > exact.future_6m_revenue.tolist()[2]
    assert approx.future_6m_revenue_raw.tolist() == exact.future_6m_revenue_raw.tolist()


def test_r2_far_from_zero(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    y = 1e9 + rng.normal(size=1000) * 1e3
    p = y + rng.normal(size=1000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    want = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert abs(M.regression_metrics(df, "y", "p").first()["r2"] - want) < 1e-9


def test_model_does_not_follow_the_partitions(spark):
    rows = [(i, float(i % 7), float(i * 3 % 101), float(i % 13), float(i % 29), float(i % 31), float(i * 7 % 97)) for i in range(300)]
    df = spark.createDataFrame(rows, ["CustomerID", *M.FEATURES, M.TARGET])
    point = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1, "min_samples_leaf": 1, "min_samples_split": 2, "subsample": 0.8}
    got = [sorted((r["CustomerID"], r["prediction"]) for r in M.fit(frame, point).transform(df).collect())
           for frame in (df.repartition(1), df.repartition(13))]
    assert got[0] == got[1]


def _search_rows(spark, n=240):
    rows = [(i, float(i % 7), float(i * 3 % 101), float(i % 13), float(i % 29), float(i % 31), float((i * 7 % 97) + 50 * (i % 7 > 3))) for i in range(n)]
    return spark.createDataFrame(rows, ["CustomerID", *M.FEATURES, M.TARGET])


LEDGER_SPACE = {"n_estimators": [1, 2], "max_depth": [1, 2], "learning_rate": [0.1], "min_samples_leaf": [1],
                "min_samples_split": [2], "subsample": [1.0]}


def test_a_search_that_was_broken_off_goes_on(spark, tmp_path, monkeypatch):
    df, ledger = _search_rows(spark), str(tmp_path / "ledger")
    whole = M.random_search(df, 4, 3, space=LEDGER_SPACE, ledger=str(tmp_path / "other"), parallelism=1)
    assert whole.trials == 12
    plain, calls = M.fit, []

    def dies(*args, **kwargs):
        calls.append(1)
        if len(calls) == 6:
            raise RuntimeError("lost")
        return plain(*args, **kwargs)

    monkeypatch.setattr(M, "fit", dies)
    with pytest.raises(RuntimeError):
        M.random_search(df, 4, 3, space=LEDGER_SPACE, ledger=ledger, parallelism=1)
    monkeypatch.setattr(M, "fit", plain)
    again = M.random_search(df.repartition(5), 4, 3, space=LEDGER_SPACE, ledger=ledger, parallelism=2)
    finished = 12 - again.trials
    assert 5 <= finished < 12   # trials before the loss (and any that ran on while it was noticed)
    assert sorted(again.table.collect()) == sorted(whole.table.collect())
    assert (again.best_params, again.best_cv_rmse) == (whole.best_params, whole.best_cv_rmse)
    assert M.random_search(df, 4, 3, space=LEDGER_SPACE, ledger=ledger).trials == 0
    # a wider search shares the trials; other rows or seeds do not
    assert M.random_search(df, 2, 3, space={**LEDGER_SPACE, "n_estimators": [1]}, ledger=ledger).trials == 0
    assert M.random_search(df.filter("CustomerID > 5"), 1, 3, space=LEDGER_SPACE, ledger=ledger).trials == 3
    assert M.random_search(df, 1, 3, seed=7, space=LEDGER_SPACE, ledger=ledger).trials == 3


def test_search_equals_cross_validation_by_hand(spark, tmp_path):
    df = _search_rows(spark)
    found = M.random_search(df, 2, 3, space=LEDGER_SPACE, ledger=str(tmp_path / "l"))
    folds = df.withColumn("_fold", F.pmod(F.xxhash64(F.lit(43), "CustomerID"), F.lit(3)))
    for r in found.table.collect():
        params = {k: r[k] for k in M.PARAM_SPACE}
        errors = []
        for k in range(3):
            model = M.fit(folds.filter(F.col("_fold") != k), params)
            own = model.transform(folds.filter(F.col("_fold") == k)).toPandas()
            errors.append(((own.prediction - own[M.TARGET]) ** 2).mean())
        assert r["cv_mse"] == pytest.approx(np.mean(errors)) and r["cv_rmse"] == pytest.approx(math.sqrt(np.mean(errors)))
    assert found.best_cv_rmse == min(r["cv_rmse"] for r in found.table.collect())
