import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwise.operators.ranking import exact_quantiles, global_rank, ntile, ntiles


def _builtin(df, k):
    w = Window.orderBy(F.col("v").desc(), F.col("id").asc())
    return {r.id: r.b for r in df.select("id", F.ntile(k).over(w).alias("b")).collect()}


def _ours(df, k, parts):
    out = ntile(df, k, [F.col("v").desc(), F.col("id").asc()], "b", num_partitions=parts)
    return {r.id: r.b for r in out.select("id", "b").collect()}


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 9, 1001])
def test_ntile_matches_builtin_with_ties(spark, n):
    df = spark.createDataFrame([(i, i % 3) for i in range(n)], "id bigint, v int")
    for parts in (1, 3, 7):
        assert _ours(df, 4, parts) == _builtin(df, 4)


def test_ntile_bucket_sizes_differ_by_at_most_one(spark):
    df = spark.createDataFrame([(i, 0) for i in range(103)], "id bigint, v int")
    sizes = [r.c for r in ntile(df, 5, [F.col("v"), F.col("id")], "b", 4)
             .groupBy("b").agg(F.count("*").alias("c")).collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 103


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=0, max_size=60), st.integers(1, 7))
def test_ntile_property(spark, values, k):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, v int")
    assert _ours(df, k, 3) == _builtin(df, k)


def test_global_rank_is_a_permutation(spark):
    df = spark.createDataFrame([(i, (i * 7919) % 13) for i in range(500)], "id bigint, v int")
    r = global_rank(df, [F.col("v"), F.col("id")], num_partitions=6).collect()
    ranks = sorted(x._rank for x in r)
    assert ranks == list(range(500)) and {x._n for x in r} == {500}
    by_rank = [x for x in sorted(r, key=lambda x: x._rank)]
    keys = [(x.v, x.id) for x in by_rank]
    assert keys == sorted(keys)


@pytest.mark.parametrize("vals", [[1, 2, 3, 10], [5], [3, 3, 3, 1], list(range(37)), [2.5, -1.0, 7.25]])
def test_exact_quantiles_linear(spark, vals):
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    row = exact_quantiles(df, "x", probs, num_partitions=3).first()
    for i, p in enumerate(probs):
        assert row[i] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12)


def test_exact_quantiles_empty(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]).first()[0] is None


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=80),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, vals, probs):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    row = exact_quantiles(df, "x", probs, num_partitions=5).first()
    for i, p in enumerate(probs):
        assert row[i] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-9, abs=1e-6)


def test_ntile_with_null_keys_matches_builtin(spark):
    rows = [(i, None if i % 4 == 0 else i % 5) for i in range(37)]
    df = spark.createDataFrame(rows, "id bigint, v int")
    assert _ours(df, 4, 3) == _builtin(df, 4)


def test_band_quantiles_equal_full_sort_with_ties(spark):
    # 20k values with heavy ties and a hot value holding a third of the rows
    rows = [(float(i % 97) if i % 3 else 42.0,) for i in range(20_000)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.5, 0.99, 0.9999, 1.0]
    band = exact_quantiles(df, "x", probs, num_partitions=4, accuracy=1000).first()
    sort = exact_quantiles(df, "x", probs, num_partitions=4, method="sort").first()
    vals = [r[0] for r in rows]
    assert list(band) == list(sort)
    for i, p in enumerate(probs):
        assert band[i] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12)


def test_band_quantiles_fall_back_when_the_sketch_misses(spark, monkeypatch):
    import tillwise.operators.ranking as R
    vals = [float((i * 7919) % 1013) for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    # a sketch that answers far below every value: no band holds its ranks
    monkeypatch.setattr(R.F, "percentile_approx",
                        lambda col, pct, acc: F.transform(pct, lambda x: F.lit(-1.0e9)))
    sorted_calls = []
    full = R._quantiles_by_sort
    monkeypatch.setattr(R, "_quantiles_by_sort",
                        lambda *a, **k: sorted_calls.append(1) or full(*a, **k))
    row = R.exact_quantiles(df, "x", [0.5, 0.99], num_partitions=3).first()
    assert sorted_calls == [1]
    assert row[0] == pytest.approx(float(np.percentile(vals, 50)), rel=1e-12)
    assert row[1] == pytest.approx(float(np.percentile(vals, 99)), rel=1e-12)


def test_band_quantiles_rank_only_the_band(spark, monkeypatch):
    import tillwise.operators.ranking as R
    df = spark.createDataFrame([(float(i),) for i in range(50_000)], "x double")
    seen = []
    full = R.weighted_positions
    monkeypatch.setattr(R, "weighted_positions",
                        lambda d, *a, **k: seen.append(d.count()) or full(d, *a, **k))
    row = R.exact_quantiles(df, "x", [0.5], num_partitions=4).first()
    assert row[0] == 24_999.5
    assert len(seen) == 1 and seen[0] < 50_000 * 0.01


def test_quantiles_rank_a_hot_value_as_one_row(spark, monkeypatch):
    import tillwise.operators.ranking as R
    # 7.0 holds a third of the rows and sits at the median: it is one
    # (value, count) row in the ranked input, in both methods
    vals = [7.0 if i % 3 == 0 else float(i % 40) for i in range(9_000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    seen = []
    full = R.weighted_positions
    monkeypatch.setattr(R, "weighted_positions",
                        lambda d, *a, **k: seen.append(d.filter("_v = 7.0").collect()) or full(d, *a, **k))
    for method in ("band", "sort"):
        seen.clear()
        row = R.exact_quantiles(df, "x", [0.25, 0.5, 0.75], num_partitions=4, method=method).first()
        # one row per band holding it (at most one per quantile), never one per line
        assert len(seen) == 1 and 1 <= len(seen[0]) <= 3
        assert all(r._c == vals.count(7.0) for r in seen[0])
        for i, p in enumerate([0.25, 0.5, 0.75]):
            assert row[i] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12)


@pytest.mark.parametrize("n", [0, 1, 5, 9, 1001])
def test_ntiles_match_builtin_per_column(spark, n):
    rows = [(i, i % 3, None if i % 7 == 0 else (i * 31) % 5, float((i * 17) % 11) / 4) for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, a int, b bigint, c double")
    for parts in (1, 4):
        got = {r.id: (r.a, r.b, r.c, r.sa, r.sb, r.sc) for r in
               ntiles(df, 4, "id", ["a", "b", "c"], ["sa", "sb", "sc"], num_partitions=parts).collect()}
        want = {}
        for i, a, b, c in rows:
            want[i] = [a, b, c]
        for col in ("a", "b", "c"):
            w = Window.orderBy(F.col(col).desc(), F.col("id").asc())
            for r in df.select("id", F.ntile(4).over(w).alias("s")).collect():
                want[r.id].append(r.s)
        assert got == {k: tuple(v) for k, v in want.items()}


@pytest.mark.parametrize("n,parts", [(0, 4), (3, 8), (500, 1), (500, 6)])
def test_weighted_positions_are_prefix_sums(spark, n, parts):
    from tillwise.operators.ranking import weighted_positions
    rows = [(float((i * 7919) % 1009), 1 + (i * 31) % 5) for i in range(n)]
    rows = list({v: (v, c) for v, c in rows}.values())   # unique by value
    df = spark.createDataFrame(rows, "v double, c bigint")
    got = {r.v: (r._start, r._total) for r in
           weighted_positions(df, [F.col("v").asc()], "c", num_partitions=parts).collect()}
    total, start, want = sum(c for _, c in rows), 0, {}
    for v, c in sorted(rows):
        want[v] = (start, total)
        start += c
    assert got == want


@pytest.mark.parametrize("force_fallback", [False, True])
def test_exact_quantiles_many_match_numpy(spark, monkeypatch, force_fallback):
    import tillwise.operators.ranking as R
    if force_fallback:
        monkeypatch.setattr(R.F, "percentile_approx",
                            lambda col, pct, acc: F.transform(pct, lambda x: F.lit(-1.0e9)))
    rows = [(None if i % 5 == 0 else float(i % 13), 4.0 if i % 3 == 0 else float(i), None)
            for i in range(3_000)]
    df = spark.createDataFrame(rows, "a double, b double, e double")
    specs = [("a", 0.5, "a_med"), ("b", 0.5, "b_med"), ("b", 0.99, "b_q99"), ("a", 0.0, "a_min"),
             ("e", 0.5, "e_med"), ("b", 1.0, "b_max")]
    got = R.exact_quantiles_many(df, specs, num_partitions=4, accuracy=1000).first()
    for col, p, name in specs:
        vals = [r[["a", "b", "e"].index(col)] for r in rows]
        vals = [x for x in vals if x is not None]
        if not vals:
            assert got[name] is None
        else:
            assert got[name] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12)


def test_ranges_follow_the_rows(spark):
    """A small column makes few ranges, however many shuffle partitions the session has."""
    from tillwise.operators.ranking import global_rank, ranges_for
    assert [ranges_for(n) for n in (0, 1, 10**6, 10**6 + 1)] == [1, 1, 1, 2] and ranges_for(5, 7) == 7
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 500)
    try:
        ranked = global_rank(spark.range(3000), [F.col("id").desc()])
        assert ranked.groupBy().agg(F.sum(F.col("_rank") + F.col("id"))).first()[0] == 3000 * 2999
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from unittest.mock import MagicMock
    from tillwise.session import ensure_checkpoint_dir
    spark = MagicMock()
    sc = spark.sparkContext
    sc.getCheckpointDir.return_value, sc.master = None, "yarn"
    sc.getConf.return_value.get.return_value = None
    spark.conf.get.return_value = None
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(spark)
