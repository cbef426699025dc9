import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tillwise.operators import basket as B

SCHEMA = ("invoice_number string, item_code string, item_description string, quantity int, "
          "is_return int, is_anonymous int")


def _lines(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _fixture(spark):
    rows = []
    for i in range(7):
        rows += [(f"a{i}", x, f"desc {x}", 1, 0, 0) for x in "abc"]
    rows += [(f"d{i}", "d", "desc d", 1, 0, 0) for i in range(93)]
    return _lines(spark, rows)


def test_threshold_equality_and_all_lengths(spark):
    b = B.baskets(B.preprocess(_fixture(spark)))
    its = {tuple(r.items): (r.freq, r.support) for r in B.frequent_itemsets(b, 0.07).collect()}
    # 7/100 == 0.07 exactly: every subset of {a,b,c} is frequent
    assert len(its) == 8
    assert its[("a", "b", "c")] == (7, 0.07) and its[("d",)] == (93, 0.93)
    assert len(B.frequent_itemsets(b, 0.0701).collect()) == 1


def test_rules_multi_item_consequents_and_confidence_one(spark):
    b = B.baskets(B.preprocess(_fixture(spark)))
    rules = B.association_rules(B.frequent_itemsets(b, 0.07), 0.5).collect()
    assert len(rules) == 12   # 6 from pairs, 6 from the triple
    two = [r for r in rules if r.consequent_len == 2]
    assert sorted(tuple(r.antecedents) for r in two) == [("a",), ("b",), ("c",)]
    for r in rules:
        assert r.confidence == 1.0 and math.isinf(r.conviction)
        assert r.lift == pytest.approx(1 / 0.07)
        assert r.leverage == pytest.approx(0.07 - 0.07 * 0.07)


def test_max_len(spark):
    b = B.baskets(B.preprocess(_fixture(spark)))
    assert B.frequent_itemsets(b, 0.07, max_len=2).agg(F.max("length")).first()[0] == 2


def test_preprocess_steps_and_report(spark):
    rows = [("1", "a", "x", 1, 0, 0), ("1", "a", "y", 2, 0, 0),   # duplicate pair
            (None, "a", "x", 1, 0, 0), ("2", None, "x", 1, 0, 0),   # missing keys
            ("C3", "a", "x", -1, 1, 0), ("4", "a", "x", 1, 0, 1),   # return, anonymous
            ("5", "b", "x", 0, 0, 0)]                               # non-positive quantity
    df = _lines(spark, rows)
    rep = B.clean_report(df).first()
    assert (rep.initial_rows, rep.after_missing, rep.after_returns, rep.after_anonymous,
            rep.after_positive_qty, rep.after_dedup) == (7, 5, 4, 3, 2, 1)
    assert rep.rows_removed == 6 and rep.pct_removed == pytest.approx(85.7)
    kept = B.preprocess(df).collect()
    assert [(r.invoice_number, r.item_code, r.item_description) for r in kept] == [("1", "a", "x")]


def test_item_mode_ties_nulls_and_unknown(spark):
    rows = [("1", "t", "beta", 1, 0, 0), ("2", "t", "alpha", 1, 0, 0),      # tie -> smallest
            ("3", "n", None, 1, 0, 0), ("4", "n", "kept", 1, 0, 0),         # nulls ignored
            ("5", "z", None, 1, 0, 0)]                                      # only nulls
    modes = {r.item_code: r.item_description for r in B.item_mode(_lines(spark, rows)).collect()}
    assert modes == {"t": "alpha", "n": "kept", "z": None}
    rules = spark.createDataFrame([(["t", "z"], ["n"], 0.5, 0.5, 0.5, 1.0, 2.0, 0.25, float("inf"), 2, 1)],
                                  "antecedents array<string>, consequents array<string>, "
                                  "antecedent_support double, consequent_support double, support double, "
                                  "confidence double, lift double, leverage double, conviction double, "
                                  "antecedent_len int, consequent_len int")
    d = B.attach_descriptions(rules, _lines(spark, rows)).first()
    assert d.antecedent_codes == "t, z" and d.consequent_codes == "n"
    assert d.antecedent_descriptions == "alpha, Unknown (z)" and d.consequent_descriptions == "kept"


def test_pipeline_validation_and_strict_errors(spark):
    df = _fixture(spark)
    with pytest.raises(ValueError):
        B.market_basket(df, min_support=0)
    with pytest.raises(ValueError):
        B.market_basket(df, min_confidence=1.5)
    with pytest.raises(ValueError):
        B.market_basket(df, max_len=0)
    with pytest.raises(ValueError, match="no itemset reaches the support"):
        B.market_basket(df, min_support=0.99)
    with pytest.raises(ValueError, match="cleaning left no line"):
        B.market_basket(df.filter(F.lit(False)))
    res = B.market_basket(df, min_support=0.07, min_confidence=0.5)
    s = res.summary.first()
    assert (s.n_transactions, s.n_products, s.n_itemsets, s.n_rules) == (100, 4, 8, 12)
    assert B.top_rules(res.rules, 5).count() == 5


def test_only_frequent_itemsets_are_mined(spark):
    """1,000 baskets at support 0.0015: an itemset needs two baskets, so one of 17 items gives nothing."""
    assert B.smallest_passing_count(0.0015, 1000) == 2
    assert [B.smallest_passing_count(s, n) for s, n in ((0.01, 100), (1.0, 7), (0.07, 100), (1e-9, 10))] == [1, 7, 7, 1]
    rows = [(str(k), ["a"]) for k in range(999)] + [("big", [f"i{k:02d}" for k in range(17)])]
    df = spark.createDataFrame(rows, "invoice_number string, items array<string>")
    assert [(r["items"], r["freq"]) for r in B.frequent_itemsets(df, 0.0015).collect()] == [(["a"], 999)]


def test_short_itemsets_are_counted_as_mined(spark):
    b = B.baskets(B.preprocess(_fixture(spark)))
    mined = {(tuple(r["items"]), r["freq"]) for r in B.frequent_itemsets(b, 0.05).collect()}
    for n in (1, 2):
        counted = {(tuple(r["items"]), r["freq"]) for r in B.frequent_itemsets(b, 0.05, max_len=n).collect()}
        assert counted == {x for x in mined if len(x[0]) <= n} and counted


def test_pruned_rules_equal_filtered_rules(spark):
    its = B.frequent_itemsets(B.baskets(B.preprocess(_fixture(spark))), 0.05)
    for least in (0.1, 0.5, 0.9):
        pruned = {tuple(map(str, r)) for r in B.association_rules(its, least).collect()}
        whole = {tuple(map(str, r)) for r in B.association_rules(its).filter(F.col("confidence") >= least).collect()}
        assert pruned == whole


def test_errors_leave_nothing_cached(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(ValueError):
        B.market_basket(_fixture(spark), min_support=0.99)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("max_len", [1, 2, 3, 4, 5])
def test_itemsets_by_level_equal_every_subset(spark, max_len):
    rnd = random.Random(max_len)
    held = [sorted(rnd.sample("abcdefghij", rnd.randint(1, 8))) for _ in range(200)] + [list("abcdefghij")] * 3
    want = {}
    for basket in held:
        for n in range(1, max_len + 1):
            for s in itertools.combinations(basket, n):
                want[s] = want.get(s, 0) + 1
    want = {s: n for s, n in want.items() if n >= 6}
    df = spark.createDataFrame([(i, b) for i, b in enumerate(held)], "invoice_number int, items array<string>").repartition(7)
    got = B.frequent_itemsets(df, 6 / len(held), max_len).collect()
    assert {tuple(r["items"]): r["freq"] for r in got} == want and len(got) == len(want)
    if max_len == 5:
        every = B.frequent_itemsets(df, 6 / len(held)).filter("length <= 5").collect()
        assert {tuple(r["items"]): r["freq"] for r in every} == want


def test_a_basket_of_many_items_is_rows_and_no_array_of_pairs(spark):
    many = [f"{i:04d}" for i in range(700)]
    df = spark.createDataFrame([(0, many), (1, many[:3]), (2, many[1:3])], "invoice_number int, items array<string>")
    got = {tuple(r["items"]): r["freq"] for r in B.frequent_itemsets(df, 2 / 3, 3).collect()}
    assert got == {("0000",): 2, ("0001",): 3, ("0002",): 3, ("0000", "0001"): 2, ("0000", "0002"): 2, ("0001", "0002"): 3, ("0000", "0001", "0002"): 2}
