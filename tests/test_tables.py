"""Registered queries on tables built here: no rules, rewritten steps, lines read once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from tillwise.operators import clv_model as M
from tillwise.plans import registry as G
from tillwise.sources.raw import transactions_from_tpch


def made_tables(spark, folder, orders=60, brands=5, lines_each=3, twice=True):
    """The five tables the raw lines come from; some keys have no partner, with ``twice`` some come two times."""
    day = dt.datetime(1995, 1, 1)
    put = lambda name, data, schema: spark.createDataFrame(data, schema).coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    put("nation", [(n, f"N{n}") for n in range(3)], "n_nationkey int, n_name string")
    put("customer", [(c, c % 4 if c != 7 else None) for c in range(1, 21)] + [(5, 1)] * twice, "c_custkey bigint, c_nationkey int")
    put("part", [(p, f"name {p % 9}", f"B{p % brands}") for p in range(1, 31)] + [(3, None, "B9")] * twice, "p_partkey bigint, p_name string, p_brand string")
    put("orders", [(o, o * 7 % 23 if o != 9 else None, day + dt.timedelta(days=o * 13 % 700) if o % 11 else None) for o in range(1, orders + 1)]
        + [(4, 2, day)] * twice, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp")
    put("lineitem", [(o if o % 17 else None, (o * 5 + k * 3) % 33, k if k < 3 else 7, float(1 + (o + k) % 9), float(o * 3 + k), 0.0 if o % 2 else 0.02,
                      "RNA"[(o + k) % 3] if o % 13 else None, "FO"[o % 2]) for o in range(1, orders + 4) for k in range(1, lines_each + 1)],
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string")
    return str(folder)


def test_market_basket_of_lines_without_a_rule_is_empty(spark, tmp_path):
    d = made_tables(spark, tmp_path, orders=200, brands=31, lines_each=1, twice=False)   # an order of one line has no pair
    got = G.queries()["m8_market_basket"](spark, d)
    assert got.columns == G.RULE_COLUMNS
    assert got.count() == 0


def test_raw_lines_by_keys_without_partner_and_keys_that_come_twice(spark, tmp_path):
    d = made_tables(spark, tmp_path)
    t = {n: [r.asDict() for r in spark.read.parquet(f"{d}/{n}.parquet").collect()] for n in ("nation", "customer", "orders", "part", "lineitem")}
    want = []
    for li in t["lineitem"]:
        for o in (o for o in t["orders"] if o["o_orderkey"] == li["l_orderkey"]):
            for c in (c for c in t["customer"] if c["c_custkey"] == o["o_custkey"]):
                for n in (n for n in t["nation"] if n["n_nationkey"] == c["c_nationkey"]):
                    for p in (p for p in t["part"] if p["p_partkey"] == li["l_partkey"]):
                        back = li["l_returnflag"] == "R" and li["l_linestatus"] == "F"
                        price = 0.05 if li["l_linenumber"] == 7 and li["l_tax"] == 0 else li["l_extendedprice"]
                        want.append((f"{'C' * back}{li['l_orderkey']}", p["p_brand"], p["p_name"], int(-li["l_quantity"] if back else li["l_quantity"]),
                                     f"{price:.2f}", None if o["o_orderkey"] % 10 == 0 else o["o_custkey"], n["n_name"]))
    got = transactions_from_tpch(spark, d)
    assert len(want) > 80
    assert sorted(map(str, rows(got.withColumn("UnitPrice", F.col("UnitPrice").cast("string")).drop("InvoiceDate")))) == sorted(map(str, want))


@pytest.mark.parametrize("name", ["r8_outlier_filtered", "r10_clv_funnel", "a1_profile_of_loads", "r5_campaign", "r5_campaign_by_day",
                                  "r7_star_sales", "r7_star_lines", "s1_raw_forms"])
def test_the_raw_lines_are_joined_once(spark, tmp_path, monkeypatch, name):
    d = made_tables(spark, tmp_path, orders=120)
    want, seen = transactions_from_tpch(spark, d).count(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def lines(*args, **more):
        df = transactions_from_tpch(*args, **more)
        return df.mapInArrow(counted, df.schema)

    monkeypatch.setattr(G, "transactions_from_tpch", lines)
    G.queries()[name](spark, d).collect()
    assert seen.value == want


@pytest.mark.parametrize("name,columns", [("c4_holdout_metrics", ["n", "rmse", "mae", "r2", "finite", "in_range"]),
                                          ("c11_fitted_quintiles", ["clv_quintile", "customers", "lowest", "highest", "ordered"])])
def test_boosted_trees_on_all_features_are_fitted(spark, monkeypatch, name, columns):
    fits, real = [], M.fit

    def fit(train, params, *args, **more):
        fits.append((params["n_estimators"], params["max_depth"], more.get("features") or M.FEATURES))
        return real(train, {**params, "n_estimators": min(4, params["n_estimators"])}, *args, **more)

    monkeypatch.setattr(M, "fit", fit)
    got = G.queries()[name](spark, SF_SMALL)
    assert got.columns == columns
    found = got.collect()
    assert (100, 3, M.FEATURES) in fits and (1, 1, G.STUMP_FEATURES) in fits
    assert all(r[c] for r in found for c in columns if c in ("finite", "in_range", "ordered"))
