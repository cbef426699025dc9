import os
import tempfile

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tillwise.plans import jobs
from tillwise.plans.notebook import TableStore, profile_queries, run_notebook
from tillwise.plans.registry import cleaned
from tillwise.sources.files import load_csv
from tillwise.sources.raw import transactions_from_tpch
from tillwise.sources.sinks import read_table, replace_table

from helpers import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="tillwise-test-")


def test_csv_errors(spark):
    d = _tmp()
    with pytest.raises(FileNotFoundError):
        load_csv(spark, os.path.join(d, "missing.csv"))
    empty = os.path.join(d, "empty.csv")
    open(empty, "w").close()
    with pytest.raises(ValueError, match="no header line"):
        load_csv(spark, empty)
    bad = os.path.join(d, "bad.csv")
    with open(bad, "w") as f:
        f.write("a,b\n1,2\nx,3\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(ValueError, match="malformed record"):
        load_csv(spark, bad, schema, validate=True)
    good = load_csv(spark, bad)
    assert good.count() == 2


def test_notebook_writes_every_table(spark):
    store = TableStore(spark, root=_tmp())
    raw = transactions_from_tpch(spark, SF_SMALL)
    out = run_notebook(raw, store)
    assert set(out) == {"online_retail_stage", "online_retail_clean", "customer_dim", "product_dim",
                        "rfm_raw", "rfm_score", "rfm_segment", "cohort", "cohort_activity",
                        "cohort_retention", "clv_features"}
    assert out["online_retail_clean"].count() == raw.count()
    assert out["rfm_segment"].count() == out["rfm_raw"].count()
    prof = profile_queries(out["online_retail_stage"])
    assert prof["profile"].first().row_count == raw.count()


def test_basket_job_from_csv(spark):
    d = _tmp()
    src = os.path.join(d, "clean_csv")
    jobs.export_csv(cleaned(spark, SF_SMALL), src)
    res, top = jobs.run_basket_job(spark, src, os.path.join(d, "rules"), min_support=0.01,
                                   min_confidence=0.05)
    rules = spark.read.option("header", True).csv(os.path.join(d, "rules"))
    assert rules.columns[:2] == ["antecedent_codes", "consequent_codes"] and len(rules.columns) == 11
    assert rules.count() == res.rules.count() > 0
    assert top.count() == 5
    with pytest.raises(ValueError, match="confidence"):
        jobs.run_basket_job(spark, src, os.path.join(d, "rules2"), 0.01, 1.0)


def test_clv_job_from_csv(spark):
    from tillwise.operators.clv_features import clv_features
    d = _tmp()
    src = os.path.join(d, "features_csv")
    jobs.export_csv(clv_features(cleaned(spark, SF_SMALL)), src)
    space = {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.1], "min_samples_leaf": [1],
             "min_samples_split": [2], "subsample": [1.0]}
    out = jobs.run_clv_job(spark, src, os.path.join(d, "pred"), os.path.join(d, "model"),
                           n_iter=1, space=space, parallelism=1)
    pred = spark.read.option("header", True).csv(os.path.join(d, "pred"))
    assert pred.count() == out.result.prepared.count()
    assert os.path.isdir(os.path.join(d, "model", "stages"))
    assert set(out.test_metrics) == {"n", "rmse", "mae", "r2"}


def test_rules_file_sorted_and_infinite_conviction(spark):
    from tillwise.operators import basket as B
    from tillwise.sources.sinks import RULE_COLUMNS, read_rules, save_rules
    rows = [(f"a{i}", x, f"d{x}", 1, 0, 0) for i in range(7) for x in "abc"]
    rows += [(f"e{i}", x, f"d{x}", 1, 0, 0) for i in range(5) for x in "ab"]
    rows += [(f"d{i}", "d", "dd", 1, 0, 0) for i in range(88)]
    df = spark.createDataFrame(rows, "invoice_number string, item_code string, item_description string, "
                                     "quantity int, is_return int, is_anonymous int")
    res = B.market_basket(df, min_support=0.05, min_confidence=0.1)
    out = os.path.join(_tmp(), "rules")
    save_rules(res.rules, out)
    back = read_rules(spark, out)
    assert back.columns == RULE_COLUMNS
    lifts = [r.lift for r in back.collect()]
    assert lifts == sorted(lifts, reverse=True)
    assert any(r.conviction == float("inf") for r in back.collect())


def test_table_store_catalog(spark):
    from tillwise.operators import clean as C
    spark.sql("CREATE DATABASE IF NOT EXISTS tillwise_test")
    store = TableStore(spark, database="tillwise_test")
    t = store.write(C.stage(transactions_from_tpch(spark, SF_SMALL)), "online_retail_stage")
    assert spark.read.table("tillwise_test.online_retail_stage").count() == t.count() > 0
    with pytest.raises(ValueError):
        TableStore(spark)


def test_read_basket_input_types(spark):
    d = _tmp()
    p = os.path.join(d, "lines.csv")
    with open(p, "w") as f:
        f.write("invoice_number,item_code,item_description,quantity,is_return,is_anonymous,extra\n"
                "1,85123A,x,6.0,0.0,0.0,z\n2,71053,y,,0,0,z\n")
    df = jobs.read_basket_input(spark, p)
    assert dict(df.dtypes)["quantity"] == "int" and dict(df.dtypes)["item_code"] == "string"
    assert [r.quantity for r in df.orderBy("invoice_number").collect()] == [6, None]
    for value in ("oops", "2.5"):
        with open(p, "w") as f:
            f.write(f"invoice_number,item_code,item_description,quantity,is_return,is_anonymous\n1,a,x,{value},0,0\n")
        with pytest.raises((PySparkException, Py4JJavaError), match="whole number"):
            jobs.read_basket_input(spark, p).collect()


def test_csv_of_other_tools(spark):
    """Doubled quotes, commas, line breaks and trailing backslashes, both ways."""
    import csv
    values = ['RED "BIRD" MUG', 'A "B", C', "two\nlines", "ends with \\", "", "plain"]
    p = os.path.join(_tmp(), "awkward.csv")
    with open(p, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["k", "d"])
        w.writerows((str(k), v) for k, v in enumerate(values))
    want = {str(k): v or None for k, v in enumerate(values)}
    assert {r["k"]: r["d"] for r in load_csv(spark, p).collect()} == want
    out = os.path.join(_tmp(), "again")
    jobs.export_csv(load_csv(spark, p).coalesce(1), out)
    part = next(x for x in os.listdir(out) if x.endswith(".csv"))
    with open(os.path.join(out, part), newline="") as f:
        assert {k: v or None for k, v in list(csv.reader(f))[1:]} == want


def test_read_raw_csv(spark):
    from tillwise.operators import clean as C
    from tillwise.sources.raw import read_raw_csv
    p = os.path.join(_tmp(), "raw.csv")
    with open(p, "w") as f:
        f.write("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                "536365,85123A,WHITE HANGING HEART,6,01-12-2010 08:26,2.55,17850,United Kingdom\n"
                "C536379,D,Discount,-1,01-12-2010 09:41,27.50,,United Kingdom\n")
    c = C.clean(C.stage(read_raw_csv(spark, p))).orderBy("invoice_number").collect()
    assert [(r.is_return, r.is_anonymous, str(r.revenue)) for r in c] == [(0, 0, "15.30"), (1, 1, "-27.50")]


def test_cli_basket_and_errors(spark, capsys):
    from tillwise import cli
    d = _tmp()
    src = os.path.join(d, "clean_csv")
    jobs.export_csv(cleaned(spark, SF_SMALL), src)
    assert cli.main(["basket", "--input-path", src, "--output-path", os.path.join(d, "rules"),
                     "--min-confidence", "0.05"]) == 0
    out = capsys.readouterr().out
    assert "rules" in out and "cleaning:" in out and "\n1. " in out
    assert cli.main(["basket", "--input-path", os.path.join(d, "missing"),
                     "--output-path", os.path.join(d, "r2")]) == 1
    with pytest.raises(SystemExit):
        cli.main(["basket", "--min-support", "0"])


def test_cli_notebook(spark, capsys):
    from tillwise import cli
    d = _tmp()
    raw = os.path.join(d, "raw")
    transactions_from_tpch(spark, SF_SMALL).write.parquet(raw)
    out = os.path.join(d, "tables")
    assert cli.main(["notebook", "--raw-parquet", raw, "--out-dir", out]) == 0
    assert "written:" in capsys.readouterr().out
    assert read_table(spark, os.path.join(out, "rfm_segment")).count() > 0


@pytest.mark.parametrize("catalog", [False, True])
def test_a_table_stays_readable_while_it_is_replaced(spark, catalog):
    import threading
    spark.sql("CREATE DATABASE IF NOT EXISTS tillwise_swap")
    where = {"name": f"tillwise_swap.t{os.getpid()}"} if catalog else {"path": os.path.join(_tmp(), "t")}
    read = lambda: spark.read.table(where["name"]) if catalog else read_table(spark, where["path"])
    if not catalog:
        with pytest.raises(FileNotFoundError):
            read()
    replace_table(spark.range(10).toDF("n"), **where)
    early = read()   # a reader that has begun
    seen, done = [], threading.Event()

    def look():
        while not done.is_set():
            seen.append(sorted({r["n"] < 100 for r in read().collect()}))

    reader = threading.Thread(target=look)
    reader.start()
    try:
        # slow rows, so that the reader looks while they are written
        slow = spark.range(100, 108, 1, 8).selectExpr("id AS n", "java_method('java.lang.Thread', 'activeCount') AS threads").repartition(8)
        replace_table(slow.select("n"), **where)
        with pytest.raises(Exception, match="lost"):
            replace_table(spark.range(5).selectExpr("CAST(raise_error('lost') AS BIGINT) AS n"), **where)
    finally:
        done.set()
        reader.join()
    assert sorted(r["n"] for r in read().collect()) == list(range(100, 108))   # the failed write changed nothing
    assert seen and all(s in ([True], [False]) for s in seen)   # always the old rows or the new, whole
    assert sorted(r["n"] for r in early.collect()) == list(range(10))
    replace_table(read().selectExpr("n + 1 AS n", "'x' AS more"), partition_by=["more"], **where)   # reads what it replaces; other columns
    assert sorted(r["n"] for r in read().collect()) == list(range(101, 109)) and read().columns == ["n", "more"]
    with pytest.raises(ValueError):
        replace_table(spark.range(1))
