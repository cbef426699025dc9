import datetime as dt
from decimal import Decimal

from pyspark.sql import Row

from tillwise.operators import clean as C
from tillwise.schemas import RAW_TRANSACTIONS


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_TRANSACTIONS)


def test_date_repair(spark):
    rows = [("1", "A", "x", 1, s, Decimal("1.00"), 1, "UK") for s in
            [" 01-12-2010 08:26", "01/12/2010 08:26", "12/1/2010 8:26", None]]
    out = C.stage(_raw(spark, rows)).select("invoice_date", "invoice_timestamp").collect()
    assert out[0] == Row(invoice_date=dt.date(2010, 12, 1),
                         invoice_timestamp=dt.datetime(2010, 12, 1, 8, 26))
    assert out[1].invoice_date == dt.date(2010, 12, 1)
    assert out[2].invoice_date is None and out[2].invoice_timestamp is None
    assert out[3].invoice_date is None and out[3].invoice_timestamp is None


def test_return_flags_and_sanity(spark):
    rows = [(inv, "A", "x", q, " 01-12-2010 08:26", Decimal("2.50"), None if inv == "4" else 7, "UK")
            for inv, q in [("C1", -2), ("c2", 1), ("3", -1), ("4", 1)]]
    staged = C.stage(_raw(spark, rows))
    flags = [r.is_return for r in C.clean(staged).orderBy("quantity", "invoice_number").collect()]
    # ordered by quantity: C1(-2), 3(-1), 4(1), c2(1)
    assert flags == [1, 0, 0, 0]
    s = C.sanity(staged).first()
    assert s.returns == 2  # lower(...) LIKE 'C%' never matches: negative quantities only
    assert s.invaild_customers == 1
    assert s.revenue == (-2 + 1 - 1 + 1) * 2.5


def test_revenue_and_anonymous(spark):
    rows = [("5", "A", "x", 3, " 02-01-2011 10:00", Decimal("0.05"), None, "FR")]
    c = C.clean(C.stage(_raw(spark, rows))).first()
    assert c.revenue == Decimal("0.15") and c.is_anonymous == 1 and c.is_return == 0


def test_dimensions_not_unique(spark):
    rows = [("1", "A", "x", 1, " 01-12-2010 08:26", Decimal("1.00"), 1, "UK"),
            ("2", "A", "y", 1, " 01-12-2010 08:26", Decimal("1.00"), 1, "FR"),
            ("3", "A", "z", -1, " 01-12-2010 08:26", Decimal("1.00"), 2, "UK"),
            ("4", "B", "w", 1, " 01-12-2010 08:26", Decimal("0.09"), None, "UK")]
    c = C.clean(C.stage(_raw(spark, rows)))
    assert C.customer_dim(c).count() == 3           # (1,UK), (1,FR), (2,UK)
    prods = {tuple(r) for r in C.product_dim(c).collect()}
    assert prods == {("A", "x"), ("A", "y")}        # z: quantity<0, w: price<0.1


def test_profile_exact_and_approx(spark):
    rows = [(str(i), f"I{i % 3}", "x", 1, " 01-12-2010 08:26", Decimal("1.00"), i % 5, f"C{i % 2}")
            for i in range(50)]
    st = C.stage(_raw(spark, rows))
    p = C.profile(st).first()
    assert (p.row_count, p.customers, p.items, p.countries) == (50, 5, 3, 2)
    a = C.profile(st, approximate=True).first()
    assert (a.customers, a.items, a.countries) == (5, 3, 2)


def test_extra_date_formats(spark):
    rows = [("1", "A", "x", 1, s, Decimal("1.00"), 1, "UK") for s in ["12/1/2010 8:26", " 01-12-2010 08:26"]]
    out = C.stage(_raw(spark, rows), extra_date_formats=["M/d/yyyy H:mm"]).collect()
    assert out[0].invoice_date == dt.date(2010, 12, 1)
    assert out[0].invoice_timestamp == dt.datetime(2010, 12, 1, 8, 26)
    assert out[1].invoice_date == dt.date(2010, 12, 1)


def test_sanity_fixed_returns(spark):
    rows = [(inv, "A", "x", q, " 01-12-2010 08:26", Decimal("1.00"), 1, "UK")
            for inv, q in [("C1", 2), ("c2", 1), ("3", -1), ("4", 1)]]
    st = C.stage(_raw(spark, rows))
    assert C.sanity(st).first().returns == 1
    assert C.sanity(st, fixed_returns=True).first().returns == 3
