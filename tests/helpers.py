"""Small builders for hand-made fixtures."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"

CLEAN_SCHEMA = ("invoice_number string, item_code string, item_description string, quantity int, "
                "invoice_date date, invoice_timestamp timestamp_ntz, price decimal(12,2), "
                "revenue decimal(23,2), customer_id bigint, is_anonymous int, is_return int, "
                "country string")


def line(invoice, customer, date, quantity=1, price="1.00", item="A", desc="a", country="UK"):
    d = dt.date.fromisoformat(date) if isinstance(date, str) else date
    p = Decimal(price)
    return (invoice, item, desc, quantity, d,
            dt.datetime(d.year, d.month, d.day) if d else None, p,
            (Decimal(quantity) * p) if quantity is not None else None, customer,
            1 if customer is None else 0, 1 if invoice.startswith("C") else 0, country)


def clean_frame(spark, lines):
    return spark.createDataFrame(lines, CLEAN_SCHEMA)


def rows(df, *cols, order=None):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.orderBy(*(order or sel.columns)).collect()]


__all__ = ["SF_SMALL", "line", "clean_frame", "rows", "F"]
