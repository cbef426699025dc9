"""Fixed schemas of the pipeline's inputs and a column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw transaction lines as they arrive from ingestion (InvoiceDate is a string).
RAW_TRANSACTIONS = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("UnitPrice", T.DecimalType(12, 2)),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Country", T.StringType()),
])

# The columns of the cleaned table the basket job needs.
BASKET_INPUT = T.StructType([
    T.StructField("invoice_number", T.StringType()),
    T.StructField("item_code", T.StringType()),
    T.StructField("item_description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("is_return", T.IntegerType()),
    T.StructField("is_anonymous", T.IntegerType()),
])

# Feature file of the CLV job; the reader keeps strings so that values
# which do not parse become null in the numeric coercion step.
CLV_INPUT_NAMES = ["customer_id", "total_orders", "total_revenue", "avg_order_value",
                   "days_since_first", "days_since_last", "future_6M_revenue"]

PREDICTIONS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("clv_prediction", T.DoubleType()),
])


def require_columns(df: DataFrame, required: list[str]) -> None:
    """Raise ``ValueError`` naming the missing and the available columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the input lacks the columns {missing}; it has {list(df.columns)}")
