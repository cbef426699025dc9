"""R7. The star schema as tables: dense keys, model outputs on the customer, a fact that joins without an exchange."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .measures import customer_dim_unique, product_dim_unique
from .ranking import global_rank

#: Key of lines without a known customer, or of an item that is in no plausible line.
UNKNOWN = -1


def keyed(dim: DataFrame, id_column: str, key: str) -> DataFrame:
    """``key``: 0, 1, 2, ... in the order of the id, from the distributed rank (no task sorts all ids)."""
    return global_rank(dim, [F.col(id_column).asc()], key, "_n").drop("_n")


def customer_star(cleaned: DataFrame, segments: DataFrame, quintiles: DataFrame) -> DataFrame:
    """customer_key, customer_id, country, and what the models say: RFM segment, predicted value, quintile.

    Segments and predictions are left-joined: a customer without a prediction (no history before the
    cutoff) keeps its row.
    """
    dim = keyed(customer_dim_unique(cleaned), "customer_id", "customer_key")
    return (dim.join(segments.select("customer_id", "segment"), "customer_id", "left")
               .join(quintiles.select("customer_id", "clv_prediction", "clv_quintile"), "customer_id", "left")
               .select("customer_key", "customer_id", "country", "segment", "clv_prediction", "clv_quintile"))


def product_star(cleaned: DataFrame) -> DataFrame:
    """product_key, item_code, item_description."""
    return keyed(product_dim_unique(cleaned), "item_code", "product_key").select("product_key", "item_code", "item_description")


def fact_star(cleaned: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every line with the keys of its customer and its product (``UNKNOWN`` if it has none) instead of their names.

    Left joins on unique keys, so no line is lost; a customer or item with a large share of
    the lines is left to AQE's skew join.
    """
    lines = cleaned.select("invoice_number", "invoice_date", "customer_id", "item_code", "quantity", "price", "revenue", "is_return")
    unknown = F.lit(UNKNOWN).cast("bigint")
    return (lines.join(customers.select("customer_id", "customer_key"), "customer_id", "left")
                 .join(products.select("item_code", "product_key"), "item_code", "left")
                 .select(F.coalesce("customer_key", unknown).alias("customer_key"), F.coalesce("product_key", unknown).alias("product_key"),
                         "invoice_number", "invoice_date", "quantity", "price", "revenue", "is_return"))


@dataclass
class Star:
    fact: DataFrame
    customers: DataFrame
    products: DataFrame


def write_star(spark: SparkSession, cleaned: DataFrame, segments: DataFrame, quintiles: DataFrame, prefix: str,
               folder: str, buckets: int = 16) -> Star:
    """Write fact and dimensions as catalog tables ``<prefix>_fact``, ``_customer`` and ``_product`` below ``folder``.

    The fact and the customers are bucketed by the customer key into equally many buckets, so
    joining them moves neither; choose ``buckets`` so that one holds a few hundred
    megabytes.  A known customer is one bucket's key; unknown customers share one and are
    told apart by nothing, so their lines stay where they are in every join with the customers.
    """
    ensure_checkpoint_dir(spark)
    customers = customer_star(cleaned, segments, quintiles).checkpoint(eager=True)
    products = product_star(cleaned).checkpoint(eager=True)
    tables = {"fact": (fact_star(cleaned, customers, products), "customer_key"), "customer": (customers, "customer_key"), "product": (products, "product_key")}
    for name, (df, key) in tables.items():
        own = df.repartition(buckets, key).sortWithinPartitions(key)
        own.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}").saveAsTable(f"{prefix}_{name}")
    return Star(*(spark.read.table(f"{prefix}_{name}") for name in tables))
