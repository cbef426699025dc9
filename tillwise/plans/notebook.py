"""The SQL notebook's table pipeline, as replace-table writes.

Each stage is written once (``replace_table``: a new version, then one
pointer) and the next stages read the written table back, as the notebook's ``CREATE OR REPLACE TABLE``
chain does.  Writing ``clean`` cuts the lineage of the source joins: every
later table is a scan of one parquet table, and a lost executor only costs
the stage that was running.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import cohort as H
from ..operators import rfm as R
from ..operators.clv_features import clv_features
from ..operators.clv_model import clv_quintiles
from ..sources.sinks import read_table, replace_table

TABLES = ["online_retail_stage", "online_retail_clean", "customer_dim", "product_dim",
          "rfm_raw", "rfm_score", "rfm_segment", "cohort", "cohort_activity",
          "cohort_retention", "clv_features", "clv_segment"]


class TableStore:
    """Where tables go: a catalog database or a directory of parquet tables."""

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None):
        if (root is None) == (database is None):
            raise ValueError("give exactly one of root or database")
        self.spark, self.root, self.database = spark, root, database

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        if self.database:
            replace_table(df, name=f"{self.database}.{name}", partition_by=partition_by)
        else:
            replace_table(df, path=f"{self.root.rstrip('/')}/{name}", partition_by=partition_by)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """The newest rows of a table; it stays readable while it is replaced."""
        if self.database:
            return self.spark.read.table(f"{self.database}.{name}")
        return read_table(self.spark, f"{self.root.rstrip('/')}/{name}")


def run_notebook(raw: DataFrame, store: TableStore, predictions: DataFrame | None = None,
                 cutoff: str | None = None, end: str | None = None,
                 concurrency: int = 4, month_files: int = 4) -> dict[str, DataFrame]:
    """Build every notebook table from the raw lines; returns them read back.

    ``predictions`` (customer_id, clv_prediction) -- the CLV job's output --
    adds ``clv_segment``.  ``cutoff``/``end`` default to the last invoice
    date minus six months and the last invoice date.

    The cleaned table is partitioned by ``invoice_month``, each month in at most ``month_files``
    files, so that date windows read their months only.  Staging and cleaning run first; the table groups that only read the
    clean table (dimensions, RFM, cohorts, CLV features) are then submitted
    from ``concurrency`` driver threads, so their Spark jobs share the
    cluster instead of queueing one after another.
    """
    out: dict[str, DataFrame] = {}
    out["online_retail_stage"] = store.write(C.stage(raw), "online_retail_stage")
    # rows of a month together before the write: one file or a few for each month, not one for each task and month
    by_month = C.with_month(C.clean(out["online_retail_stage"])).repartition("invoice_month", F.pmod(F.xxhash64("invoice_number"), F.lit(month_files)))
    out["online_retail_clean"] = store.write(by_month, "online_retail_clean", ["invoice_month"])
    clean = out["online_retail_clean"]

    def dims():
        return {"customer_dim": store.write(C.customer_dim(clean), "customer_dim"),
                "product_dim": store.write(C.product_dim(clean), "product_dim")}

    def rfm():
        raw_rfm = store.write(R.rfm_raw(clean), "rfm_raw")
        scored = R.rfm_segment(raw_rfm)
        return {"rfm_raw": raw_rfm,
                "rfm_score": store.write(scored.select("customer_id", "r_score", "f_score", "m_score"),
                                         "rfm_score"),
                "rfm_segment": store.write(scored, "rfm_segment")}

    def cohorts():
        act = store.write(H.cohort_activity(clean), "cohort_activity")
        return {"cohort": store.write(H.cohort(clean), "cohort"), "cohort_activity": act,
                "cohort_retention": store.write(H.cohort_retention(act), "cohort_retention")}

    def clv():
        t = {"clv_features": store.write(clv_features(clean, cutoff, end), "clv_features")}
        if predictions is not None:
            t["clv_segment"] = store.write(clv_quintiles(predictions), "clv_segment")
        return t

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        for tables in pool.map(lambda f: f(), [rfm, clv, cohorts, dims]):
            out.update(tables)
    return {name: out[name] for name in TABLES if name in out}


def profile_queries(stage_table: DataFrame) -> dict[str, DataFrame]:
    """The two exploration queries shown to a person (not written)."""
    return {"profile": C.profile(stage_table), "sanity": C.sanity(stage_table)}
