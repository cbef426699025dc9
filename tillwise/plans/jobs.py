"""The two batch jobs: basket rules from a CSV, CLV model from a CSV.

Wrong parameters are a ``ValueError``; a missing, an empty and a malformed file
are different errors; the output files have fixed columns; every step runs
as Spark jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import basket as B
from ..operators import clv_model as M
from ..schemas import require_columns
from ..sources.files import CSV_OPTIONS, load_csv, whole_number
from ..sources.sinks import read_rules, save_model, save_predictions, save_rules

BASKET_COLUMNS = ["invoice_number", "item_code", "item_description", "quantity",
                  "is_return", "is_anonymous"]


def read_basket_input(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The cleaned-lines CSV, typed: codes as strings, flags and quantity as int.

    ``6.0`` is the number 6; a value that is no whole number stops the job (a
    null would drop its line without a word).
    """
    df = load_csv(spark, path, multiline=multiline)
    require_columns(df, BASKET_COLUMNS)
    return df.select(
        F.col("invoice_number").cast("string"), F.col("item_code").cast("string"),
        F.col("item_description").cast("string"),
        *[whole_number(c).alias(c) for c in ["quantity", "is_return", "is_anonymous"]])


def run_basket_job(spark: SparkSession, input_path: str, output_path: str,
                   min_support: float = 0.01, min_confidence: float = 0.2,
                   max_len: int | None = None, top_n: int = 5) -> tuple[B.BasketResult, DataFrame]:
    """Load, clean, mine, write the rules file; returns the result (with the
    cleaning report) and the top rules."""
    df = read_basket_input(spark, input_path)
    res = B.market_basket(df, min_support, min_confidence, max_len, strict=True)
    save_rules(res.rules, output_path)
    # the top rules are read back from the written file: no second mining pass
    top = B.top_rules(read_rules(spark, output_path), top_n)
    return res, top


@dataclass
class ClvJobOutput:
    result: M.ClvResult
    best_params: dict
    best_cv_rmse: float
    test_metrics: dict
    preparation: dict        # rows read and dropped, nulls per feature, clip bound
    split_sizes: dict
    target_stats: dict
    prediction_stats: dict


def run_clv_job(spark: SparkSession, input_path: str, pred_path: str, model_path: str,
                test_size: float = 0.2, random_state: int = 42, n_iter: int = 20,
                num_folds: int = 3, parallelism: int = 4, space: dict | None = None) -> ClvJobOutput:
    """Features CSV -> prepared -> split -> search -> test metrics -> refit -> files,
    and the reports of each step (one row each)."""
    features = load_csv(spark, input_path)
    res = M.clv_pipeline(features, test_size, random_state, n_iter, num_folds, parallelism, space)
    save_predictions(res.predictions, pred_path)
    save_model(res.model, model_path)
    row = lambda df: df.first().asDict()
    sizes = M.split_sizes(M.train_test_split(res.prepared, test_size, random_state, materialize_input=False))
    return ClvJobOutput(
        res, res.search.best_params, res.search.best_cv_rmse, row(res.test_metrics),
        row(M.preparation_report(features)), {r["split"]: r["n"] for r in sizes.collect()},
        row(M.describe(res.prepared, M.TARGET)), row(M.describe(res.predictions, "clv_prediction", population=True)))


def export_csv(df: DataFrame, path: str) -> None:
    """Export a table as a header CSV directory (the hand-off between jobs)."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
