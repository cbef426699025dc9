"""Command line for the notebook tables and the two batch jobs (same options as the single-machine scripts).

    python -m tillwise.cli basket --input-path lines_csv --output-path rules_csv \
        [--min-support 0.01] [--min-confidence 0.2] [--max-len N]
    python -m tillwise.cli clv --input-path features_csv --output-pred-path pred_csv \
        --model-path model_dir [--test-size 0.2] [--random-state 42] [--n-iter 20]
    python -m tillwise.cli notebook (--raw-table T | --raw-parquet P | --raw-csv C) \
        (--out-dir D | --database DB) [--predictions-csv pred_csv] [--cutoff d --end d]

The session comes from ``spark-submit`` / the environment when one is
active; otherwise a local one is started.  Errors exit with status 1.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators.basket import check_basket_parameters
from .plans import jobs


# The names and defaults of the options.
def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tillwise", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("basket", help="market-basket association rules")
    b.add_argument("--input-path", default="online_retail_clean.csv")
    b.add_argument("--output-path", default="market_basket_rules.csv")
    b.add_argument("--min-support", type=float, default=0.01)
    b.add_argument("--min-confidence", type=float, default=0.2)
    b.add_argument("--max-len", type=int, default=None)
    c = sub.add_parser("clv", help="customer-lifetime-value model")
    c.add_argument("--input-path", default="clv_features.csv")
    c.add_argument("--output-pred-path", default="customer_clv_pred.csv")
    c.add_argument("--model-path", default="clv_model")
    c.add_argument("--test-size", type=float, default=0.2)
    c.add_argument("--random-state", type=int, default=42)
    c.add_argument("--n-iter", type=int, default=20)
    n = sub.add_parser("notebook", help="the table pipeline: stage, clean, dimensions, RFM, cohorts, CLV")
    src = n.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-table")
    src.add_argument("--raw-parquet")
    src.add_argument("--raw-csv")
    dst = n.add_mutually_exclusive_group(required=True)
    dst.add_argument("--out-dir")
    dst.add_argument("--database")
    n.add_argument("--predictions-csv", default=None)
    n.add_argument("--cutoff", default=None)
    n.add_argument("--end", default=None)
    return p


def _validate(p: argparse.ArgumentParser, a: argparse.Namespace) -> None:
    try:
        if a.job == "basket":
            check_basket_parameters(a.min_support, a.min_confidence, a.max_len)
        elif a.job == "clv" and not 0.0 < a.test_size < 1.0:
            raise ValueError(f"the test share lies between 0 and 1, both excluded, not {a.test_size}")
    except ValueError as e:
        p.error(str(e))


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from .session import local_session
    return local_session()


def _notebook(spark: SparkSession, a: argparse.Namespace) -> None:
    from pyspark.sql import functions as F

    from .plans.notebook import TableStore, profile_queries, run_notebook
    from .sources import raw as R
    from .sources.files import load_csv
    if a.raw_table:
        lines = R.read_raw_table(spark, a.raw_table)
    elif a.raw_parquet:
        lines = R.read_raw_parquet(spark, a.raw_parquet)
    else:
        lines = R.read_raw_csv(spark, a.raw_csv)
    pred = None
    if a.predictions_csv:
        p = load_csv(spark, a.predictions_csv)
        key = "customer_id" if "customer_id" in p.columns else "CustomerID"
        pred = p.select(F.col(key).try_cast("bigint").alias("customer_id"),
                        F.col("clv_prediction").try_cast("double").alias("clv_prediction"))
    store = TableStore(spark, root=a.out_dir, database=a.database)
    tables = run_notebook(lines, store, pred, a.cutoff, a.end)
    for name, row in profile_queries(tables["online_retail_stage"]).items():
        print(name, row.first().asDict())
    print("written:", ", ".join(tables))


def main(argv: list[str] | None = None) -> int:
    p = _parser()
    a = p.parse_args(argv)
    _validate(p, a)
    spark = _session()
    try:
        if a.job == "basket":
            res, top = jobs.run_basket_job(spark, a.input_path, a.output_path, a.min_support,
                                           a.min_confidence, a.max_len)
            s = res.summary.first()
            print(f"cleaning: {res.cleaning.first().asDict()}")
            print(f"{s.n_transactions:,} baskets of {s.n_products:,} items gave {s.n_itemsets:,} itemsets and {s.n_rules:,} rules")
            for i, r in enumerate(top.collect(), 1):  # at most five rows
                print(f"{i}. {r.antecedent_descriptions} => {r.consequent_descriptions} "
                      f"(lift {r.lift:.2f}, confidence {r.confidence:.4f}, support {r.support:.4f})")
            res.release()
        elif a.job == "notebook":
            _notebook(spark, a)
        else:
            out = jobs.run_clv_job(spark, a.input_path, a.output_pred_path, a.model_path,
                                   a.test_size, a.random_state, a.n_iter)
            for name in ("preparation", "split_sizes", "target_stats", "best_params", "best_cv_rmse", "test_metrics", "prediction_stats"):
                print(f"{name.replace('_', ' ')}: {getattr(out, name)}")
    except (FileNotFoundError, ValueError) as e:
        print(f"ERROR: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
