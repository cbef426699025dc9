"""CLV modelling on Spark ML: preparation, split, search, fit, score.

* preparation maps column names without case, coerces features to double
  (unparsable -> null), imputes each feature with its exact median and
  clips the target at its exact 0.99 quantile -- both from the distributed
  rank of ``ranking.exact_quantiles``, never from one task holding a column;
* the train/test split is repeatable and exact in size: rows are ordered
  by a seeded hash of the id and the first ``ceil(test_size * n)`` are test;
* the random search samples parameter maps from the grid with a seeded
  RNG and evaluates each on hashed folds; every trial (draw, fold) is a
  distributed fit whose result is written to a ledger in the shared folder, so
  a search that was broken off goes on where it stopped;
* the best parameters are refit on all rows, then every customer is scored.
"""

from __future__ import annotations

import itertools
import json
import math
import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import require_columns
from ..session import ensure_checkpoint_dir
from .ranking import exact_quantiles, exact_quantiles_many, global_rank, ntile

# Input names (matched without case) -> model names.
COLUMN_MAPPING = {
    "customer_id": "CustomerID",
    "total_orders": "hist_orders",
    "total_revenue": "hist_revenue",
    "avg_order_value": "hist_avg_order_value",
    "days_since_first": "days_since_first",
    "days_since_last": "days_since_last",
    "future_6M_revenue": "future_6m_revenue",
}
REQUIRED = ["CustomerID", "hist_orders", "hist_revenue", "hist_avg_order_value",
            "days_since_first", "days_since_last", "future_6m_revenue"]
FEATURES = ["hist_orders", "hist_revenue", "hist_avg_order_value",
            "days_since_first", "days_since_last"]
TARGET = "future_6m_revenue"

# The search space of the random search.
PARAM_SPACE = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 5, 7, 10],
    "learning_rate": [0.01, 0.05, 0.1],
    "min_samples_leaf": [1, 2, 4],
    "min_samples_split": [2, 5, 10],
    "subsample": [0.8, 0.9, 1.0],
}


# ------------------------------------------------------------------ preparation

def map_columns(df: DataFrame) -> DataFrame:
    """Rename input columns to the model names, matching names without case.

    Metadata only (no job).  If two inputs differ only by case, the later
    one is taken.
    """
    lower = {c.lower(): c for c in df.columns}
    renames = {lower[k.lower()]: v for k, v in COLUMN_MAPPING.items() if k.lower() in lower}
    return df.withColumnsRenamed(renames) if renames else df


def _quantile(df: DataFrame, column: str, p: float, approx_accuracy: int | None):
    """Scalar-subquery column: exact (distributed rank) or approximate quantile.

    The approximate form is one pass with a mergeable sketch per task
    (``percentile_approx``, relative rank error about 1 / accuracy) -- no
    sort, for inputs where an exact rank is not worth a shuffle.
    """
    if approx_accuracy:
        return df.agg(F.percentile_approx(F.col(column), p, approx_accuracy)).scalar()
    return exact_quantiles(df, column, [p], ["q"], materialize_input=False).scalar()


def prepare(features: DataFrame, clip_quantile: float = 0.99,
            approx_accuracy: int | None = None) -> DataFrame:
    """CustomerID, the five features (double, imputed), the clipped target,
    and the unclipped target as ``future_6m_revenue_raw``.

    Null counts come from one aggregate; a median is only computed for a
    feature that has nulls (the imputation is a no-op otherwise).  Medians
    and the clip bound are exact and interpolated, like the single-machine
    job, and all come from one set of passes (``exact_quantiles_many``);
    ``approx_accuracy`` switches them to one-pass sketches.  Runs these passes
    when called.
    """
    ensure_checkpoint_dir(features.sparkSession)
    df = map_columns(features)
    require_columns(df, REQUIRED)
    df = df.select(
        "CustomerID",
        *[F.col(c).try_cast("double").alias(c) for c in FEATURES],
        F.col(TARGET).try_cast("double").alias(TARGET),
    ).dropna(subset=["CustomerID", TARGET]).checkpoint(eager=True)
    # one row per customer, written once: the null counts, the quantile
    # ranks and the output all read it instead of re-running the features
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FEATURES]).first()
    need = [c for c in FEATURES if nulls[c] > 0]
    if approx_accuracy:
        fills = {c: _quantile(df, c, 0.5, approx_accuracy) for c in need}
        q = _quantile(df, TARGET, clip_quantile, approx_accuracy)
    else:
        # the medians and the clip bound (imputation does not touch the
        # target) come from one set of passes over the stacked columns
        qs = exact_quantiles_many(df, [(c, 0.5, c) for c in need] + [(TARGET, clip_quantile, "_clip")],
                                  materialize_input=False)
        fills = {c: qs.select(c).scalar() for c in need}
        q = qs.select("_clip").scalar()
    if fills:
        df = df.withColumns({c: F.coalesce(F.col(c), m) for c, m in fills.items()})
    return df.select(
        "CustomerID", *FEATURES,
        F.when(F.col(TARGET) > q, q).otherwise(F.col(TARGET)).alias(TARGET),
        F.col(TARGET).alias(TARGET + "_raw"))


def preparation_report(features: DataFrame, clip_quantile: float = 0.99) -> DataFrame:
    """One row of what preparation does: rows read, rows dropped for a missing
    id or target, nulls per feature after coercion, the clip bound and how
    many targets lie above it (the counts the batch job logged)."""
    ensure_checkpoint_dir(features.sparkSession)
    df = map_columns(features)
    require_columns(df, REQUIRED)
    typed = df.select("CustomerID", *[F.col(c).try_cast("double").alias(c) for c in FEATURES],
                      F.col(TARGET).try_cast("double").alias(TARGET)).checkpoint(eager=True)
    kept = typed.dropna(subset=["CustomerID", TARGET])
    q = exact_quantiles(kept, TARGET, [clip_quantile], ["q"], materialize_input=False).scalar()
    return typed.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("CustomerID").isNull() | F.col(TARGET).isNull()).alias("rows_dropped"),
        *[F.count_if(F.col("CustomerID").isNotNull() & F.col(TARGET).isNotNull() & F.col(c).isNull())
           .alias(f"null_{c}") for c in FEATURES],
        F.count_if(F.col("CustomerID").isNotNull() & (F.col(TARGET) > q)).alias("clipped_targets"),
    ).withColumn("clip_bound", q)


def describe(df: DataFrame, column: str, population: bool = False) -> DataFrame:
    """mean, std, min, max of a column, rounded to 2 decimals as reported.

    ``population`` selects the population standard deviation (the
    prediction summary) instead of the sample one (the target summary).
    """
    std = F.stddev_pop if population else F.stddev_samp
    c = F.col(column).cast("double")
    return df.agg(F.round(F.avg(c), 2).alias("mean"), F.round(std(c), 2).alias("std"),
                  F.round(F.min(c), 2).alias("min"), F.round(F.max(c), 2).alias("max"))


# ------------------------------------------------------------------ split

def train_test_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, id_col: str = "CustomerID",
                     materialize_input: bool = True, draw: Column | None = None) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(test_size * n)`` rows, those of least ``draw``
    (a seeded hash of the id unless given) -- the same rows whatever the partitioning."""
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"the test share lies between 0 and 1, both excluded, not {test_size}")
    draw = F.xxhash64(F.lit(seed), F.col(id_col)) if draw is None else draw
    key = [draw.asc(), F.col(id_col).asc()]
    r = global_rank(df, key, "_rank", "_n", materialize_input=materialize_input)
    n_test = F.ceil(F.lit(float(test_size)) * F.col("_n"))
    return r.withColumn("is_test", F.col("_rank") < n_test).drop("_rank", "_n")


def split_sizes(split: DataFrame) -> DataFrame:
    return (split.groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("split"))
                 .agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ search

def sample_param_sets(n_iter: int = 20, seed: int = 42,
                      space: dict | None = None) -> list[dict]:
    """``n_iter`` distinct points of the grid, drawn with a seeded RNG."""
    space = space or PARAM_SPACE
    keys = list(space)
    grid = [dict(zip(keys, vals)) for vals in itertools.product(*(space[k] for k in keys))]
    return random.Random(seed).sample(grid, min(n_iter, len(grid)))


def gbt_params(p: dict) -> dict:
    """Grid point -> GBTRegressor settings.  There is no minimum split size in
    Spark: a node must hold ``min_samples_split`` rows to split, i.e. each
    child at least half of it, so it folds into the per-leaf minimum."""
    leaf = max(int(p["min_samples_leaf"]), math.ceil(int(p["min_samples_split"]) / 2))
    return {"maxIter": int(p["n_estimators"]), "maxDepth": int(p["max_depth"]),
            "stepSize": float(p["learning_rate"]), "minInstancesPerNode": leaf,
            "subsamplingRate": float(p["subsample"])}


def _estimator(seed: int, features: list[str]) -> tuple[Pipeline, GBTRegressor]:
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(featuresCol="features", labelCol=TARGET, lossType="squared", seed=seed)
    return Pipeline(stages=[assembler, gbt]), gbt


# Partitions of a frame a tree learner scans.  The learner draws its subsamples
# partition by partition, so the fitted model depends on which rows share one:
# the number is a parameter of the model (raise it with the cluster), never
# taken from the data or the session.
FIT_PARTITIONS = 8


def placed_for_fitting(df: DataFrame, partitions: int = FIT_PARTITIONS, features: list[str] | None = None) -> DataFrame:
    """Rows hashed by id into a fixed number of partitions and sorted inside, so
    equal rows give an equal model whatever frame they come from."""
    return df.repartition(partitions, "CustomerID").sortWithinPartitions("CustomerID", *(features or FEATURES))


@dataclass
class SearchResult:
    best_params: dict
    best_cv_rmse: float
    table: DataFrame              # one row per sampled parameter set
    trials: int = field(default=0, repr=False)   # fits this call ran; the ledger had the others


class TrialLedger:
    """What finished trials of a search found: one small file for each, in a folder all drivers reach.

    A trial's file is written whole or not at all, under the trial's name, so a trial that
    ran twice counts once.  Trials of other parameters, folds, seeds or rows have other names.
    """

    def __init__(self, spark: SparkSession, path: str, mark: str):
        self.spark, self.path, self.mark = spark, path, mark

    def name(self, params: dict, fold: int) -> str:
        return json.dumps({**{k: params[k] for k in sorted(params)}, "fold": fold, "mark": self.mark}, sort_keys=True)

    def finished(self) -> dict[str, float]:
        files = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not files.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(files):
            return {}
        rows = self.spark.read.schema("trial string, mse double").option("recursiveFileLookup", "true").parquet(self.path)
        return {r["trial"]: r["mse"] for r in rows.collect()}   # as many rows as trials

    def write(self, trial: str, mse: float) -> None:
        own = uuid.uuid5(uuid.NAMESPACE_OID, trial).hex
        row = self.spark.createDataFrame([(trial, mse)], "trial string, mse double")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{own}")


def random_search(train: DataFrame, n_iter: int = 20, num_folds: int = 3, seed: int = 42,
                  parallelism: int = 4, space: dict | None = None,
                  partitions: int = FIT_PARTITIONS, ledger: str | None = None,
                  features: list[str] | None = None, fold: Column | None = None) -> SearchResult:
    """Random search with k-fold CV on mean squared error.

    Folds are ``pmod(xxhash64(seed, id), k)`` unless ``fold`` is given: repeatable.  The
    training frame is placed (``placed_for_fitting``) and written once for the ``n_iter x
    num_folds`` trials.  ``parallelism`` trials run at a time, each in a
    scheduler pool of its own (which shares a cluster fairly under
    ``spark.scheduler.mode=FAIR``).  Every finished trial leaves a row in
    ``ledger``, a folder of the shared file system (by default one below the
    checkpoint folder, named after the training rows and the seed); a search that
    is called again with the same rows, seed and folds runs only the trials that
    are missing there.  Runs its jobs when called.
    """
    spark, features = train.sparkSession, features or FEATURES
    root = ensure_checkpoint_dir(spark)
    sets = sample_param_sets(n_iter, seed, space)
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "CustomerID"), F.lit(num_folds)) if fold is None else fold
    data = placed_for_fitting(train, partitions, features).withColumn("_fold", fold.cast("int")).checkpoint(eager=True)
    # the rows the trials learn from: another table, fold or seed is another search
    rows = data.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("CustomerID", *features, TARGET, "_fold").cast("decimal(38,0)")).alias("h")).first()
    mark = f"{rows['n']}/{rows['h']}/{num_folds}/{seed}/{partitions}"
    book = TrialLedger(spark, ledger or f"{root}/search-{uuid.uuid5(uuid.NAMESPACE_OID, mark).hex}", mark)
    known = book.finished()
    missing = [(p, f) for p in sets for f in range(num_folds) if book.name(p, f) not in known]

    def trial(params: dict, held: int) -> tuple[str, float]:
        name = book.name(params, held)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{held}")
        model = fit(data.filter(F.col("_fold") != held), params, seed, None, features)
        gap = F.col("prediction") - F.col(TARGET)
        mse = model.transform(data.filter(F.col("_fold") == held)).agg(F.avg(gap * gap)).first()[0]
        book.write(name, mse)
        return name, mse

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(trial), p, f) for p, f in missing]
        try:
            known.update(t.result() for t in running)
        finally:
            for t in running:
                t.cancel()
    # a fold without a row, as in a very small table, has no error to count
    folds = [[known[book.name(p, f)] for f in range(num_folds)] for p in sets]
    mse = [sum(e for e in own if e is not None) / max(1, sum(e is not None for e in own)) for own in folds]
    best = min(range(len(mse)), key=lambda i: mse[i])
    table = spark.createDataFrame(
        [(i, *[float(sets[i][k]) for k in PARAM_SPACE], float(mse[i]), float(math.sqrt(mse[i]))) for i in range(len(sets))],
        "draw int, " + ", ".join(f"{k} double" for k in PARAM_SPACE) + ", cv_mse double, cv_rmse double")
    return SearchResult(sets[best], math.sqrt(mse[best]), table, len(missing))


def fit(train: DataFrame, params: dict, seed: int = 42, partitions: int | None = FIT_PARTITIONS,
        features: list[str] | None = None) -> PipelineModel:
    """Fit one parameter set (the refit on all rows uses this too); without ``partitions`` the rows stay where they are."""
    pipe, gbt = _estimator(seed, features or FEATURES)
    placed = train if partitions is None else placed_for_fitting(train, partitions, features)
    return pipe.fit(placed, {getattr(gbt, k): v for k, v in gbt_params(params).items()})


# ------------------------------------------------------------------ evaluation

def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n, rmse, mae, r2 from one aggregate (no second scan).

    R^2 = 1 - SS_res / SS_tot, with SS_tot as n times the population variance,
    which Spark updates from centred sums: labels far from zero lose nothing.
    Exact decimal inputs give exact sums for the errors.
    """
    e = F.col(label) - F.col(prediction)
    s = df.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"),
               F.sum(F.abs(e)).alias("sae"), F.var_pop(F.col(label).cast("double")).alias("var"))
    n = F.col("n").cast("double")
    sse, sae = F.col("sse").cast("double"), F.col("sae").cast("double")
    return s.select("n", F.sqrt(sse / n).alias("rmse"), (sae / n).alias("mae"),
                    (F.lit(1.0) - F.try_divide(sse, F.col("var") * n)).alias("r2"))


def predict(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    """customer_id, clv_prediction, actual (clipped) and raw actual revenue."""
    return model.transform(prepared).select(
        F.col("CustomerID").alias("customer_id"),
        F.col("prediction").alias("clv_prediction"),
        F.col(TARGET).alias("actual_future_6m_revenue"),
        F.col(TARGET + "_raw").alias("raw_future_6m_revenue"))


def clv_quintiles(pred: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """customer_id, clv_prediction, clv_quintile (1 = highest predicted value)."""
    return ntile(pred.select("customer_id", "clv_prediction"), 5,
                 [F.col("clv_prediction").desc(), F.col("customer_id").asc()],
                 "clv_quintile", num_partitions)


# ------------------------------------------------------------------ pipeline

@dataclass
class ClvResult:
    prepared: DataFrame
    search: SearchResult
    test_metrics: DataFrame
    model: PipelineModel
    predictions: DataFrame
    segments: DataFrame


def clv_pipeline(features: DataFrame, test_size: float = 0.2, seed: int = 42,
                 n_iter: int = 20, num_folds: int = 3, parallelism: int = 4,
                 space: dict | None = None, ledger: str | None = None) -> ClvResult:
    """Prepare -> split -> search on train -> test metrics -> refit on all -> score."""
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"the test share lies between 0 and 1, both excluded, not {test_size}")
    prepared = prepare(features)   # reads one checkpointed copy of the features
    split = train_test_split(prepared, test_size, seed, materialize_input=False)
    train = split.filter(~F.col("is_test")).drop("is_test")
    test = split.filter(F.col("is_test")).drop("is_test")
    search = random_search(train, n_iter, num_folds, seed, parallelism, space, ledger=ledger)
    best = fit(train, search.best_params, seed)
    metrics = regression_metrics(best.transform(test), TARGET, "prediction")
    final = fit(prepared, search.best_params, seed)
    pred = predict(final, prepared)
    return ClvResult(prepared, search, metrics, final, pred, clv_quintiles(pred))
