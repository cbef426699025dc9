"""Sinks: atomic replace-table writes, the rules file, predictions and model."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import CSV_OPTIONS

# The rules file's columns, in file order.
RULE_COLUMNS = [
    "antecedent_codes", "consequent_codes", "antecedent_descriptions",
    "consequent_descriptions", "support", "confidence", "lift", "leverage",
    "conviction", "antecedent_len", "consequent_len",
]


RULE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in RULE_COLUMNS[:4]]
    + [T.StructField(c, T.DoubleType()) for c in RULE_COLUMNS[4:9]]
    + [T.StructField(c, T.IntegerType()) for c in RULE_COLUMNS[9:]])


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Read a rules file written by ``save_rules`` with its fixed types."""
    return spark.read.options(**CSV_OPTIONS).option("multiLine", True).schema(RULE_SCHEMA).csv(path)


def replace_table(df: DataFrame, name: str | None = None, path: str | None = None,
                  fmt: str = "parquet", partition_by: list[str] | None = None, keep: int = 2) -> None:
    """``CREATE OR REPLACE TABLE ... AS``: the rows replace a catalog table or the table at a path.

    The rows are written as a new version beside the old ones, and then one pointer is swapped:
    for a path the file ``_current`` in it, which is renamed into place; for a catalog name a view of the
    newest version.  Who reads meanwhile, or after a write that failed, sees the
    old rows; the frame to be written may itself read the table.  The last ``keep``
    versions stay for readers that have begun.  Read a path with ``read_table``.
    """
    spark = df.sparkSession
    if (name is None) == (path is None):
        raise ValueError("give a table name or a path")
    home = path.rstrip("/") if path else _home_of(spark, name)
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(f"{home}/{version}")
    if name is not None:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{home}/{version}`")
    else:
        _point(spark, home, f"{fmt}/{version}")
    fs, root = _file_system(spark, home)
    in_home = lambda part: spark._jvm.org.apache.hadoop.fs.Path(f"{home}/{part}")
    versions = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v"))
    versions = [v for v in versions if v <= version]   # a later one is still being written
    whole = [v for v in versions if fs.exists(in_home(f"{v}/_SUCCESS"))] or versions   # what a failed write left counts for nothing
    for gone in versions[: versions.index(whole[-min(len(whole), max(1, keep))])]:
        fs.delete(in_home(gone), True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the table at a path that ``replace_table`` has written."""
    fs, root = _file_system(spark, path.rstrip("/"))
    pointer = spark._jvm.org.apache.hadoop.fs.Path(root, "_current")
    if not fs.exists(pointer):
        raise FileNotFoundError(f"no table has been written at {path}")
    stream = fs.open(pointer)
    try:
        fmt, version = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("/")
    finally:
        stream.close()
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{version}")


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _home_of(spark: SparkSession, name: str) -> str:
    """The folder of a catalog name's versions, in its database's location."""
    database, _, table = name.rpartition(".")
    row = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").filter("lower(info_name) = 'location'").first()
    return f"{row['info_value'].rstrip('/')}/{table}.versions"


def _point(spark: SparkSession, home: str, target: str) -> None:
    """Write the pointer beside its place and rename it into place, which replaces the old one in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, root = _file_system(spark, home)
    fresh = hadoop.Path(root, f"_next-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(target.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(fresh, hadoop.Path(root, "_current"), options)


def save_rules(rules: DataFrame, path: str, header: bool = True) -> None:
    """Rules file: the fixed 11 columns, sorted by lift then confidence (desc).

    The sort is a range-partitioned global sort; files are written in
    partition order so a reader concatenating part files sees sorted rows.
    """
    (rules.select(*RULE_COLUMNS)
          .orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                   "antecedent_codes", "consequent_codes")
          .write.mode("overwrite").options(**CSV_OPTIONS).option("header", header).csv(path))


def save_predictions(pred: DataFrame, path: str, fmt: str = "csv") -> None:
    w = pred.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    else:
        w.format(fmt).save(path)


def save_model(model, path: str) -> None:
    """Spark ML persistence (directory of metadata + parquet tree data)."""
    model.write().overwrite().save(path)
