"""CSV sources and the options that readers and writers share.

Quotes inside a quoted field are doubled, as other tools write and read them;
a field may hold commas, backslashes and, with ``multiline`` (the default), line
breaks.  Such a file is still read by many tasks (``splitcsv``); one without
line breaks in its fields is read a little faster with ``multiline=False``.

A missing file, an empty file and a malformed record are three different
errors.  With ``FAILFAST`` a malformed record is an error, not a silent null
row: it surfaces at the first action that reads it, or, with ``validate``, in one
pass of its own when the file is opened.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .splitcsv import read_csv

# blanks at the edges of a field are part of it; Spark's writer would drop them
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def validate_input_file(spark: SparkSession, path: str) -> None:
    if not _exists(spark, path):
        raise FileNotFoundError(f"nothing to read at {path}")


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             validate: bool = False, multiline: bool = True) -> DataFrame:
    """Read a header CSV; without ``schema`` every column is a string.

    ``validate`` parses every column once (one count per column) to report a
    malformed record here, at the price of a second read.
    """
    validate_input_file(spark, path)
    reader = spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST").option("multiLine", multiline)
    reader = reader.option("inferSchema", False) if schema is None else reader.schema(schema)
    try:
        df = reader.csv(path)
    except AnalysisException as e:  # no header to take names from
        raise ValueError(f"{path} holds no header line") from e
    if not df.columns:
        raise ValueError(f"{path} holds no header line")
    if multiline:
        # a line break in a name can hide from Spark that lines end in a carriage return and a line feed
        fields = [T.StructField(f.name.rstrip("\r"), f.dataType) for f in df.schema.fields]
        df = read_csv(spark, path, T.StructType(fields), {**CSV_OPTIONS, "mode": "FAILFAST"})
    if validate:
        try:
            df.agg(*[F.count(F.col(f"`{c}`")) for c in df.columns]).collect()
        except (PySparkException, Py4JJavaError) as e:
            if "MALFORMED" in str(e) or "FAILFAST" in str(e):
                raise ValueError(f"{path} holds a malformed record") from e
            raise  # a lost executor or a refused read is no parse error
    return df


def whole_number(column: str) -> Column:
    """A text as int: ``6`` and ``6.0`` are numbers, other texts an error, null and blank are null."""
    text = F.trim(F.col(column).cast("string"))
    value = text.try_cast("double")
    bad = F.raise_error(F.concat(F.lit(f"column {column} holds no whole number: "), text))
    return (F.when(text.isNull() | (text == ""), F.lit(None).cast("int"))
             .when(value.isNull() | (value != F.floor(value)) | (F.abs(value) > 2**31 - 1), bad.cast("int"))
             .otherwise(value.cast("int")))
