"""Helpers shared by the text operators: reading tables, slicing Arrow batches, hashing, shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one vectorised step works on at a time.
CHUNK_BYTES = 512 << 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="llm-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(rows: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """All rows if there are at most ``limit``, else about 95 % of ``limit`` of them, by a hash of the columns.

    A condition on each row: nothing is sorted, and no more than the sample moves.  Equal
    rows share their fate, so ``limit`` itself guards the bound.
    """
    n = rows.count()
    if n <= limit:
        return rows
    share = int(0.95 * limit / n * (1 << 31))
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(1 << 31)) < share).limit(limit)


def most_frequent(words: DataFrame, limit: int) -> list[tuple]:
    """At most ``limit`` rows (word, n), most frequent first, ties by word.

    A histogram of counts in steps of a sixteenth of an octave (at most a thousand rows)
    gives the least count whose words all fit; only those rows reach the driver, without a sort
    whose partial results would grow with the partitions.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    kept, least = 0, None
    for r in sorted(words.groupBy(step.alias("step")).agg(F.count("*").alias("many")).collect(), reverse=True):
        kept += r["many"]
        if kept > limit:
            break
        least = r["step"]
    if least is None:
        return []
    table = words.where(step >= least).select("word", "n").toArrow()
    return sorted(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once a Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", None) is None:
        top = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="llm-package-")) / f"{top.name}.zip"
        with zipfile.ZipFile(target, "w") as files:
            for path in sorted(top.rglob("*.py")):
                files.write(path, path.relative_to(top.parent))
        sc.addPyFile(str(target))
        sc._llm_shipped = str(target)


def map_arrow(df: DataFrame, apply: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package wherever they run."""
    ship_package(df.sparkSession)
    return df.mapInArrow(apply, schema)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``max_bytes`` of text (or of bytes that a whole-number column states); a longer text stands alone."""
    if not batch.num_rows:
        return
    sizes = np.asarray(_lengths(batch.column(column)), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column if pa.types.is_integer(column.type) else pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def as_strings(values: list[bytes]) -> pa.Array:
    """A string column of bytes that came from strings."""
    return pc.cast(pa.array(values, pa.binary()), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))


def as_texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise uint64 hashes so that all output bits depend on all input bits (in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_tables: dict[np.uint64, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, from a table that grows as needed."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        table[0] = 1
        _tables[base] = table = np.cumprod(table, dtype=np.uint64)
    return table[:n]


class PrefixHash:
    """Polynomial hashes modulo 2 ** 64 of any run of bytes, from sums over prefixes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * powers(_BASE, len(data)), dtype=np.uint64, out=self.sums[1:])
        self.inverse = powers(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal for equal bytes, wherever they stand."""
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]


def segment_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum consecutive runs of the first axis; an empty run sums to zero."""
    out = np.zeros((len(sizes), *values.shape[1:]), dtype=np.float64)
    full = sizes > 0
    if full.any():
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))[full]
        out[full] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out


def runs_to_positions(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, sizes)
