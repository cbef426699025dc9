"""Vector code compression: product codes whose nearest entries are found by sliced, intersected bitmasks.

A vector of whole numbers is cut into ``PARTS`` parts; every part has a codebook of ``ENTRIES`` entries, and a
code is the index of the nearest entry of each part (squared Euclidean distance, ties to the lower index).

The search of a codebook keeps, for each dimension, the entries' coordinates sorted, with a prefix
mask before every place: the bit set of the entries up to it.  The distance to the entry whose
coordinate is nearest in the dimension of widest spread is the initial radius: no nearer entry lies outside the box
of that radius.  In each dimension the box is a range of the sorted coordinates, found by
binary search; its entries are the difference of two prefix masks.  The masks of all dimensions ANDed (uint64
words, as many as the entries need) leave exactly the entries in the box, and only those are
measured.

The codebooks learn in ``ROUNDS`` rounds.  Tasks add up the parts of each entry they have read, Spark
adds the sums of the tasks, and the driver holds codebooks only: entries times dimensions numbers, however many
vectors there are.  All numbers are whole, so sums do not depend on their order; where 64 bits could be
too few (components beyond ``NARROW``) the same steps run on Python's integers and sums travel as text.

Defined cases: vectors that are null or hold null or non-finite components are dropped; rows of equal id
count as one row each; a null id comes after all others when the codebooks start; equal ids are ordered
by their components; fewer vectors than entries leave a smaller codebook; vectors of another
length have codebooks of their own; parts differ by one component where the length is not divisible (the
first ones are longer), and parts without components have distance 0; an error beyond 64 bits is told as
the largest long; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import map_arrow, shuffle_partitions, stored

#: Whole steps a unit, parts of a vector, entries of a codebook (at most 256), rounds of learning.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Largest component for which 64 bits hold every sum and distance; vectors coded at once.
NARROW, ROWS = 1 << 24, 4096
_LONG = (1 << 63) - 1

Books = dict[int, list[np.ndarray]]  # length of a vector -> a codebook (entries, components) for each part


def usable(vectors: DataFrame, embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows whose vector has finite components only, with ``_dim`` and ``_steps`` (whole numbers, as doubles)."""
    finite = F.forall(F.col(embedding), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.where(F.col(embedding).isNotNull() & finite)
    # floor of a double stays a double here: a long would clamp it
    step = F.transform(F.col(embedding), lambda e: F.lit(float(scale)) * e.cast("double"))
    return rows.withColumns({"_dim": F.size(embedding), "_steps": step})


def _whole(steps: np.ndarray, wide: bool) -> np.ndarray:
    """Floors as 64-bit integers, or as Python's."""
    floors = np.floor(steps)
    return np.array([int(v) for v in floors.ravel().tolist()], dtype=object).reshape(floors.shape) if wide else floors.astype(np.int64)


def _edges(dim: int, parts: int) -> list[tuple[int, int]]:
    cut = [0]
    for k in range(parts):
        cut.append(cut[-1] + dim // parts + (k < dim % parts))
    return list(zip(cut[:-1], cut[1:], strict=True))


class SlicedCodebook:
    """Nearest entry by intersecting, over all dimensions, the entries of a slice of sorted coordinates."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, dims = entries.shape
        self.words = max(1, -(-count // 64))
        self.sorted, self.prefix = [], []
        for d in range(dims):
            order = np.argsort(entries[:, d], kind="stable")
            masks = np.zeros((count + 1, self.words), dtype=np.uint64)
            for place, entry in enumerate(order.tolist()):
                masks[place + 1] = masks[place]
                masks[place + 1, entry // 64] |= np.uint64(1 << (entry % 64))
            self.sorted.append(entries[order, d])
            self.prefix.append(masks)
        spread = [own[-1] - own[0] for own in self.sorted]
        self.widest = spread.index(max(spread)) if spread else None
        self.order = np.argsort(entries[:, self.widest], kind="stable") if spread else np.zeros(count, dtype=np.int64)

    def _distance(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        gap = x - entries
        return (gap * gap).sum(axis=1) if gap.shape[1] else np.zeros(len(gap), dtype=x.dtype)

    def _radius(self, squared: np.ndarray) -> np.ndarray:
        """Least whole number whose square is no less."""
        if squared.dtype == object:
            return np.array([math.isqrt(s - 1) + 1 if s else 0 for s in squared.tolist()], dtype=object)
        root = np.ceil(np.sqrt(squared.astype(np.float64))).astype(np.int64)
        return root + (root * root < squared)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """(rows, words): bits of the entries whose coordinates all lie within ``radius`` of the row's."""
        masks = None
        for d, (coordinates, prefix) in enumerate(zip(self.sorted, self.prefix, strict=True)):
            low = np.searchsorted(coordinates, x[:, d] - radius, side="left")
            high = np.searchsorted(coordinates, x[:, d] + radius, side="right")
            inside = prefix[high] ^ prefix[low]
            masks = inside if masks is None else masks & inside
        if masks is None:  # no dimensions: every entry is as near as any
            masks = np.full((len(x), self.words), ~np.uint64(0))
        return masks

    def _guess(self, x: np.ndarray) -> np.ndarray:
        """The entry nearest in the dimension of widest spread."""
        if self.widest is None:
            return np.zeros(len(x), dtype=np.int64)
        own, at = self.sorted[self.widest], x[:, self.widest]
        high = np.minimum(np.searchsorted(own, at), len(own) - 1)
        low = np.maximum(high - 1, 0)
        return self.order[np.where(np.abs(at - own[low]) <= np.abs(own[high] - at), low, high)]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row."""
        index = self._guess(x)
        best = self._distance(x, self.entries[index])
        masks = self.candidates(x, self._radius(best))
        for k in range(len(self.entries)):
            rows = np.flatnonzero((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1))
            rows = rows[index[rows] != k]
            if not len(rows):
                continue
            found = self._distance(x[rows], self.entries[k])
            nearer = (found < best[rows]) | ((found == best[rows]) & (k < index[rows]))
            index[rows[nearer]], best[rows[nearer]] = k, found[nearer.astype(bool)]
        return index, best


class Coder:
    """Codebooks of every length of vectors."""

    def __init__(self, books: Books):
        self.books = {dim: [SlicedCodebook(b) for b in own] for dim, own in books.items()}
        self.edges = {dim: _edges(dim, len(own)) for dim, own in books.items()}

    def code(self, dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) of indices, and of squared distances."""
        found = [book.nearest(x[:, a:b]) for book, (a, b) in zip(self.books[dim], self.edges[dim], strict=True)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _rows(batch: pa.RecordBatch, wide: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, whole components) of runs of ``ROWS`` rows at most."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        for at in range(0, len(own), ROWS):
            rows = own[at : at + ROWS]
            steps = batch.column("steps").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            yield dim, rows, _whole(steps.reshape(len(rows), dim), wide)


SUMS = "dim int, part int, entry int, n bigint, sums array<{}>"


def _sums(steps: DataFrame, coder: Coder, wide: bool) -> list:
    """For every entry that has parts with components: ((dim, part, entry), n, sums by component)."""
    spark = steps.sparkSession
    shared = spark.sparkContext.broadcast(coder)
    kind = pa.string() if wide else pa.int64()

    def told(held: dict) -> pa.RecordBatch:
        keys = sorted(held)
        sums = [[str(v) if wide else int(v) for v in held[k][1]] for k in keys]
        columns = [*(pa.array([k[c] for k in keys], pa.int32()) for c in range(3)), pa.array([held[k][0] for k in keys], pa.int64()), pa.array(sums, pa.list_(kind))]
        return pa.RecordBatch.from_arrays(columns, ["dim", "part", "entry", "n", "sums"])

    def add(held: dict, key: tuple, n: int, sums: np.ndarray) -> None:
        own = held.setdefault(key, [0, 0])
        own[0], own[1] = own[0] + n, own[1] + sums

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = shared.value, {}
        for batch in batches:
            for dim, _, x in _rows(batch, wide):
                index, _ = own.code(dim, x)
                for p, (a, b) in enumerate(own.edges[dim]):
                    for entry in np.unique(index[:, p]).tolist():
                        rows = index[:, p] == entry
                        add(held, (dim, p, entry), int(rows.sum()), x[rows, a:b].sum(axis=0))
        yield told(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                add(held, (row["dim"], row["part"], row["entry"]), row["n"], np.array([int(v) for v in row["sums"]], dtype=object))
        yield told(held)

    parts = map_arrow(steps, apply, SUMS.format("string" if wide else "bigint"))
    if wide:
        rows = map_arrow(parts.repartition(shuffle_partitions(spark), "dim", "part", "entry"), merge, SUMS.format("string")).collect()
        return [((r["dim"], r["part"], r["entry"]), r["n"], [int(v) for v in r["sums"]]) for r in rows]
    places = parts.select("dim", "part", "entry", "n", F.posexplode("sums").alias("place", "value"))
    summed = places.groupBy("dim", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()
    by_entry: dict[tuple, list] = {}
    for r in sorted(summed, key=lambda r: r["place"]):
        by_entry.setdefault((r["dim"], r["part"], r["entry"]), [r["n"]]).append(r["value"])
    return [(key, n, sums) for key, (n, *sums) in by_entry.items()]


def _start(rows: DataFrame, vec_id: str, parts: int, entries: int, wide: bool) -> Books:
    """The parts of the vectors of smallest id, for each length."""
    order = Window.partitionBy("dim").orderBy(F.col(vec_id).asc_nulls_last(), "steps")
    first = rows.select("dim", vec_id, "steps").withColumn("at", F.row_number().over(order)).where(F.col("at") <= entries).orderBy("dim", "at").collect()
    by_dim: dict[int, list] = {}
    for r in first:
        by_dim.setdefault(r["dim"], []).append(r["steps"])
    return {dim: [_whole(np.array(own, dtype=np.float64).reshape(len(own), dim)[:, a:b], wide) for a, b in _edges(dim, parts)] for dim, own in by_dim.items()}


def fit(steps: DataFrame, vec_id: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, wide: bool = False) -> Books:
    """Codebooks of stored rows (``vec_id``, dim, steps)."""
    books = _start(steps, vec_id, parts, entries, wide)
    for _ in range(rounds if books else 0):
        for (dim, part, entry), n, sums in _sums(steps.select("dim", "steps"), Coder(books), wide):
            books[dim][part][entry] = [v // n for v in sums]  # goes down for negative sums, too
    return books


def digest(books: Books) -> str:
    """SHA-256 of all components in decimal, by length, part, entry and position, joined by commas."""
    numbers = (str(int(v)) for _, own in sorted(books.items()) for book in own for v in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def with_group_totals(rows: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """``total``: the sum of ``value`` over the rows of equal ``key``, nulls together.

    Keys of over a 4,096th of the rows are few, so their totals are broadcast; no other key is
    large enough to hold up a shuffled join.
    """
    sums = stored(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(F.col(value).cast("decimal(38,0)")).alias("_sum"), F.count("*").alias("_n")))
    n = sums.agg(F.sum("_n")).first()[0] or 0
    told = F.least(F.col("_sum"), F.lit(_LONG).cast("decimal(38,0)")).cast("bigint")
    hot = F.broadcast(sums.where(F.col("_n") > n // 4096).select(F.col("_key").alias("_hot"), told.alias("_hot_total"), F.lit(True).alias("_is_hot")))
    marked = rows.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left")
    rest = sums.where(F.col("_n") <= n // 4096).select("_key", told.alias("_rest_total"))
    common = marked.where(F.col("_is_hot")).withColumn(total, F.col("_hot_total")).select(*rows.columns, total)
    others = marked.where(F.col("_is_hot").isNull()).join(rest, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(total, F.col("_rest_total")).select(*rows.columns, total)
    return common.unionByName(others)


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Books]:
    """(``vec_id``, ``label``, code, error, label_error) of every usable row, and the final codebooks.

    ``code`` has two hex digits a part, ``error`` is the squared distance to the code's entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = stored(usable(vectors, embedding, scale).select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col("_dim").alias("dim"), F.col("_steps").alias("steps")))
    widest = rows.select(F.max(F.aggregate("steps", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))).first()[0] or 0.0
    wide = widest >= NARROW
    books = fit(rows, "vec_id", parts, entries, rounds, wide)
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(Coder(books))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in batches:
            for dim, at, x in _rows(batch, wide):
                index, squared = coder.code(dim, x)
                errors = [min(_LONG, int(e)) for e in squared.sum(axis=1).tolist()]
                digits = index.astype(np.uint8).tobytes().hex()
                width = 2 * parts
                codes = [digits[k * width : (k + 1) * width] for k in range(len(at))]
                own = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(own), batch.column("label").take(own), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = stored(map_arrow(rows, apply, schema))
    return with_group_totals(coded, "label", "error", "label_error"), books
