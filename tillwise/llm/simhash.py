"""SimHash near-duplicates, compared in bit slices.

Fingerprint: words of the ASCII lower-cased text, shingles of ``SHINGLE`` words (repeats
included), XXH64 of each with seed 42, one bit where over half of the hashes have it.

Equal fingerprints are merged first (combined before the shuffle).  Distinct fingerprints
within ``radius`` bits agree on ``PARTS - radius`` of ``PARTS`` equal runs of bits, so every
such combination is a key under which candidates meet: no link is lost.  Keys held by one
fingerprint only are dropped; a key held by many is split into lanes of about ``LANE``
fingerprints, and pairs of lanes are compared in tasks of their own.

A task turns its fingerprints into vertical bit planes and counts differing bits of 64 pairs
at once in carry-save counters; words in which every pair is beyond the radius are abandoned
after each ``STEP`` planes.  It returns a spanning star of each local component instead of
all pairs.  Components of the stars are found by Spark.

Defined cases: a text that is null, empty or blank has fingerprint zero and links like any
other; repeated rows share a component and each get a row; a component id is the smallest id
in it (null only if all its ids are null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import as_bytes, map_arrow, segment_sums, slices, stored
from tillwise.llm.components import components

#: Words a shingle; largest distance that links; hash seed.
SHINGLE, RADIUS, SEED = 3, 2, 42
#: Runs of bits for the keys; fingerprints of one lane; largest group compared by shifts; planes between abandonments.
PARTS, LANE, SMALL, STEP = 4, 256, 32, 8
_BATCH = 1 << 15
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# fingerprints -------------------------------------------------------------------------------


def shingle_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    ends = [*(s - 1 for s in starts[shingle:]), len(joined)]
    hashed = xxhash.xxh64_intdigest
    return [hashed(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)]


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprint of each text."""
    hashes = [shingle_hashes(t, shingle) for t in texts]
    sizes = np.fromiter(map(len, hashes), dtype=np.int64, count=len(hashes))
    flat = np.fromiter((h for one in hashes for h in one), dtype=np.uint64, count=int(sizes.sum()))
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(texts), 64), dtype=np.uint8)
    full = np.flatnonzero(sizes)
    starts = np.cumsum(sizes) - sizes
    for k in full:
        one = bits[starts[k] : starts[k] + sizes[k]]
        out[k] = one.sum(axis=0, dtype=np.int32) * 2 > sizes[k]
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64).ravel()


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and the fingerprint as a signed long, which replaces a column of that name."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != out]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                values = fingerprints(as_bytes(part.column(text)), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(values)], [*kept, out])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.LongType())])
    return map_arrow(docs.select(*dict.fromkeys([*kept, text])), apply, schema)


# bit-sliced comparison ----------------------------------------------------------------------


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit b of value i is bit i % 64 of word i // 64 of plane b."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def lanes_within(plane: Callable[[int, np.ndarray], np.ndarray], words: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, mask) of the words that hold a lane at most ``radius`` away; ``plane(b, index)`` gives difference bits."""
    at = np.arange(words)
    depth = max(1, int(radius).bit_length())
    count = [np.zeros(words, dtype=np.uint64) for _ in range(depth)]
    over = np.zeros(words, dtype=np.uint64)

    def beyond() -> np.ndarray:
        """Lanes whose counter exceeds the radius."""
        more, same = np.zeros(len(at), dtype=np.uint64), np.full(len(at), _ALL)
        for k in reversed(range(depth)):
            if radius >> k & 1:
                same &= count[k]
            else:
                more |= same & count[k]
                same &= ~count[k]
        return over | more

    for first in range(0, 64, STEP):
        for b in range(first, first + STEP, 2):
            x, y = plane(b, at), plane(b + 1, at)
            # carry-save: two planes and the lowest counter bit give a sum and a carry
            part = count[0] ^ x
            carry = (count[0] & x) | (part & y)
            count[0] = part ^ y
            for k in range(1, depth):
                carry, count[k] = count[k] & carry, count[k] ^ carry
            over |= carry
        open_ = beyond() != _ALL
        if not open_.all():
            at, over, count = at[open_], over[open_], [c[open_] for c in count]
            if not len(at):
                break
    return at, ~beyond()


def _set_bits(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.unpackbits(masks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.nonzero(bits)


def pairs_by_shift(values: np.ndarray, group: np.ndarray, largest: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs within many small groups at once: all values against themselves shifted by 1, 2, ..."""
    planes = bit_planes(values)
    planes = np.concatenate((planes, np.zeros((64, 1), dtype=np.uint64)), axis=1)
    left, right = [], []
    for shift in range(1, largest):
        low, high = np.uint64(shift % 64), np.uint64((64 - shift) % 64)
        moved = planes[:, :-1] >> low if not shift % 64 else (planes[:, :-1] >> low) | (planes[:, 1:] << high)
        own = planes[:, :-1]
        at, mask = lanes_within(lambda b, k, own=own, moved=moved: own[b, k] ^ moved[b, k], own.shape[1], radius)
        word, bit = _set_bits(mask)
        i = at[word] * 64 + bit
        i = i[i + shift < len(values)]
        i = i[group[i] == group[i + shift]]
        left.append(i)
        right.append(i + shift)
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def pairs_across(queries: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked (query, value) positions: every query against the planes of all values."""
    planes = bit_planes(values)
    words = planes.shape[1]
    sign = [np.where(queries >> np.uint64(b) & np.uint64(1), _ALL, np.uint64(0)) for b in range(64)]
    at, mask = lanes_within(lambda b, k: planes[b, k % words] ^ sign[b][k // words], len(queries) * words, radius)
    word, bit = _set_bits(mask)
    q, v = at[word] // words, at[word] % words * 64 + bit
    return q[v < len(values)], v[v < len(values)]


def _least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node connected to it by the pairs."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _local_edges(group: np.ndarray, lane: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star of each component that the links of the groups make; ``lane``: 0 and 1 are compared with each other, 2 within itself."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, len(group)))
    small = np.repeat((sizes <= SMALL) & (lane[starts] == 2), sizes)
    found_i, found_j = [], []
    if small.any():
        where = np.flatnonzero(small)
        i, j = pairs_by_shift(values[where], group[where], int(sizes[sizes <= SMALL].max()), radius)
        found_i.append(where[i])
        found_j.append(where[j])
    for start, size in zip(starts[~small[starts]], sizes[~small[starts]], strict=True):
        own = np.arange(start, start + size)
        one, two = (own, own) if lane[start] == 2 else (own[lane[own] == 0], own[lane[own] == 1])
        if len(one) and len(two):
            i, j = pairs_across(values[one], values[two], radius)
            found_i.append(one[i])
            found_j.append(two[j])
    if not found_i:
        return values[:0], values[:0]
    label = _least_labels(len(values), np.concatenate(found_i), np.concatenate(found_j))
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


# linking with Spark -------------------------------------------------------------------------


def _keys(radius: int, parts: int) -> F.Column:
    """An array of keys: every choice of parts - radius runs of bits, with the number of the choice."""
    edges = [64 * k // parts for k in range(parts + 1)]
    runs = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    choices = list(combinations(range(parts), parts - radius))
    if parts <= radius:
        raise ValueError("more parts than the radius are needed")
    return F.array(*(F.xxhash64(F.lit(n), *(runs[k] for k in choice)) for n, choice in enumerate(choices)))


def links(distinct: DataFrame, radius: int = RADIUS, parts: int = PARTS, lane: int = LANE) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints ``fp`` within the radius."""
    keyed = distinct.select("fp", F.explode(_keys(radius, parts)).alias("key"))
    # written first: a join with an aggregate of the same stage could not split a hot key
    held = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = keyed.join(held, "key").select("key", "fp", F.ceil(F.col("n") / lane).alias("lanes"))
    own = F.pmod(F.xxhash64("fp", F.lit("lane")), F.col("lanes"))
    spread = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lanes") - 1)))
    spread = spread.select("key", "fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own")
    side = F.when(F.col("lo") == F.col("hi"), 2).when(F.col("own") == F.col("lo"), 0).otherwise(1).cast("int").alias("side")
    dealt = spread.select("key", "lo", "hi", side, "fp").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def edges(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, lo, hi, side, fp = columns
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
            u, v = _local_edges(np.cumsum(new), side, fp.view(np.uint64), radius)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                columns = [c.to_numpy(zero_copy_only=False) for c in part.columns]
                if rest is not None:
                    columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
                # the last group may go on in the next batch
                same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
                cut = int(np.argmax(same))
                if cut:
                    yield from edges([c[:cut] for c in columns])
                rest = [c[cut:].copy() for c in columns]
        if rest is not None:
            yield from edges(rest)

    return map_arrow(dealt, compare, "u bigint, v bigint")


def groups(fingerprinted: DataFrame, radius: int = RADIUS, id_column: str = "doc_id", fingerprint: str = "fingerprint", row: str | None = None) -> DataFrame:
    """(fp, component_id, keeper) of each distinct fingerprint; keeper: among the rows of the component's smallest id the least value of ``row`` (default: fingerprint)."""
    own = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(row or fingerprint).alias("row"))
    distinct = stored(fingerprinted.groupBy(F.col(fingerprint).alias("fp")).agg(F.min(own).alias("least")))
    roots = components(links(distinct.select("fp"), radius))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("least"))
    return linked.select("fp", "root").join(least, "root").select("fp", F.col("least.id").alias("component_id"), F.col("least.row").alias("keeper"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row a document: id, fingerprint (16 hex digits) and component_id."""
    marked = stored(with_fingerprint(docs.select(id_column, text), text, "fingerprint", shingle, keep=[id_column]))
    found = groups(marked, radius, id_column).select(F.col("fp").alias("fingerprint"), "component_id")
    return marked.join(found, "fingerprint").select(id_column, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row of each component (that of the smallest id), with the columns of ``docs``."""
    fp, row = "_simhash_fingerprint", "_simhash_row"
    # the row number is written with the rows, so it is the same in every later read
    marked = stored(with_fingerprint(docs, text, fp, shingle).withColumn(row, F.monotonically_increasing_id()))
    kept = groups(marked.select(id_column, fp, row), radius, id_column, fp, row).select(F.col("keeper").alias(row)).distinct()
    return marked.join(kept, row, "left_semi").select(*docs.columns)
