"""Best-fit packing of tokenised documents into sequences of one length.

A document is cut into pieces of at most ``LENGTH`` tokens, and every task packs the pieces of its
documents online: a piece goes to the open bin whose free space fits it best.  At most
``OPEN_BINS`` bins are open.  A bitset has one bit for each free space that some open bin has, so
the best fit is the lowest bit at or above the piece's length, and the bin to close when a new one
is needed, the fullest, is the lowest bit of all.  Pieces wait in a buffer of ``BUFFER`` tokens and
enter longest first.

A piece is told when its bin closes, so a task holds the pieces of its open bins.  Bins that are
open when it ends are packed again, as they are, with those of ``FAN_IN`` tasks, then with those of as
many groups, until one group is left; each task of these levels reads at most ``FAN_IN * OPEN_BINS``
rows, and only the pieces of those bins are shuffled.

Tokens come from the ``tokenizers`` library, word by word: normaliser and splitter of the
vocabulary never look across white space, so a text has the ids of its words, one after the other.
For the same reason case does not matter, a stop or comma behind an ASCII letter or digit is a token
of its own, and a word of lower-case ASCII letters goes to the library's merges as it is.

Defined cases: a null text counts as empty and is the end token alone; rows that repeat are packed as
often as they come in; rows of a null id keep it; an empty table gives no rows; columns that have the name
of a result are replaced; a text of any length is cut into pieces, only the last of which is shorter.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import as_bytes, map_arrow, shuffle_partitions, slices, stored

#: Tokens of a sequence; bins open at once; tokens that wait to be packed longest first; open lists packed again together.
LENGTH, OPEN_BINS, BUFFER, FAN_IN = 4096, 256, 1 << 20, 8
#: Token that ends a document.
END = 1
#: Longest word whose ids are remembered, and words remembered in each of two generations.
WORD_BYTES, HELD_WORDS = 64, 1 << 19

PLACED = ["piece", "start", "length", "ids", "sequence_id", "offset"]


class WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit integers; remembers a bounded number of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(word) <= WORD_BYTES:
            if len(self) >= HELD_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _encode(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters, in lower case
            found = [t.id for t in self.tokenizer.model.tokenize(word.decode())]
        elif word[-1] in b".,;:!?" and word[:-1].isalnum():
            return self[word[:-1]] + self[word[-1:]]
        else:
            found = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def of(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.lower().split()))


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The ids of a vocabulary file, kept by a Python worker for its next task."""
    if path not in _known:
        _known.clear()
        _known[path] = WordIds(path)
    return _known[path]


class OpenBins:
    """A fixed number of open bins, found by free space."""

    def __init__(self, size: int, most: int, first_id: int = 0):
        self.size, self.most, self.next_id = size, most, first_id
        self.spaces = 0  # bit f: some open bin has f free
        self.by_space: dict[int, list[int]] = {}
        self.open = 0
        self.closed: list[int] = []  # since the caller last cleared it

    def _take(self, space: int) -> int:
        own = self.by_space[space]
        bin_ = own.pop()
        if not own:
            del self.by_space[space]
            self.spaces ^= 1 << space
        self.open -= 1
        return bin_

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of the next piece."""
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(space)
        else:
            space, bin_ = self.size, self.next_id
            self.next_id += 1
            if self.open >= self.most and length < space:
                self.closed.append(self._take((self.spaces & -self.spaces).bit_length() - 1))  # the fullest closes
        left = space - length
        if left:
            self.by_space.setdefault(left, []).append(bin_)
            self.spaces |= 1 << left
            self.open += 1
        else:
            self.closed.append(bin_)
        return bin_, self.size - space

    def rest(self) -> Iterator[tuple[int, int]]:
        """(bin, tokens in it) of the bins still open."""
        for space, own in self.by_space.items():
            for bin_ in own:
                yield bin_, self.size - space


def _pieces(ids: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, number in it, length) of each piece."""
    tokens = np.array([len(b) // 4 for b in ids], dtype=np.int64)
    counts = -(-tokens // size)
    of = np.repeat(np.arange(len(ids)), counts)
    number = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return of, number, np.minimum(size, tokens[of] - number * size)


class Packer:
    """Packs the pieces of one task; hands on the pieces of every bin that has closed."""

    def __init__(self, bins: OpenBins, kept: list[str]):
        self.bins, self.kept, self.task = bins, kept, bins.next_id
        self.held: dict[int, list[tuple]] = {}  # bin -> (rows, row, piece, length, ids, offset)
        self.waiting: list[tuple] = []  # (rows, row, piece, length, ids)
        self.tokens = 0

    def add(self, rows: pa.RecordBatch, ids: list[bytes]) -> None:
        size = self.bins.size
        for of, number, n in zip(*(a.tolist() for a in _pieces(ids, size)), strict=True):
            self.waiting.append((rows, of, number, n, ids[of][4 * size * number : 4 * size * (number + 1)]))
            self.tokens += n

    def pack(self) -> Iterator[pa.RecordBatch]:
        """Place what waits, longer pieces first."""
        self.waiting.sort(key=lambda w: -w[3])
        for one in self.waiting:
            bin_, offset = self.bins.put(one[3])
            self.held.setdefault(bin_, []).append((*one, offset))
        self.waiting, self.tokens = [], 0
        yield from self._told([(bin_, *one) for bin_ in self.bins.closed for one in self.held.pop(bin_)], None)
        self.bins.closed.clear()

    def end(self) -> Iterator[pa.RecordBatch]:
        """The pieces of the bins still open, with the tokens of their bin."""
        fill = dict(self.bins.rest())
        yield from self._told([(bin_, *one) for bin_, own in self.held.items() for one in own], fill)

    def _told(self, pieces: list[tuple], fill: dict[int, int] | None) -> Iterator[pa.RecordBatch]:
        by_rows: dict[int, list[tuple]] = {}
        for one in pieces:
            by_rows.setdefault(id(one[1]), []).append(one)
        for own in by_rows.values():
            bins, rows, of, number, lengths, ids, offsets = zip(*own, strict=True)
            kept = rows[0].take(pa.array(of, pa.int64()))
            start = [k * self.bins.size for k in number]
            columns = [pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())]
            filled = pa.nulls(len(own), pa.int64()) if fill is None else pa.array([fill[b] for b in bins], pa.int64())
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in self.kept), *columns, filled], [*self.kept, *PLACED, "fill"])


def _packer(path: str, end: int, size: int, open_bins: int, buffer: int, kept: list[str]) -> Callable:
    last = struct.pack("<I", end)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer = word_ids(path), None
        for batch in batches:
            for part in slices(batch, "text"):
                if packer is None:
                    packer = Packer(OpenBins(size, open_bins, part.column("task")[0].as_py() << 32), kept)
                packer.add(part.select([*kept, "task"]), [known.of(t) + last for t in as_bytes(part.column("text"))])
                if packer.tokens >= buffer:
                    yield from packer.pack()
        if packer is not None:
            yield from packer.pack()
            yield from packer.end()

    return apply


def _packed_again(open_: DataFrame, size: int, open_bins: int, fan_in: int) -> DataFrame:
    """(bin, into, offset, fill, group, still): where each open bin goes when ``fan_in`` groups are packed together."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bins = None, None
        rows: list[tuple[int, int]] = []

        def told() -> pa.RecordBatch:
            # the bin that comes first in a merged one gives it its number
            bins = OpenBins(size, open_bins)
            places = [bins.put(n) for _, n in rows]
            first = {b: own for (own, _), (b, offset) in zip(reversed(rows), reversed(places), strict=True) if not offset}
            fill: dict[int, int] = {}
            for (_, n), (b, _) in zip(rows, places, strict=True):
                fill[b] = fill.get(b, 0) + n
            still = {b for b, _ in bins.rest()}
            columns = [[own for own, _ in rows], [first[b] for b, _ in places], [o for _, o in places], [fill[b] for b, _ in places], [now] * len(rows), [b in still for b, _ in places]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["bin", "into", "offset", "fill", "group", "still"])

        for batch in batches:
            for own, n, group in zip(*(batch.column(c).to_pylist() for c in ("bin", "fill", "group")), strict=True):
                if group != now and rows:
                    yield told()
                    rows.clear()
                now = group
                rows.append((own, n))
        if rows:
            yield told()

    grouped = open_.withColumn("group", F.floor(F.col("group") / fan_in).cast("bigint"))
    dealt = grouped.repartition(shuffle_partitions(open_.sparkSession), "group").sortWithinPartitions("group", F.desc("fill"), "bin")
    return stored(map_arrow(dealt.select("bin", "fill", "group"), apply, "bin bigint, into bigint, offset bigint, fill bigint, group bigint, still boolean"))


def _moved(open_: DataFrame, size: int, open_bins: int, fan_in: int) -> DataFrame | None:
    """(bin, into, shift) of the open bins that were put into another one."""
    moved = None
    while True:
        packed = _packed_again(open_, size, open_bins, fan_in)
        step = packed.where("bin <> into").select("bin", "into", F.col("offset").alias("shift"))
        if moved is None:
            moved = step
        else:
            then = step.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("shift").alias("more"))
            before = moved.join(then, "into", "left").select("bin", F.coalesce("next", "into").alias("into"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
            moved = before.union(step)
        open_ = packed.where(F.col("still") & (F.col("bin") == F.col("into"))).select("bin", "fill", "group")
        groups = open_.agg(F.max("group")).first()[0]
        if not groups:
            return moved


def pack(docs: DataFrame, path: str, text: str = "text", end: int = END, size: int = LENGTH, open_bins: int = OPEN_BINS, buffer: int = BUFFER, fan_in: int = FAN_IN) -> DataFrame:
    """One row a piece: the other columns of ``docs``, piece, start, length, ids, sequence_id, offset.

    ``path`` names a vocabulary file of the ``tokenizers`` library whose splitter never joins words.
    ``ids`` are little-endian unsigned 32-bit integers; a sequence holds its pieces gapless from offset 0.
    """
    keep = [c for c in docs.columns if c != text and c not in PLACED]
    hidden = [f"kept{k}" for k in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(h) for c, h in zip(keep, hidden, strict=True)), F.col(text).cast("string").alias("text"), F.spark_partition_id().cast("bigint").alias("task"))
    schema = T.StructType(
        [
            *(T.StructField(h, docs.schema[c].dataType) for c, h in zip(keep, hidden, strict=True)),
            *T._parse_datatype_string("piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint, fill bigint").fields,
        ]
    )
    packed = stored(map_arrow(rows, _packer(path, end, size, open_bins, buffer, hidden), schema))
    left_open = packed.where("fill IS NOT NULL")
    open_ = left_open.groupBy(F.col("sequence_id").alias("bin")).agg(F.max("fill").alias("fill")).withColumn("group", F.shiftright("bin", 32))
    moved = _moved(open_, size, open_bins, fan_in).withColumnRenamed("bin", "sequence_id")
    placed = left_open.join(moved, "sequence_id", "left").withColumns(
        {"sequence_id": F.coalesce("into", "sequence_id"), "offset": F.col("offset") + F.coalesce("shift", F.lit(0))}
    )
    columns = [*hidden, *PLACED]
    return packed.where("fill IS NULL").select(*columns).union(placed.select(*columns)).toDF(*keep, *PLACED)
