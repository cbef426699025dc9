"""Byte-level BPE encoding and decoding of whole texts with a public rank file.

A text is split by the tokenizer's pattern.  Pieces that are tokens themselves map
straight to their rank; the others go, each distinct piece once, through padded numpy
matrices bucketed by length: in every round each row merges its leftmost pair of minimum
rank, found through an open-addressing hash table of pairs, and is compacted by one column.
Pieces longer than ``MATRIX_BYTES`` (unbroken runs of thousands of letters) would make wide
sparse matrices, so they merge in the same order on a linked list with a heap.

Defined cases: null is encoded as the empty text (no ids); special-token strings in a text
are ordinary text; rows repeat as often as they come in.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillwise.llm.common import as_texts, map_arrow, mix64, runs_to_positions, segment_sums, slices

#: Longest piece that goes through a matrix; rows of one matrix; distinct pieces a worker remembers.
MATRIX_BYTES, MATRIX_ROWS, REMEMBERED = 128, 4096, 150_000

#: Bytes of text encoded at once: enough new pieces to fill matrices.
_TEXTS = 2 << 20

_NONE = np.int32(0x7FFFFFFF)


class PairTable:
    """(left id, right id) -> rank of the merged token, by open addressing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        size = 1 << max(4, int(4 * max(1, len(left)) - 1).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(size, _NONE, dtype=np.int32)
        keys = self._key(left, right)
        slots = self._slot(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            at = slots[waiting]
            free = self.keys[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(np.where(free, at, np.uint64(size) + np.arange(len(at), dtype=np.uint64)), return_index=True)
            won = first[free[first]]
            self.keys[at[won]] = keys[waiting[won]]
            self.values[at[won]] = rank[waiting[won]]
            waiting = np.delete(waiting, won)
            slots[waiting] = (slots[waiting] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return mix64(keys) & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, ``_NONE`` where they do not merge; any shape."""
        keys = self._key(left.ravel(), right.ravel())
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            slots[open_] = (slots[open_] + np.uint64(1)) & self.mask
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out.reshape(left.shape)


class Tokenizer:
    """Encoder and decoder of one rank file (lines of base64 token and rank)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        # \s as in the library's own engine: Unicode white space, not Python's separators 1C to 1F
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s+", r"\p{White_Space}+"))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = PairTable(np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.array(merged, dtype=np.int32))
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self._forget()

    # encoding ---------------------------------------------------------------------------

    def _merge_matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of like length: one padded row each, one merge a row and round."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        width = int(lengths.max())
        ids = np.zeros((len(pieces), width), dtype=np.int32)
        filled = np.arange(width) < lengths[:, None]
        ids[filled] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = np.full((len(pieces), width), _NONE, dtype=np.int32)
        ranks[:, :-1] = self.pairs.get(ids[:, :-1], ids[:, 1:])
        ranks[np.arange(width) >= lengths[:, None] - 1] = _NONE
        out: list[np.ndarray] = [None] * len(pieces)
        rows = np.arange(len(pieces))
        while len(rows):
            at = ranks.argmin(axis=1)  # the leftmost of the smallest
            best = ranks[np.arange(len(rows)), at]
            done = best == _NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[rows[k]] = ids[k, : lengths[k]].copy()
                rows, ids, ranks, lengths, at, best = (x[~done] for x in (rows, ids, ranks, lengths, at, best))
                if not len(rows):
                    break
                ids, ranks = ids[:, : lengths.max()], ranks[:, : lengths.max()]
            every = np.arange(len(rows))
            # compaction: columns behind the merged pair move one to the left
            source = np.arange(ids.shape[1] - 1)[None, :]
            source = source + (source > at[:, None])
            merged = np.take_along_axis(ids, source, axis=1)
            merged[every, at] = best
            shifted = np.take_along_axis(ranks, source, axis=1)
            lengths = lengths - 1
            ids, ranks = merged, shifted
            after = np.minimum(at + 1, ids.shape[1] - 1)
            right = self.pairs.get(ids[every, at], ids[every, after])
            ranks[every, at] = np.where(at + 1 < lengths, right, _NONE)
            before = np.maximum(at - 1, 0)
            left = self.pairs.get(ids[every, before], ids[every, at])
            has_left = at > 0
            ranks[every[has_left], before[has_left]] = left[has_left]
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, position) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        first = self.pairs.get(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(piece)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        now = [*first.tolist(), int(_NONE)]
        heap = [(r, at) for at, r in enumerate(now) if r != _NONE]
        heapq.heapify(heap)
        one = lambda a, b: int(self.pairs.get(np.array([a]), np.array([b]))[0])
        seen: dict[tuple[int, int], int] = {}
        while heap:
            rank, at = heapq.heappop(heap)
            if now[at] != rank:
                continue
            gone = after[at]
            ids[at], after[at], now[gone] = rank, after[gone], -1
            if after[at] >= 0:
                before[after[at]] = at
            for k in (at, before[at]):
                if k < 0:
                    continue
                pair = (ids[k], ids[after[k]]) if after[k] >= 0 else None
                if pair is not None and pair not in seen:
                    seen[pair] = one(*pair)
                now[k] = int(_NONE) if pair is None else seen[pair]
                if now[k] != _NONE:
                    heapq.heappush(heap, (now[k], k))
        out, at = [], 0
        while at >= 0:
            out.append(ids[at])
            at = after[at]
        return np.array(out, dtype=np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [None] * len(pieces)
        waiting = []
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = np.array([whole], dtype=np.int32)
            elif len(piece) > MATRIX_BYTES:
                out[k] = self._merge_long(piece)
            else:
                waiting.append(k)
        waiting.sort(key=lambda k: len(pieces[k]))
        at = 0
        while at < len(waiting):
            # a bucket: lengths within a quarter, so that padding stays small
            top = len(pieces[waiting[at]]) * 5 // 4
            to = at
            while to < len(waiting) and to - at < MATRIX_ROWS and len(pieces[waiting[to]]) <= top:
                to += 1
            for k, ids in zip(waiting[at:to], self._merge_matrix([pieces[k] for k in waiting[at:to]]), strict=True):
                out[k] = ids
            at = to
        return out

    def _remember(self, pieces: list[str]) -> None:
        found = self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in pieces])
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        at = len(self.pool)
        self.pool = np.concatenate([self.pool, *found])
        self.pool_sizes = np.concatenate([self.pool_sizes, sizes])
        self.pool_starts = np.concatenate([self.pool_starts, at + np.cumsum(sizes) - sizes])
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, dtype=np.int32)
        self.pool_starts = self.pool_sizes = np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one text after the other, ids per text)."""
        pieces: list[str] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            found = self.pattern.findall(text)
            counts[k] = len(found)
            pieces += found
        distinct = set(pieces)
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = distinct
        if new:
            self._remember(list(new))
        at = np.fromiter(map(self.known.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        lengths = self.pool_sizes[at]
        flat = self.pool[runs_to_positions(self.pool_starts[at], lengths)]
        return flat, segment_sums(lengths, counts).astype(np.int64)

    # decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of one sequence of ids: the runs of all tokens gathered at once."""
        ids = ids.astype(np.int64)
        return self.flat[runs_to_positions(self.starts[ids], self.sizes[ids])].tobytes()


@cache
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One tokenizer a worker process; the rank file is read where the task runs."""
    return Tokenizer(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """The columns ``keep`` (default: all but a clashing ``ids``) and the ids of each text."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != ids]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, pattern)
        for batch in batches:
            for part in slices(batch, text, _TEXTS):
                flat, sizes = tok.encode(as_texts(part.column(text)))
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), lists], [*kept, ids])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return map_arrow(docs.select(*dict.fromkeys([*kept, text])), apply, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns and the decoded bytes of each list of ids (a null list is empty)."""
    kept = [c for c in encoded.columns if c != decoded]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, pattern)
        for batch in batches:
            values = [tok.decode(np.asarray(x, dtype=np.int64)) for x in (s.values.to_numpy() if s.is_valid else [] for s in batch.column(ids))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(values, pa.binary())], [*kept, decoded])

    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(decoded, T.BinaryType())])
    return map_arrow(encoded.select(*kept), apply, schema)


def ids_sha256(ids: np.ndarray) -> str:
    """Lowercase hex digest of ids as little-endian unsigned 32-bit integers."""
    return hashlib.sha256(np.asarray(ids).astype("<u4").tobytes()).hexdigest()


def digests(encoded: DataFrame, keep: list[str], path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Per row: number of ids, their digest, and the digest of the bytes they decode to."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, pattern)
        for batch in batches:
            lists = [s.values.to_numpy() if s.is_valid else np.zeros(0, dtype=np.int32) for s in batch.column(ids)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([len(x) for x in lists], pa.int64()), pa.array([ids_sha256(x) for x in lists]), pa.array([hashlib.sha256(tok.decode(x)).hexdigest() for x in lists])],
                [*keep, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = T.StructType([*(encoded.schema[c] for c in keep), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return map_arrow(encoded.select(*keep, ids), apply, schema)
