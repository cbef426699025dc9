"""Quality classifier: logistic regression over hashed word n-grams, learnt by follow-the-regularised-leader.

Tokens are runs of letters and digits or runs of other marks; single tokens and neighbouring
pairs (a token said twice is one pair for all tokens) are hashed into ``2 ** BITS`` weights.  A text is the l2-normalised vector of the
logarithms of its counts; scoring is one sparse dot product a text with the broadcast
weight vector of fixed size.

The fit uses at most ``TRAIN_ROWS`` labelled rows (chosen by id hash, so the choice does not
depend on the order of rows); their sparse features, not their texts, reach the
driver.  Scoring covers every row.

Defined cases: a null or empty text has only the bias, and so still a score; labels other
than 0 and 1, null ids and null labels teach nothing; of several labels of one document each
counts; without labels every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import PrefixHash, as_bytes, hash_sample, map_arrow, mix64, segment_sums, slices

BITS, TRAIN_ROWS, EPOCHS = 18, 8192, 5
#: Step size, its smoothing, and the two penalties of the regularised leader.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.0

_KIND = np.zeros(256, dtype=np.uint8)  # 0 white space, 1 word, 2 other marks
_KIND[33:128] = 2
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KIND[_a:_b] = 1
_TWICE = np.uint64(0xA5A5A5A5A5A5A5A5)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed ids, values, ids per text) of all texts, one after the other."""
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    kind = _KIND[joined]
    edge = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
    ends = np.append(edge[1:], len(joined))
    word = kind[edge] > 0
    starts, ends = edge[word], ends[word]
    token = mix64(PrefixHash(joined).of(starts, ends) + (ends - starts).astype(np.uint64))
    owner = np.repeat(np.arange(len(texts)), lengths)[starts]
    near = owner[:-1] == owner[1:]
    pair = mix64(token[:-1] * _PAIR + token[1:])
    pair[token[:-1] == token[1:]] = _TWICE  # any token followed by itself is the same pair
    keys = np.concatenate((token, pair[near])) >> np.uint64(64 - bits)
    keys |= np.concatenate((owner, owner[:-1][near])).astype(np.uint64) << np.uint64(bits)
    keys, counts = np.unique(keys, return_counts=True)
    owner = (keys >> np.uint64(bits)).astype(np.int64)
    values = np.log1p(counts)
    sizes = np.bincount(owner, minlength=len(texts))
    norm = np.sqrt(segment_sums(values**2, sizes))
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int32), (values / np.repeat(norm, sizes)).astype(np.float32), sizes


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # float32, 2 ** bits
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        ids, values, sizes = features(texts, int(len(self.weights) - 1).bit_length())
        margin = self.bias + segment_sums(self.weights[ids] * values, sizes)
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60)))


class FollowTheRegularisedLeader:
    """Per-coordinate proximal updates for the logistic loss, one row after the other."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the bias

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)  # the bias is not pulled to zero
        pulled = np.sign(z) * l1 - z
        return np.where(np.abs(z) <= l1, 0.0, pulled / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, ids: np.ndarray, values: np.ndarray, label: int) -> None:
        at = np.append(ids, len(self.z) - 1)
        x = np.append(values, 1.0)
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, label: str = "quality", text: str = "text", key: str = "doc_id", bits: int = BITS, rows: int = TRAIN_ROWS, epochs: int = EPOCHS, seed: int = 42) -> QualityModel:
    """Learn from at most ``rows`` labelled documents; ``train`` is a condition on ``key``."""
    spark = docs.sparkSession
    allowed = labels if train is None else labels.where(train)
    known = allowed.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key IS NOT NULL AND label IN (0, 1)")
    # two numbers a row, bounded by ``rows``: small enough for the driver and for a broadcast
    chosen = hash_sample(known, ["key"], rows).collect()
    sample = spark.createDataFrame(chosen, known.schema)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids, values, sizes = features(as_bytes(part.column("text")), bits)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (ids, values)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("label"), *lists], ["key", "label", "ids", "values"])

    joined = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(sample), "key")
    schema = T.StructType([joined.schema["key"], T.StructField("label", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.FloatType()))])
    # ids that stand for more than one document could exceed the bound, so it holds for the features too
    table = map_arrow(joined.select("key", "label", "text"), extract, schema).limit(rows).toArrow()
    model = FollowTheRegularisedLeader(1 << bits)
    found = sorted(zip(table.column("key").to_pylist(), table.column("label").to_pylist(), range(table.num_rows), strict=True))
    lists = [table.column(c).combine_chunks() for c in ("ids", "values")]
    pick = [(lists[0][k].values.to_numpy(), lists[1][k].values.to_numpy(), label) for _, label, k in found]
    for epoch in range(epochs):
        for k in np.random.default_rng(seed + epoch).permutation(len(pick)):
            model.update(*pick[k])
    weights = model.weights(np.arange((1 << bits) + 1))
    return QualityModel(weights[:-1].astype(np.float32), float(weights[-1]))


def score(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, which replaces a column of the same name."""
    kept = [c for c in docs.columns if c != out]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                scores = shared.value.score(as_bytes(part.column(text)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(scores, pa.float64())], [*kept, out])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.DoubleType())])
    return map_arrow(docs.select(*kept), apply, schema)
