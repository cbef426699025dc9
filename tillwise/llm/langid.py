"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every letter n-gram of every labelled training text: each task sums
its rows per (language, bucket), Spark adds the sums into a stored table.  Scoring broadcasts the
log-probability matrix of at most ``BLOCK`` languages at a time and adds, per text, the rows of its
n-grams; with more languages the blocks follow one another, each text keeping its best language and the
sum of all probabilities, so there is no limit and the result is that of one matrix.

Defined cases: a text that is null, empty or without a letter gets ``und`` with score 0;
without any training text every prediction is ``und``; equal scores go to the language
that sorts first; rows repeat as often as they come in; null languages teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import as_texts, map_arrow, mix64, segment_sums, slices, stored

UNDETERMINED = "und"
#: Hash buckets; the orders of the n-grams; additive smoothing of the counts.
BUCKETS, ORDERS, SMOOTHING = 1 << 16, (1, 2, 3), 0.5
#: Languages of one broadcast matrix; languages whose counts a task holds before it passes them on.
BLOCK, HELD_LANGUAGES = 256, 64

_SPACE, _END = 32, 0


@cache
def _letters() -> np.ndarray:
    """Code point to lower-case letter, or to a space for what is no letter."""
    table = np.full(0x110000, _SPACE, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    table[_END] = _END
    return table


def _grams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each n-gram position, positions per text, whether the text has a letter).

    Positions that would reach past their text get the spare bucket ``buckets``.
    """
    gap = max(ORDERS) - 1
    joined = ("\0" * gap).join(t.replace("\0", " ") for t in texts) + "\0" * gap
    points = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    lengths = np.fromiter((len(t) + gap for t in texts), dtype=np.int64, count=len(texts))
    # runs of non-letters count once
    blank = points == _SPACE
    again = np.zeros(len(points), dtype=bool)
    again[1:] = blank[1:] & blank[:-1]
    owner = np.repeat(np.arange(len(texts)), lengths)[~again]
    points = points[~again].astype(np.uint64)
    sizes = np.bincount(owner, minlength=len(texts))
    has = np.bincount(owner, weights=(points != _SPACE) & (points != _END), minlength=len(texts)) > 0
    found = np.empty((len(points), len(ORDERS)), dtype=np.int32)
    for at, n in enumerate(ORDERS):
        value = np.full(len(points), n, dtype=np.uint64)
        open_end = np.zeros(len(points), dtype=bool)
        for k in range(n):
            shifted = np.zeros(len(points), dtype=np.uint64)
            shifted[: len(points) - k] = points[k:]
            value = value * np.uint64(0x9E3779B97F4A7C15) + shifted
            open_end |= shifted == _END
        hashed = (mix64(value) >> np.uint64(20)) % np.uint64(buckets)
        found[:, at] = np.where(open_end, buckets, hashed)
    return found, sizes, has


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # (buckets + 1, languages); the spare last row is zero
    log_prior: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.log_prob) - 1

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language, its log-probability, sum of all probabilities relative to it) of each text; ``und``, minus infinity and 0 without a letter."""
        names = np.full(len(texts), UNDETERMINED, dtype=object)
        best, share = np.full(len(texts), -np.inf), np.zeros(len(texts))
        if texts and self.languages:
            grams, sizes, has = _grams(texts, self.buckets)
            total = self.log_prior + sum(segment_sums(self.log_prob[grams[:, k]], sizes) for k in range(grams.shape[1]))
            at = total.argmax(axis=1)
            names[has] = np.array(self.languages, dtype=object)[at[has]]
            best[has] = total.max(axis=1)[has]
            share[has] = np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)[has]
        return names, best, share


class LanguageModels:
    """One matrix for each ``BLOCK`` languages, made from the stored counts when it is asked for."""

    def __init__(self, counts: DataFrame, texts: dict[str, int], buckets: int, block: int):
        self.counts, self.texts, self.buckets, self.block = counts, texts, buckets, block
        self.languages = sorted(texts)

    def __len__(self) -> int:
        return max(1, -(-len(self.languages) // self.block))

    def __getitem__(self, k: int) -> LanguageModel:
        names = self.languages[k * self.block : (k + 1) * self.block]
        if not names:
            return LanguageModel([], np.zeros((self.buckets + 1, 0), dtype=np.float32), np.zeros(0))
        own = self.counts.where(F.col("lang").isin(names)).toArrow()
        row = pc.index_in(own.column("lang"), value_set=pa.array(names)).to_numpy()
        full = np.zeros((len(names), self.buckets + 1))
        full[row, own.column("bucket").to_numpy()] = own.column("n").to_numpy()
        seen = full[:, : self.buckets]
        log_prob = np.zeros((self.buckets + 1, len(names)), dtype=np.float32)
        log_prob[: self.buckets] = np.log((seen + SMOOTHING) / (seen.sum(axis=1, keepdims=True) + SMOOTHING * self.buckets)).T
        texts = np.array([self.texts[n] for n in names], dtype=np.float64)
        return LanguageModel(names, log_prob, np.log(texts / max(1.0, sum(self.texts.values()))))


def fit(training: DataFrame, text: str = "text", label: str = "lang", buckets: int = BUCKETS, block: int = BLOCK) -> LanguageModels:
    """Count the n-grams of every training row with a label; null labels are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for name, seen in sums.items():
                at = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(seen[at].astype(np.int64))], ["lang", "bucket", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column("lang").dictionary_encode()
                names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
                grams, sizes, _ = _grams(as_texts(part.column("text")), buckets)
                row = np.repeat(codes, sizes)
                for k, name in enumerate(names):
                    seen = np.bincount(grams[row == k].ravel(), minlength=buckets + 1)
                    seen[buckets] = (codes == k).sum()  # the spare bucket carries the number of texts
                    sums[name] = sums.get(name, 0) + seen
                if len(sums) > HELD_LANGUAGES:
                    yield from told()
                    sums.clear()
        yield from told()

    rows = training.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("lang")).where("lang IS NOT NULL")
    counts = stored(map_arrow(rows, count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    texts = counts.where(F.col("bucket") == buckets).select("lang", "n").toArrow()  # a row a language
    return LanguageModels(counts, dict(zip(texts.column("lang").to_pylist(), texts.column("n").to_pylist(), strict=True)), buckets, block)


def predict(docs: DataFrame, models: LanguageModels, text: str = "text", prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` and the two new ones, which replace columns of the same name.

    One pass for each block of languages; from the second on, what is known of a text (best language, its log-probability, the
    sum of all probabilities relative to it) is written in between, so no worker holds two blocks.
    """
    kept = [c for c in docs.columns if c not in (prediction, score)]
    running = [(f"_{prediction}_{c}_so_far", t) for c, t in (("name", T.StringType()), ("best", T.DoubleType()), ("total", T.DoubleType()))]
    state = docs.select(*kept)
    for k in range(len(models)):
        shared = docs.sparkSession.sparkContext.broadcast(models[k])
        first, final = k == 0, k == len(models) - 1

        def apply(batches: Iterator[pa.RecordBatch], shared=shared, first=first, final=final) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    names, best, total = shared.value.judge(as_texts(part.column(text)))
                    if not first:
                        old_names, old_best, old_total = (part.column(c).to_numpy(zero_copy_only=False) for c, _ in running)
                        ahead = best > old_best  # of equals the language of an earlier block stays
                        top = np.maximum(best, old_best)
                        with np.errstate(invalid="ignore"):
                            total = np.where(np.isfinite(top), total * np.exp(best - top) + old_total * np.exp(old_best - top), 0.0)
                        names, best = np.where(ahead, names, old_names), top
                    if final:
                        scores = np.divide(1.0, total, out=np.zeros(len(total)), where=total > 0)
                        told = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                    else:
                        told = [pa.array(names, pa.string()), pa.array(best, pa.float64()), pa.array(total, pa.float64())]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *told], [*kept, *([prediction, score] if final else [c for c, _ in running])])

        new = [(prediction, T.StringType()), (score, T.DoubleType())] if final else running
        schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(c, t) for c, t in new)])
        state = map_arrow(state, apply, schema)
        if not final:
            state = stored(state)
    return state
