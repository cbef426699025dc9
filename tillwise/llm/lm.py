"""Document log-likelihood by a gated recurrent language model, and by smoothed unigrams.

Tokens are the words of the ASCII lower-cased text and one end.  Counts cover every training
document: tasks count their rows, Spark adds the counts, and the table of all words stays
distributed.  Only the most frequent words, up to ``FREQUENT`` of at most ``WORD_BYTES`` bytes, are
broadcast (a bound on the broadcast, not on the counts); the counts of all other words reach
the documents by a join.

The model predicts the ``VOCABULARY`` most frequent words, the end, and "another word", by a
gated recurrent unit with a class-factored softmax: the class, then the word within it.
Another word is spelt out by its smoothed unigram probability among the other words, so the
score is the probability of the exact text.  Output biases start at the counts of the whole
corpus.  Words are turned into symbols once, in a table that training and scoring read.  Recurrent weights learn by truncated backpropagation in numpy: in each of ``ROUNDS``
rounds every task trains a copy on its share of one in ``STRIDE`` training documents (dealt by id
hash, so that the rounds together cover every document), and Spark averages the copies, weighted
by tokens.  State runs on across windows of ``WINDOW`` tokens to the end of a document, in training as
in scoring.  Documents run side by side in lanes; a lane that is free takes the next document, so memory
holds one window of all lanes, however long a text is.

Defined cases: null counts as the empty text (one token, the end); without training documents
every count is zero, so the unigram score of any text is 0 and the model keeps its start; rows
repeat as often as they come in; an empty table gives no rows; columns that have the name of a result are replaced.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import as_bytes, map_arrow, most_frequent, segment_sums, shuffle_partitions, slices, stored

#: Symbols of the model (words, end and other; below 32,768), symbols a class, units of the state.
VOCABULARY, CLASS, UNITS = 1024, 32, 16
#: Words whose counts are broadcast, and their greatest length.
FREQUENT, WORD_BYTES = 1 << 16, 64
#: Tokens between cuts of the gradient; lanes trained and scored side by side.
WINDOW, TRAIN_LANES, SCORE_LANES = 32, 512, 512
#: Lanes a task starts to train with, and tokens learnt for each further lane.
LEAST_LANES, LANE_TOKENS = 128, 512
#: One in so many training documents each round; rounds; step size; clip of a gradient entry.
STRIDE, ROUNDS, RATE, CLIP = 4, 4, 0.3, 1.0
_END, _OTHER = 0, 1
_READ = 2 << 20  # bytes of text turned into symbols at once
_ROWS = 4096  # states whose classes are worked out at once
_BLOCK = 1 << 10  # weights a row when copies are averaged
_HELD_WORDS = 400_000  # distinct words a counting task holds before it passes them on


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


# counts -------------------------------------------------------------------------------------


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all rows of ``docs``; summed in the tasks before the shuffle."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for one in as_bytes(part.column("text")):
                    seen.update(words_of(one))
                if len(seen) > _HELD_WORDS:
                    yield told()
                    seen.clear()
        yield told()

    return map_arrow(docs.select(F.col(text).cast("string").alias("text")), apply, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Places(dict):
    """word -> place in the frequency table; -1 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return -1

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


@dataclass(frozen=True)
class Unigrams:
    """Totals of the training tokens, and the counts of the frequent words."""

    tokens: int
    distinct: int
    ends: int
    frequent: Places  # word -> place in ``counts``, most frequent first
    counts: np.ndarray
    model_words: int  # of these, how many the model predicts

    @property
    def base(self) -> float:
        return float(np.log10(self.tokens + self.distinct + 1))

    @property
    def other(self) -> tuple[int, int]:
        """Tokens and distinct words beyond those the model predicts."""
        return int(self.tokens - self.ends - self.counts[: self.model_words].sum()), self.distinct - (self.ends > 0) - self.model_words

    def symbols(self) -> np.ndarray:
        """Counts of the model's symbols: end, another word, words."""
        return np.concatenate(([self.ends, self.other[0]], self.counts[: self.model_words])).astype(np.float64)


def unigrams(words: DataFrame, ends: int, frequent: int = FREQUENT, vocabulary: int = VOCABULARY) -> Unigrams:
    total = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    top = most_frequent(words.where(F.length("word") <= WORD_BYTES), frequent)
    counts = np.array([n for _, n in top], dtype=np.int64)
    places = Places((bytes(w), k) for k, (w, _) in enumerate(top))
    return Unigrams((total["n"] or 0) + ends, total["v"] + (ends > 0), ends, places, counts, min(vocabulary - 2, len(counts)))


# the recurrent model ------------------------------------------------------------------------


def _softmax(logits: np.ndarray, picked: np.ndarray, gradient: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """(log-probability of the picked column, its gradient with the sign turned) of each row; works in place."""
    np.minimum(logits, 80, out=logits)  # keeps the exponential finite
    at = np.arange(len(picked))
    own = logits[at, picked]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], dtype=logits.dtype)
    if gradient:
        logits /= total[:, None]
        logits[at, picked] -= 1.0
    return own - np.log(total), logits if gradient else None


class Gru:
    """Gated recurrent unit with class-factored output; all weights are views of one vector.

    The end and "another word" are classes of their own, so only words take a second softmax.
    Gates are kept as (units, lanes): whole rows for the processor's vector units.
    """

    def __init__(self, symbols: int, units: int = UNITS, per_class: int = CLASS, vector: np.ndarray | None = None):
        self.symbols, self.units, self.per_class = symbols, units, per_class
        self.classes = 2 + -(-max(0, symbols - 2) // per_class)
        rows = (self.classes - 2) * per_class
        shapes = {"x": (2 + rows, 3 * units), "u": (units, 3 * units), "c": (units, self.classes), "cb": (self.classes,), "o": (rows, units), "ob": (rows,)}
        sizes = [int(np.prod(s)) for s in shapes.values()]
        self.vector = np.zeros(sum(sizes), dtype=np.float32) if vector is None else vector.astype(np.float32)
        for (name, shape), end, size in zip(shapes.items(), np.cumsum(sizes), sizes, strict=True):
            setattr(self, name, self.vector[end - size : end].reshape(shape))

    @classmethod
    def start(cls, counts: np.ndarray, units: int = UNITS, per_class: int = CLASS, seed: int = 42) -> Gru:
        """Small random weights; biases that give the smoothed symbol frequencies."""
        out = cls(len(counts), units, per_class)
        rng = np.random.default_rng(seed)
        for name in ("x", "u", "c", "o"):
            weights = getattr(out, name)
            weights[:] = rng.normal(0, 0.1 if name != "u" else units**-0.5, weights.shape)
        smooth = np.zeros(2 + len(out.ob))
        smooth[: len(counts)] = counts + 1.0
        words = smooth[2:].reshape(out.classes - 2, per_class).sum(axis=1)
        out.cb[:] = np.log(np.concatenate((smooth[:2], words)) / smooth.sum())
        with np.errstate(divide="ignore"):
            out.ob[:] = np.maximum(np.log(smooth[2:]) - np.repeat(np.log(words), per_class), -60.0)
        return out

    def states(self, inputs: np.ndarray, keep: np.ndarray, h: np.ndarray, cache: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States (steps, units, lanes) after each input; ``keep`` is 0 where a document starts."""
        units, (steps, lanes) = self.units, inputs.shape
        out = np.empty((steps, units, lanes), dtype=np.float32)
        given = np.ascontiguousarray(self.x[inputs].transpose(0, 2, 1))
        back = np.ascontiguousarray(self.u.T)
        for t in range(steps):
            h = h * keep[t]
            g = back @ h
            zr = given[t, : 2 * units]
            zr += g[: 2 * units]
            np.negative(zr, out=zr)
            np.exp(np.minimum(zr, 80, out=zr), out=zr)
            zr += 1.0
            np.reciprocal(zr, out=zr)
            n = given[t, 2 * units :]
            n += zr[units:] * g[2 * units :]
            np.tanh(n, out=n)
            np.subtract(h, n, out=out[t])
            out[t] *= zr[:units]
            out[t] += n
            if cache is not None:
                cache.append((h, g[2 * units :]))
            h = out[t]
        if cache is not None:
            cache.append(given)
        return out, h

    def log_prob(self, states: np.ndarray, targets: np.ndarray, grads: Gru | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each target; with ``grads`` also the gradient by the states, output gradients being added.

        Rows are ordered by class, so that the words of a class are one product.
        """
        own = np.where(targets < 2, targets, (targets - 2) // self.per_class + 2)
        order = np.argsort(own.astype(np.int16) if self.classes < 1 << 15 else own, kind="stable")
        states, targets, own = states[order], targets[order], own[order]
        found = np.empty(len(targets), dtype=np.float32)
        back = None if grads is None else np.empty_like(states)
        for at in range(0, len(targets), _ROWS):  # blocks whose logits stay in the processor's cache
            span = slice(at, at + _ROWS)
            mine = states[span]
            found[span], share = _softmax(mine @ self.c + self.cb, own[span], grads is not None)
            if grads is not None:
                grads.c += mine.T @ share
                grads.cb += share.sum(axis=0)
                back[span] = share @ self.c.T
        edges = np.searchsorted(own, np.arange(2, self.classes + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            rows = slice(edges[k], edges[k + 1])
            span = slice(k * self.per_class, (k + 1) * self.per_class)
            mine = states[rows]
            more, share = _softmax(mine @ self.o[span].T + self.ob[span], targets[rows] - (2 + span.start), grads is not None)
            found[rows] += more
            if grads is not None:
                grads.o[span] += share.T @ mine
                grads.ob[span] += share.sum(axis=0)
                back[rows] += share @ self.o[span]
        out = np.empty(len(targets))
        out[order] = found
        if back is None:
            return out, None
        flow = np.empty_like(back)
        flow[order] = back
        return out, flow

    def gradients(self, inputs: np.ndarray, keep: np.ndarray, targets: np.ndarray, h: np.ndarray, grads: Gru) -> tuple[np.ndarray, float, int]:
        """One truncated window: ``grads`` filled, (last state, loss, tokens); targets below zero are padding."""
        units, (steps, lanes) = self.units, inputs.shape
        grads.vector[:] = 0
        cache: list = []
        states, last = self.states(inputs, keep, h, cache)
        gates = cache.pop()  # update, reset and new of every step
        z, r, n = gates[:, :units], gates[:, units : 2 * units], gates[:, 2 * units :]
        real = targets >= 0
        found, back = self.log_prob(states.transpose(0, 2, 1)[real], targets[real], grads)
        flow = np.zeros((steps, lanes, units), dtype=np.float32)
        flow[real] = back
        flow = np.ascontiguousarray(flow.transpose(0, 2, 1))
        # what does not depend on the steps after: factors of the gradients of each gate
        before = np.stack([c[0] for c in cache])
        by_new = (1 - z) * (1 - n * n)
        by_reset = np.stack([c[1] for c in cache]) * r * (1 - r)
        by_update = (before - n) * z * (1 - z)
        inside = np.empty_like(gates)  # gradients where the inputs enter
        recurrent = np.empty((3 * units, lanes), dtype=np.float32)
        onward = np.empty_like(flow)
        dh = np.zeros_like(last)
        by_u = np.zeros((units, 3 * units), dtype=np.float32)
        for t in reversed(range(steps)):
            dh = dh + flow[t]
            d = inside[t]
            np.multiply(dh, by_update[t], out=d[:units])
            np.multiply(dh, by_new[t], out=d[2 * units :])
            np.multiply(d[2 * units :], by_reset[t], out=d[units : 2 * units])
            recurrent[: 2 * units] = d[: 2 * units]
            np.multiply(d[2 * units :], r[t], out=recurrent[2 * units :])
            by_u += before[t] @ recurrent.T
            np.matmul(self.u, recurrent, out=onward[t])
            dh = (dh * z[t] + onward[t]) * keep[t]
        grads.u += by_u
        rows = inputs.ravel()
        order = np.argsort(rows.astype(np.int16) if len(self.x) < 1 << 15 else rows, kind="stable")
        sums = np.ascontiguousarray(inside.transpose(0, 2, 1)).reshape(-1, 3 * units)[order]
        used, first = np.unique(rows[order], return_index=True)
        grads.x[used] = np.add.reduceat(sums, first, axis=0)
        return last, -float(found.sum()), int(real.sum())


class Lanes:
    """Sequences side by side, a window of steps at a time; a lane whose sequence has ended takes the next one that waits.

    Memory holds the sequences themselves and one window, whatever their lengths.
    """

    def __init__(self, units: int):
        self.flat = np.zeros(0, dtype=np.int16)  # symbols of all sequences that are not yet through
        self.waiting: deque[tuple[int, int, int]] = deque()  # number, begin and end in ``flat``
        self.number, self.begin, self.place, self.end = (np.zeros(0, dtype=np.int64) for _ in range(4))  # of each lane
        self.h = np.zeros((units, 0), dtype=np.float32)

    def add(self, first: int, sequences: list[np.ndarray]) -> None:
        """Sequences numbered from ``first``; of those that come together the longest start first."""
        kept, size = [], 0
        for k in np.flatnonzero(self.place < self.end).tolist():
            at = max(int(self.begin[k]), int(self.place[k]) - 1)  # the symbol before is the next input
            kept.append(self.flat[at : self.end[k]])
            for own in (self.begin, self.place, self.end):
                own[k] += size - at
            size += len(kept[-1])
        old, self.waiting = self.waiting, deque()
        ordered = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
        for number, symbols in [*((n, self.flat[a:b]) for n, a, b in old), *((first + k, sequences[k]) for k in ordered)]:
            if len(symbols):
                kept.append(symbols)
                self.waiting.append((number, size, size + len(symbols)))
                size += len(symbols)
        self.flat = np.concatenate(kept).astype(np.int16) if kept else np.zeros(0, dtype=np.int16)

    def window(self, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(targets, inputs, keep, numbers), each (steps, lanes), for at most ``count`` lanes; padding targets are -1."""
        open_ = np.flatnonzero(self.place < self.end)
        fresh = [self.waiting.popleft() for _ in range(min(len(self.waiting), max(0, count - len(open_))))]
        new = np.array(fresh, dtype=np.int64).reshape(-1, 3)
        self.number, self.begin = np.concatenate((self.number[open_], new[:, 0])), np.concatenate((self.begin[open_], new[:, 1]))
        self.place, self.end = np.concatenate((self.place[open_], new[:, 1])), np.concatenate((self.end[open_], new[:, 2]))
        self.h = np.concatenate((self.h[:, open_], np.zeros((len(self.h), len(fresh)), dtype=np.float32)), axis=1)
        at = self.place[:, None] + np.arange(WINDOW)
        inside = at < self.end[:, None]
        at = np.where(inside, at, 0)
        targets = np.where(inside, self.flat[at], -1).astype(np.int64)
        inputs = np.where(inside, self.flat[at - 1], _END).astype(np.int64)
        keep = np.ones(targets.shape, dtype=np.float32)
        starts = self.place == self.begin
        inputs[starts, 0], keep[starts, 0] = _END, 0.0
        numbers = np.repeat(self.number[:, None], WINDOW, axis=1)
        filled = np.minimum(self.end - self.place, WINDOW)
        self.place = self.place + filled
        for k in np.flatnonzero(filled < WINDOW).tolist():
            used = int(filled[k])
            while used < WINDOW and self.waiting:
                number, begin, end = self.waiting.popleft()
                n = min(WINDOW - used, end - begin)
                targets[k, used : used + n] = self.flat[begin : begin + n]
                inputs[k, used] = _END
                inputs[k, used + 1 : used + n] = self.flat[begin : begin + n - 1]
                keep[k, used], numbers[k, used : used + n] = 0.0, number
                self.number[k], self.begin[k], self.place[k], self.end[k] = number, begin, begin + n, end
                used += n
        return np.ascontiguousarray(targets.T), np.ascontiguousarray(inputs.T), np.ascontiguousarray(keep.T), np.ascontiguousarray(numbers.T)

    def __bool__(self) -> bool:
        return bool(self.waiting) or bool((self.place < self.end).any())

    def unfinished(self) -> set[int]:
        return {n for n, _, _ in self.waiting} | set(self.number[self.place < self.end].tolist())


class Scorer:
    """log10 probabilities of sequences that come in one after the other."""

    def __init__(self, model: Gru, count: int = SCORE_LANES):
        self.model, self.count, self.lanes = model, count, Lanes(model.units)
        self.sums = np.zeros(0)

    def add(self, sequences: list[np.ndarray]) -> None:
        self.lanes.add(len(self.sums), sequences)
        self.sums = np.concatenate((self.sums, np.zeros(len(sequences))))

    def run(self, to_the_end: bool = False) -> None:
        """Score while lanes are full, or everything."""
        while self.lanes if to_the_end else len(self.lanes.waiting) >= self.count:
            targets, inputs, keep, numbers = self.lanes.window(self.count)
            states, self.lanes.h = self.model.states(inputs, keep, self.lanes.h)
            real = targets >= 0
            found, _ = self.model.log_prob(states.transpose(0, 2, 1)[real], targets[real])
            np.add.at(self.sums, numbers[real], found / np.log(10))

    def done(self) -> int:
        """Of the sequences added so far, how many at the front are scored."""
        return min(self.lanes.unfinished(), default=len(self.sums))


def score_sequences(model: Gru, sequences: list[np.ndarray], count: int = SCORE_LANES) -> np.ndarray:
    """log10 probability of each sequence of symbols."""
    scorer = Scorer(model, count)
    scorer.add(sequences)
    scorer.run(to_the_end=True)
    return scorer.sums


class Trainer:
    """Adagrad on windows of lanes; more lanes as more tokens have been learnt."""

    def __init__(self, model: Gru, rate: float = RATE):
        self.model, self.rate, self.tokens = model, rate, 0
        self.squares = np.full_like(model.vector, 0.1)
        self.grads = Gru(model.symbols, model.units, model.per_class)
        self.lanes = Lanes(model.units)

    def learn(self, sequences: list[np.ndarray], to_the_end: bool = True) -> None:
        """Learn from the sequences; without ``to_the_end`` some may wait until more lanes can be filled."""
        self.lanes.add(0, sequences)
        while self.lanes if to_the_end else len(self.lanes.waiting) >= TRAIN_LANES:
            count = min(TRAIN_LANES, LEAST_LANES + self.tokens // LANE_TOKENS)
            targets, inputs, keep, _ = self.lanes.window(count)
            self.lanes.h, _, n = self.model.gradients(inputs, keep, targets, self.lanes.h, self.grads)
            step = np.clip(self.grads.vector * (WINDOW / max(1, n)), -CLIP, CLIP)
            self.squares += step * step
            step *= self.rate
            step /= np.sqrt(self.squares)
            self.model.vector -= step
            self.tokens += n


# with Spark ---------------------------------------------------------------------------------


def _averaged(copies: DataFrame) -> DataFrame:
    """Weighted sums of blocks of weights, in two steps so that no task reads all copies."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for lane, block, weight, values in zip(*(batch.column(c).to_pylist() for c in ("lane", "block", "weight", "values")), strict=True):
                own = sums.setdefault((lane, block), [0.0, 0.0])
                own[0] += weight
                own[1] = own[1] + np.frombuffer(values, dtype=np.float64)
        for (lane, block), (weight, values) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lane], pa.int32()), pa.array([block], pa.int32()), pa.array([weight]), pa.array([values.tobytes()])], ["lane", "block", "weight", "values"])

    schema = "lane int, block int, weight double, values binary"
    parts = shuffle_partitions(copies.sparkSession)
    some = map_arrow(copies.repartition(parts, "lane", "block"), apply, schema)
    return map_arrow(some.withColumn("lane", F.lit(0)).repartition(parts, "block"), apply, schema)


def _rare(words: list[bytes], places: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """For each text the words that are not in the frequency table, each once with its count."""
    at = np.flatnonzero(places < 0)
    coded = pa.array([words[k] for k in at.tolist()], pa.binary()).dictionary_encode()
    owner = np.repeat(np.arange(len(sizes)), sizes)[at]
    distinct = max(1, len(coded.dictionary))
    keys, counts = np.unique(owner * distinct + coded.indices.to_numpy(), return_counts=True)
    many = np.bincount(keys // distinct, minlength=len(sizes))
    pairs = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(keys % distinct)), pa.array(counts.astype(np.int32))], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(many))).astype(np.int32)), pairs)


def symbolized(docs: DataFrame, known: Unigrams, text: str = "text", id_column: str = "doc_id", keep: list[str] | None = None, training: Column | None = None) -> DataFrame:
    """The stored table that training and scoring read instead of the texts: one row a document.

    Holds the kept columns (as kept0, kept1, ...), the symbols of the model with the end, all that the unigrams
    say of the frequent words, the rare words with their counts, and for the rows of ``training`` (default: all) the turn in
    which they are learnt from (-1: never).
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, *RESULTS)]
    told = docs.sparkSession.sparkContext.broadcast(known)
    columns = [*(f"kept{k}" for k in range(len(keep))), "row", "turn"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = told.value
        log_count = np.append(np.log10(own.counts + 1.0), 0.0)
        for batch in batches:
            for part in slices(batch, "text", _READ):
                said = [words_of(t) for t in as_bytes(part.column("text"))]
                sizes = np.fromiter(map(len, said), dtype=np.int64, count=len(said))
                flat = list(chain.from_iterable(said))
                places = own.frequent.of(flat)
                modelled = (places >= 0) & (places < own.model_words)
                logs = log_count[places]  # zero for a rare word
                sums = [segment_sums(v, sizes) for v in (places >= 0, ~modelled, logs, np.where(modelled, 0.0, logs))]
                # the symbols of a text and its end, one text after the other
                coded = np.full(len(flat) + len(said), _END, dtype="<i2")
                last = np.cumsum(sizes + 1) - 1
                word = np.ones(len(coded), dtype=bool)
                word[last] = False
                coded[word] = np.where(modelled, places + 2, _OTHER)
                offsets = np.concatenate(([0], 2 * (last + 1))).astype(np.int32)
                symbols = pa.Array.from_buffers(pa.binary(), len(said), [None, pa.py_buffer(offsets), pa.py_buffer(coded)])
                numbers = [pa.array(v.astype(np.int32)) for v in (sizes, *sums[:2])] + [pa.array(v) for v in sums[2:]]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *numbers, _rare(flat, places, sizes), symbols], [*columns, "words", "frequent", "unnamed", "base", "spelt", "rare", "symbols"])

    learnt = F.lit(True) if training is None else training
    turn = F.when(learnt, F.pmod(F.xxhash64(id_column), F.lit(1 << 20)).cast("int")).otherwise(-1)
    source = docs.select(*(F.col(c).alias(f"kept{k}") for k, c in enumerate(keep)), F.monotonically_increasing_id().alias("row"), turn.alias("turn"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([*(T.StructField(f"kept{k}", docs.schema[c].dataType) for k, c in enumerate(keep)), *T._parse_datatype_string(CODED).fields])
    return stored(map_arrow(source, apply, schema))


def turn_of(coded: DataFrame, turn: int, stride: int = STRIDE) -> DataFrame:
    """The training documents of one round; ``stride`` rounds have each document once."""
    return coded.where((F.col("turn") >= 0) & (F.col("turn") % stride == turn % stride))


def _sequences(part: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype="<i2") for b in part.column("symbols").to_pylist()]


def train(coded: DataFrame, known: Unigrams, rounds: int = ROUNDS, stride: int = STRIDE, rate: float = RATE, units: int = UNITS, per_class: int = CLASS, seed: int = 42) -> Gru:
    """Train on the training rows of ``symbolized``: each round on other documents, copies averaged by Spark."""
    counts = known.symbols()
    model = Gru.start(counts, units, per_class, seed)
    spark = coded.sparkSession
    symbols = len(counts)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model.vector)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trainer, lane = Trainer(Gru(symbols, units, per_class, shared.value), rate), 0
            for batch in batches:
                for part in slices(batch, "symbols", _READ):
                    lane = part.column("lane")[0].as_py()
                    trainer.learn(_sequences(part), to_the_end=False)
            trainer.learn([])
            if trainer.tokens:
                weighed = trainer.model.vector.astype(np.float64) * trainer.tokens
                for at in range(0, len(weighed), _BLOCK):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lane], pa.int32()), pa.array([at // _BLOCK], pa.int32()), pa.array([float(trainer.tokens)]), pa.array([weighed[at : at + _BLOCK].tobytes()])],
                        ["lane", "block", "weight", "values"],
                    )

        rows = turn_of(coded, turn, stride).select(F.pmod(F.spark_partition_id(), F.lit(64)).cast("int").alias("lane"), "symbols")
        blocks = _averaged(map_arrow(rows, learn, "lane int, block int, weight double, values binary")).collect()
        if blocks:  # as many rows as the model has blocks
            parts = {b["block"]: np.frombuffer(b["values"], dtype=np.float64) / b["weight"] for b in blocks}
            model = Gru(symbols, units, per_class, np.concatenate([parts[k] for k in range(len(parts))]))
        shared.unpersist()
    return model


CODED = "row bigint, turn int, words int, frequent int, unnamed int, base double, spelt double, rare array<struct<word:binary,n:int>>, symbols binary"
RESULTS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def score(coded: DataFrame, words: DataFrame, known: Unigrams, model: Gru, names: list[str]) -> DataFrame:
    """The kept columns of ``symbolized`` by their ``names``, and n_tokens, n_known, train_tokens, base_score, score."""
    shared = coded.sparkSession.sparkContext.broadcast(model.vector)
    symbols, units, per_class = len(known.symbols()), model.units, model.per_class
    hidden = [f"kept{k}" for k in range(len(names))]
    columns = [*hidden, "row", "words", "frequent", "unnamed", "base", "spelt"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Gru(symbols, units, per_class, shared.value))
        pending: deque[tuple[int, pa.RecordBatch]] = deque()

        def ready() -> Iterator[pa.RecordBatch]:
            done = scorer.done()
            while pending and pending[0][0] + pending[0][1].num_rows <= done:
                first, rows = pending.popleft()
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(scorer.sums[first : first + rows.num_rows])], [*columns, "modelled"])

        for batch in batches:
            for part in slices(batch, "symbols", _READ):
                pending.append((len(scorer.sums), part.select(columns)))
                scorer.add(_sequences(part))
                scorer.run()
                yield from ready()
        scorer.run(to_the_end=True)
        yield from ready()

    schema = T.StructType([*(coded.schema[c] for c in columns), T.StructField("modelled", T.DoubleType())])
    scored = map_arrow(coded.select(*columns, "symbols"), apply, schema)
    rare = coded.select("row", F.explode("rare").alias("one")).select("row", F.col("one.word").alias("word"), F.col("one.n").alias("times"))
    counted = rare.join(words, "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("rare_base"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    other_tokens, other_words = known.other
    all_ = scored.join(counted, "row", "left")
    rare_base, rare_known = F.coalesce("rare_base", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    tokens = F.col("words") + 1
    return all_.select(
        *(F.col(h).alias(c) for h, c in zip(hidden, names, strict=True)),
        tokens.cast("bigint").alias("n_tokens"),
        (F.col("frequent") + rare_known + F.lit(int(known.ends > 0))).cast("bigint").alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + rare_base + F.lit(float(np.log10(known.ends + 1.0))) - tokens * F.lit(known.base)).alias("base_score"),
        (F.col("modelled") + F.col("spelt") + rare_base - F.col("unnamed") * F.lit(float(np.log10(other_tokens + other_words + 1)))).alias("score"),
    )


def score_documents(docs: DataFrame, training: Column, text: str = "text", id_column: str = "doc_id", rounds: int = ROUNDS, stride: int = STRIDE, frequent: int = FREQUENT, vocabulary: int = VOCABULARY) -> tuple[DataFrame, Unigrams, Gru]:
    """Every document scored by a model of the rows for which ``training`` is true; also the counts and the model.

    Keeps the other columns; those that have the name of a result are replaced.
    """
    learnt = docs.where(training)
    words = stored(count_words(learnt, text))
    known = unigrams(words, learnt.count(), frequent, vocabulary)
    names = [c for c in docs.columns if c not in (text, *RESULTS)]
    coded = symbolized(docs, known, text, id_column, names, training)
    model = train(coded, known, rounds, stride)
    return score(coded, words, known, model, names), known, model
