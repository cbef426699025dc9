"""Maximal periodic runs of words, from a suffix automaton read through link-cut accesses.

The automaton of a text has a state for each class of word strings that end at the same places, and
its suffix links form a tree in which the suffixes of every prefix are a path to the root.  Words
are appended one after the other; the access of prefix i walks its path, which a link-cut tree
keeps as segments of states that last occurred at the same end, and recolours the path with i.  A
segment of last end e that reaches up to length n says that the longest common suffix of the
prefixes i and e is n words.  With the distance d = i - e at most n there is a square of period d at i;
as n is the whole extension to the left, the run that ends at i starts at i - d - n, and it is maximal where the
next word breaks the period.  d is the smallest period: a smaller one would have given the segment
a later end.  So every run is found once, at its end, by accesses of amortised logarithmic cost.

Only words that can lie in a run are appended.  A run of at least ``WORDS`` words and ``PERIODS``
periods holds every string of ``GRAM`` words in it at least twice, so a stretch of words not covered
by repeated strings of that length is left out (runs end before it).  Strings are compared by
64-bit hashes there, of which a collision costs time only.

Defined cases: a null or empty text has no words and no run; rows count as often as they come in, and
ids are never looked at; an empty table gives no rows; columns that have the name of a result are
replaced; a text of any length is one automaton at most, of about a hundred bytes a word.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import as_bytes, as_strings, map_arrow, mix64, slices

#: Least words and least periods of a run.
WORDS, PERIODS = 24, 3
FOUND = ["n_words", "runs", "collapsed"]


class SuffixAutomaton:
    """States 1 (the empty string) to ``states``; a state's only transition lies in two arrays, further ones in a dictionary."""

    def __init__(self, words: list[int]):
        room = 2 * len(words) + 2
        self.length, self.link = array("i", bytes(4 * room)), array("i", bytes(4 * room))
        self._word, self._target = array("i", [-1]) * room, array("i", bytes(4 * room))
        self._more: dict[int, dict[int, int]] = {}
        self.states = 1
        self.prefixes = array("i")  # the state of each prefix
        last = 1
        for word in words:
            last = self._append(last, word)
            self.prefixes.append(last)

    def _append(self, last: int, word: int) -> int:
        length, link, own, target, more = self.length, self.link, self._word, self._target, self._more
        self.states = new = self.states + 1
        length[new] = length[last] + 1
        at, found = last, 0
        while at:
            if own[at] == word:
                found = target[at]
                break
            if own[at] < 0:
                own[at], target[at] = word, new
            elif (others := more.get(at)) is None:
                more[at] = {word: new}
            elif word in others:
                found = others[word]
                break
            else:
                others[word] = new
            at = link[at]
        if not found:
            link[new] = 1
        elif length[at] + 1 == length[found]:
            link[new] = found
        else:
            self.states = copy = new + 1
            length[copy], link[copy] = length[at] + 1, link[found]
            own[copy], target[copy] = own[found], target[found]
            if found in more:
                more[copy] = dict(more[found])
            link[found] = link[new] = copy
            while at:
                if own[at] == word:
                    if target[at] != found:
                        break
                    target[at] = copy
                elif (others := more.get(at)) is not None and others.get(word) == found:
                    others[word] = copy
                else:
                    break
                at = link[at]
        return new


class LinkCutTree:
    """Paths to the root, kept as splay trees of states of one colour (the last end that recoloured them)."""

    def __init__(self, parents: array):
        self.up = array("i", parents)  # parent in the splay tree, or of the path's top
        self.left, self.right = array("i", bytes(4 * len(parents))), array("i", bytes(4 * len(parents)))
        self.colour = array("i", bytes(4 * len(parents)))  # of a path, at the root of its splay tree; 0: none

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if not inner:
                self.colour[x] = self.colour[p]  # p was the root
                self._rotate(x, p, g)
                return
            above = up[g]
            if not above or (left[above] != g and right[above] != g):
                self.colour[x] = self.colour[g]
            if (left[g] == p) == (left[p] == x):
                self._rotate(p, g, above)
                self._rotate(x, p, above)
            else:
                self._rotate(x, p, g)
                self._rotate(x, g, above)

    def _rotate(self, x: int, p: int, g: int) -> None:
        up, left, right = self.up, self.left, self.right
        if left[p] == x:
            inside = right[x]
            left[p], right[x] = inside, p
        else:
            inside = left[x]
            right[p], left[x] = inside, p
        if inside:
            up[inside] = p
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[p], up[x] = x, g

    def access(self, state: int, colour: int) -> list[tuple[int, int]]:
        """(colour, lowest state) of each segment from ``state`` to the root; all of them take the new colour."""
        up, right, colours = self.up, self.right, self.colour
        met = []
        below, x = 0, state
        while x:
            self._splay(x)
            if colours[x]:
                met.append((colours[x], x))
            if right[x]:
                colours[right[x]] = colours[x]  # what hangs below keeps its colour
            right[x] = below
            below, x = x, up[x]
        colours[below] = colour
        return met


def runs_of(words: list[int], least: int = WORDS, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal run; ``words`` are numbers from 0, ``periods`` at least 2."""
    automaton = SuffixAutomaton(words)
    tree = LinkCutTree(automaton.link[: automaton.states + 1])
    length, out, n = automaton.length, [], len(words)
    for end, state in enumerate(automaton.prefixes, 1):
        for before, reached in tree.access(state, end):
            period, common = end - before, length[reached]
            if common >= (periods - 1) * period and common + period >= least and (end == n or words[end] != words[end - period]):
                out.append((before - common, common + period, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _gram(least: int, periods: int) -> int:
    """Words of a string that every run holds twice: a run of n words and period q has n - gram + 1 of them, at least 2 q."""
    return max(1, least - (2 * least) // periods)


def _stretches(codes: np.ndarray, sizes: np.ndarray, least: int, periods: int) -> Iterator[tuple[int, int, int]]:
    """(text, begin, end) of the stretches, in words of the joined texts, that repeated strings of words cover."""
    gram = _gram(least, periods) if periods > 2 else 1
    if len(codes) < gram:
        return
    base = np.uint64(0x9E3779B97F4A7C15)
    values = mix64(codes.astype(np.uint64) + base)
    hashes, width = np.zeros(len(codes) - gram + 1, dtype=np.uint64), len(codes) - gram + 1
    for k in range(gram):
        hashes = hashes * base + values[k : k + width]
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(text[:width] == text[gram - 1 :])  # strings that stay in their text
    if not len(starts):
        return
    keys = mix64(hashes[starts] + text[starts].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    opened = np.bincount(starts[twice], minlength=len(codes))
    inside = np.cumsum(opened) - np.cumsum(np.concatenate((np.zeros(gram, dtype=np.int64), opened))[: len(codes)]) > 0
    first = np.zeros(len(codes), dtype=bool)
    first[(ends - sizes)[sizes > 0]] = True
    begins = np.flatnonzero(inside & (first | ~np.concatenate(([False], inside[:-1]))))
    follows = np.concatenate((inside[1:] & ~first[1:], [False]))
    stops = np.flatnonzero(inside & ~follows) + 1
    for begin, stop in zip(begins.tolist(), stops.tolist(), strict=True):
        if stop - begin >= least:
            yield int(text[begin]), begin, stop


def find(texts: list[bytes], least: int = WORDS, periods: int = PERIODS) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words of each text and its runs."""
    said = [t.split() for t in texts]
    sizes = np.array([len(w) for w in said], dtype=np.int64)
    joined = pa.array([w for own in said for w in own], pa.large_binary())
    codes = joined.dictionary_encode().indices.to_numpy()
    before = np.cumsum(sizes) - sizes
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, begin, stop in _stretches(codes, sizes, least, periods):
        _, own = np.unique(codes[begin:stop], return_inverse=True)
        runs[text] += [(begin - int(before[text]) + start, length, period) for start, length, period in runs_of(own.tolist(), least, periods)]
    return said, runs


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    out, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in runs):
        if begin > at:
            out += words[at:begin]
        at = max(at, end)
    return b" ".join(out + words[at:])


def find_runs(docs: DataFrame, text: str = "text", least: int = WORDS, periods: int = PERIODS) -> DataFrame:
    """The other columns of ``docs`` and n_words, runs (start, length, period; by start, then period), collapsed.

    Words are runs of bytes other than ASCII white space.  A run is a maximal stretch of at least ``least`` words and
    ``periods`` times its smallest period; ``collapsed`` leaves each run its first period.
    """
    if periods < 2 or least < 1:
        raise ValueError("a run has two periods at least, and a word")
    keep = [c for c in docs.columns if c != text and c not in FOUND]
    hidden = [f"kept{k}" for k in range(len(keep))]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                said, runs = find(as_bytes(part.column("text")), least, periods)
                collapsed = as_strings([_kept(w, r) for w, r in zip(said, runs, strict=True)])
                told = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], kind)
                yield pa.RecordBatch.from_arrays([*(part.column(h) for h in hidden), pa.array([len(w) for w in said], pa.int64()), told, collapsed], [*hidden, *FOUND])

    rows = docs.select(*(F.col(c).alias(h) for c, h in zip(keep, hidden, strict=True)), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            *(T.StructField(h, docs.schema[c].dataType) for c, h in zip(keep, hidden, strict=True)),
            *T._parse_datatype_string("n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string").fields,
        ]
    )
    return map_arrow(rows, apply, schema).select(*(F.col(h).alias(c) for c, h in zip(keep, hidden, strict=True)), *FOUND)
