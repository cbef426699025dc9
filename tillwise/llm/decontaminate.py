"""Benchmark decontamination by canonical templates.

Text becomes tokens (runs of letters, numbers).  Two views of them are compared:

* literal: the lower-cased tokens;
* template: numbers and number words, units behind a number, and names (capitalised words)
  become typed placeholders, whose values are kept as slots.  A capitalised word that opens a
  sentence may be a name or not: its windows are hashed with it as a word and as a name.

Windows of ``WINDOW`` tokens of both views are hashed.  Hashes of the benchmark are broadcast
in parts of at most ``BROADCAST`` values, one pass over the documents a part, so that
documents pass on only the windows that can match; these are hash-joined with the
benchmark's windows, canonical tokens included.  A document leaks an item if

* ``exact``: the same words run on for ``RUN`` tokens, or for the whole item, or windows of at
  least ``COVER`` of the item are there; or
* ``reparameterised``: template windows of at least ``COVER`` of the item are there in one
  alignment, and the slots are consistent: equal values of the item are equal values in the
  document, of one type, and at least one value has changed.

Template windows need half of their tokens to be words: placeholders alone say nothing.
Items below ``WINDOW`` tokens are one window of their own length; items below
``SHORTEST`` tokens leak only into documents that consist of nothing else.

Defined cases: null, empty and wordless documents or items leak nothing; repeated documents
are judged each for itself; items of equal text all count; a null item id is reported as
null; empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import PrefixHash, as_texts, map_arrow, mix64, powers, slices, stored

#: Tokens of a window; consecutive tokens that leak; share of an item's windows that leaks; shortest item searched inside documents.
WINDOW, RUN, COVER, SHORTEST = 8, 13, 0.8, 5
#: Window hashes broadcast at once.
BROADCAST = 1 << 20

LITERAL, TEMPLATE, WHOLE = 0, 1, 2
_WORD, _NUMBER, _UNIT, _NAME = 0, 1, 2, 3
PLACEHOLDERS = ("", "<number>", "<unit>", "<name>")

# Words that stand for numbers, and units that may follow a number.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg gram grams kilogram kilograms ounce ounces oz pound pounds lb lbs ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees mph kmh"
).split()

_SPACE, _LETTER, _DIGIT, _STOP = 0, 1, 2, 3
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TYPED = np.array([0, 101, 102, 103], dtype=np.uint64)
_VARIANTS = 1 << 19  # made at a time


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: kind, lower-case code point, whether it is upper case."""
    kind, low, upper = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            kind[point] = _LETTER
            one = char.lower()
            if len(one) == 1:
                low[point] = ord(one)
            upper[point] = char.isupper()
        elif char.isdecimal():
            kind[point] = _DIGIT
    for char in ".!?\n":
        kind[ord(char)] = _STOP
    return kind, low, upper


class Tokens:
    """Tokens of many texts, one after the other: place, owner, kind and hashes of both views."""

    def __init__(self, texts: list[str]):
        kind_of, low_of, upper_of = _tables()
        self.texts = texts
        # a stop between texts keeps tokens and sentences apart
        points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.base = np.cumsum(lengths) - lengths
        kind = kind_of[points]
        mark = (points == ord(".")) | (points == ord(","))
        digit = kind == _DIGIT
        if len(points) > 2:
            inner = mark[1:-1] & digit[:-2] & digit[2:]
            kind[1:-1][inner] = _DIGIT  # 1,000 and 2.5 are one number each
        edge = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
        ends = np.append(edge[1:], len(points))
        told = (kind[edge] == _LETTER) | (kind[edge] == _DIGIT)
        self.starts, self.ends = edge[told], ends[told]
        n = len(self.starts)
        self.owner = np.searchsorted(self.base, self.starts, side="right") - 1
        self.literal = mix64(PrefixHash(low_of[points]).of(self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))
        # a token starts a sentence if a stop stands between it and the one before
        stops = np.concatenate(([0], np.cumsum(kind == _STOP)))
        opens = np.ones(n, dtype=bool)
        opens[1:] = stops[self.starts[1:]] > stops[self.ends[:-1]]
        uppers = np.concatenate(([0], np.cumsum(upper_of[points])))
        number = (kind[self.starts] == _DIGIT) | np.isin(self.literal, _hashes("number")) if n else np.zeros(0, bool)
        after = np.zeros(n, dtype=bool)
        after[1:] = number[:-1] & (self.owner[1:] == self.owner[:-1])
        unit = ~number & after & np.isin(self.literal, _hashes("unit")) if n else np.zeros(0, bool)
        capital = ~number & ~unit & upper_of[points[self.starts]] & (uppers[self.ends] - uppers[self.starts] == 1) & (self.ends - self.starts > 1)
        self.either = capital & opens  # a word here, a name in variants
        self.kind = np.select([number, unit, capital & ~opens], [_NUMBER, _UNIT, _NAME], _WORD).astype(np.uint8)
        self.template = np.where(self.kind == _WORD, self.literal, _TYPED[self.kind])
        self.counts = np.bincount(self.owner, minlength=len(texts))
        self.first = np.cumsum(self.counts) - self.counts

    def windows(self, width: int, view: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first token, hash, bits of the opening tokens that are names) of every window of ``width`` tokens within a text, part by part."""
        own = self.literal if view != TEMPLATE else self.template
        n = len(own) - width + 1
        if n <= 0:
            return
        step = powers(_STEP, len(own))
        sums = np.zeros(len(own) + 1, dtype=np.uint64)
        np.cumsum(own * step, dtype=np.uint64, out=sums[1:])
        at = np.arange(n)
        at = at[self.owner[:n] == self.owner[width - 1 :]]
        if view == WHOLE:
            at = at[(self.counts[self.owner[at]] == width)]
        if view != TEMPLATE:
            yield at, self._hashed(at, sums[at + width] - sums[at], width, view), np.zeros(len(at), np.uint64)
            return
        plain = np.concatenate(([0], np.cumsum(self.kind == _WORD)))
        at = at[2 * (plain[at + width] - plain[at]) >= width]
        opening = np.concatenate(([0], np.cumsum(self.either)))
        made = np.cumsum(1 << (opening[at + width] - opening[at]))
        done = 0
        while done < len(at):
            to = max(done + 1, int(np.searchsorted(made, (made[done - 1] if done else 0) + _VARIANTS, side="right")))
            some, done = at[done:to], to
            total, words, names = sums[some + width] - sums[some], plain[some + width] - plain[some], np.zeros(len(some), np.uint64)
            for k in range(width):
                # another name must leave half of the tokens to words
                more = np.flatnonzero(self.either[some + k] & (2 * (words - 1) >= width))
                if len(more):
                    token = some[more] + k
                    total = np.concatenate((total, total[more] + (_TYPED[_NAME] - self.template[token]) * step[token]))
                    words = np.concatenate((words, words[more] - 1))
                    names = np.concatenate((names, names[more] | np.uint64(1 << k)))
                    some = np.concatenate((some, some[more]))
            yield some, self._hashed(some, total, width, view), names

    def _hashed(self, at: np.ndarray, sums: np.ndarray, width: int, view: int) -> np.ndarray:
        return mix64(sums * powers(_BACK, len(self.literal))[at] + np.uint64(width * 4 + view))

    def kinds(self, first: int, width: int, names: int) -> list[int]:
        return [_NAME if names >> k & 1 else kind for k, kind in enumerate(self.kind[first : first + width].tolist())]

    def said(self, first: int, width: int) -> list[str]:
        """The lower-cased tokens of a window."""
        text, base = self.texts[self.owner[first]], self.base[self.owner[first]]
        return [text[a - base : b - base].lower() for a, b in zip(self.starts[first : first + width].tolist(), self.ends[first : first + width].tolist(), strict=True)]

    def canonical(self, first: int, width: int, view: int, names: int) -> str:
        said = self.said(first, width)
        if view == TEMPLATE:
            said = [PLACEHOLDERS[k] or w for k, w in zip(self.kinds(first, width, names), said, strict=True)]
        return " ".join(said)


@cache
def _hashes(what: str) -> np.ndarray:
    """Token hashes of a fixed word list (the list itself holds no number or unit by place)."""
    words = NUMBER_WORDS if what == "number" else UNITS
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes)
    return mix64(PrefixHash(points).of(ends - sizes, ends) + sizes.astype(np.uint64))


WINDOW_SCHEMA = "view int, width int, hash bigint, canonical string, at int, said array<string>, kinds array<int>"


def _rows(tokens: Tokens, view: int, width: int, at: np.ndarray, hashes: np.ndarray, names: np.ndarray) -> list[pa.Array]:
    said = [tokens.said(k, width) for k in at.tolist()]
    return [
        pa.array([view] * len(at), pa.int32()),
        pa.array([width] * len(at), pa.int32()),
        pa.array(hashes.view(np.int64)),
        pa.array([tokens.canonical(k, width, view, bits) for k, bits in zip(at.tolist(), names.tolist(), strict=True)], pa.string()),
        pa.array((at - tokens.first[tokens.owner[at]]).astype(np.int32)),
        pa.array(said, pa.list_(pa.string())),
        pa.array([tokens.kinds(k, width, bits) for k, bits in zip(at.tolist(), names.tolist(), strict=True)], pa.list_(pa.int32())),
    ]


_NAMES = [c.split()[0] for c in WINDOW_SCHEMA.split(", ")]


def benchmark_windows(benchmark: DataFrame, text: str = "text", item: str = "item_id", window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """(item row, item id, number of tokens and of windows a view, window columns) of every item."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = Tokens(as_texts(part.column("text")))
                for view, widths in ((LITERAL, range(shortest, window + 1)), (TEMPLATE, range(shortest, window + 1)), (WHOLE, range(1, shortest))):
                    for width in widths:
                        # the width of an item is the window, or its own length where that is smaller
                        fits = np.minimum(tokens.counts, window) == width
                        parts = [(at[k], hashes[k], names[k]) for at, hashes, names in tokens.windows(width, view) for k in [np.flatnonzero(fits[tokens.owner[at]])]]
                        per_item = sum((np.bincount(tokens.owner[at[names == 0]], minlength=len(tokens.counts)) for at, _, names in parts), np.zeros(len(tokens.counts), np.int64))
                        for at, hashes, names in parts:
                            own = tokens.owner[at]
                            yield pa.RecordBatch.from_arrays(
                                [part.column("item_row").take(pa.array(own)), part.column("item").take(pa.array(own)), pa.array(tokens.counts[own].astype(np.int32)), pa.array(per_item[own].astype(np.int32)), *_rows(tokens, view, width, at, hashes, names)],
                                ["item_row", "item", "tokens", "windows", *_NAMES],
                            )

    source = benchmark.select(F.monotonically_increasing_id().alias("item_row"), F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("item_row", T.LongType()), T.StructField("item", benchmark.schema[item].dataType), *T._parse_datatype_string("tokens int, windows int, " + WINDOW_SCHEMA).fields])
    return map_arrow(source, apply, schema)


def _hits(docs: DataFrame, row: str, text: str, wanted: list[tuple[int, int, np.ndarray]]) -> DataFrame:
    """Windows of the documents whose hash is among the wanted ones of its (view, width)."""

    def sieve(hashes: np.ndarray) -> np.ndarray:
        marks = np.zeros(1 << 22, dtype=bool)
        marks[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        return marks

    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = [(view, width, hashes, sieve(hashes)) for view, width, hashes in shared.value]
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = Tokens(as_texts(part.column("text")))
                for view, width, hashes, marks in marked:
                    for at, own, names in tokens.windows(width, view):
                        some = np.flatnonzero(marks[(own & np.uint64((1 << 22) - 1)).astype(np.int64)])
                        some = some[hashes[np.minimum(np.searchsorted(hashes, own[some]), len(hashes) - 1)] == own[some]]
                        if len(some):
                            at, own, names = at[some], own[some], names[some]
                            yield pa.RecordBatch.from_arrays([part.column("row").take(pa.array(tokens.owner[at])), *_rows(tokens, view, width, at, own, names)], ["row", *_NAMES])

    return map_arrow(docs.select(F.col(row).alias("row"), F.col(text).cast("string").alias("text")), apply, "row bigint, " + WINDOW_SCHEMA)


def _longest_run(places: list[int]) -> int:
    best = run = 0
    for k, at in enumerate(places):
        run = run + 1 if k and at == places[k - 1] + 1 else 1
        best = max(best, run)
    return best


def slots_of(pairs: list[dict]) -> tuple[bool, int]:
    """(consistent, changed values) of one alignment: each value of the item must stand for one value of the document."""
    became: dict[tuple[int, str], set[str]] = defaultdict(set)
    for pair in pairs:
        for kind, said, other in zip(pair["kinds"], pair["item_said"], pair["said"], strict=True):
            if kind != _WORD:
                became[kind, said].add(other)
    changed = sum(value not in others for (_, value), others in became.items())
    return all(len(others) == 1 for others in became.values()), changed


LEAK_SCHEMA = "kind string, covered double, run int, changed int"


def _judge(tokens: int, windows: int, width: int, view: int, pairs: list[dict], run: int, cover: float) -> tuple[str, float, int, int] | None:
    """The leak that the matched windows of one item and view in one document make, if any."""
    by_shift: dict[int, list[dict]] = defaultdict(list)
    for pair in pairs:
        by_shift[pair["at"] - pair["item_at"]].append(pair)
    covered = len({p["item_at"] for p in pairs}) / windows
    longest = max(_longest_run(sorted({p["item_at"] for p in own})) for own in by_shift.values()) + width - 1
    if view != TEMPLATE:
        return ("exact", covered, longest, 0) if covered >= cover or longest >= min(run, tokens) else None
    for told in by_shift.values():
        # of the variants of a window that match, the one of fewest names: an opening word that stays the same is a word
        fewest = {p["item_at"]: p for p in sorted(told, key=lambda p: -p["kinds"].count(_NAME))}
        own = list(fewest.values())
        part = len(own) / windows
        consistent, changed = slots_of(own)
        if part >= cover and consistent and changed:
            return "reparameterised", part, longest, changed
    return None


def leaks(docs: DataFrame, benchmark: DataFrame, row: str, text: str = "text", item_text: str = "text", item: str = "item_id", window: int = WINDOW, run: int = RUN, cover: float = COVER, shortest: int = SHORTEST, broadcast: int = BROADCAST) -> DataFrame:
    """(row, item id, kind, covered, run, changed): items that leak into the documents, which column ``row`` numbers."""
    items = stored(benchmark_windows(benchmark, item_text, item, window, shortest))
    found = []
    keys = items.select("view", "width", "hash").distinct()
    parts = max(1, -(-keys.count() // broadcast))
    for k in range(parts):  # one part for any benchmark of up to ``broadcast`` distinct windows
        table = keys.where(F.pmod(F.col("hash"), F.lit(parts)) == k).toArrow()
        view, width, hashes = (table.column(c).to_numpy() for c in ("view", "width", "hash"))
        wanted = [(int(v), int(w), np.sort(hashes[(view == v) & (width == w)].view(np.uint64))) for v, w in sorted(set(zip(view.tolist(), width.tolist(), strict=True)))]
        if wanted:
            found.append(_hits(docs, row, text, wanted))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("item", benchmark.schema[item].dataType), *T._parse_datatype_string(LEAK_SCHEMA).fields])
    if not found:
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("item", item)
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    same = ["view", "width", "hash", "canonical"]
    pairs = hits.drop("kinds").join(items.withColumnsRenamed({"at": "item_at", "said": "item_said"}), same)
    own = F.struct("at", "item_at", "said", "item_said", "kinds")
    # at most as many windows as an item has in each alignment with the document
    matched = pairs.groupBy("row", "item_row", "item", "tokens", "windows", "width", "view").agg(F.collect_list(own).alias("pairs"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                leak = _judge(r["tokens"], r["windows"], r["width"], r["view"], r["pairs"], run, cover)
                if leak:
                    out.append((r["row"], r["item"], *leak))
            kinds = [pa.int64(), batch.schema.field("item").type, pa.string(), pa.float64(), pa.int32(), pa.int32()]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["row", "item", "kind", "covered", "run", "changed"])

    judged = map_arrow(matched, apply, schema)
    # an exact leak says more than the template it also matches
    best = judged.groupBy("row", "item").agg(F.min(F.struct(F.col("kind"), -F.col("covered"), -F.col("run"), -F.col("changed"))).alias("b"))
    return best.select("row", F.col("item").alias(item), F.col("b.kind").alias("kind"), (-F.col("b.col2")).alias("covered"), (-F.col("b.col3")).alias("run"), (-F.col("b.col4")).alias("changed"))


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    return stored(docs.withColumn(row, F.monotonically_increasing_id()))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """One row for each document and item it leaks: document id, item id, kind, covered, run, changed."""
    row = "_leak_row"
    rows = _numbered(docs.select(id_column, text), row)
    found = leaks(rows, benchmark, row, text, item=item)
    return found.withColumnRenamed("row", row).join(rows.select(row, id_column), row).select(id_column, item, "kind", "covered", "run", "changed")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """The documents that leak no item, with their columns."""
    row = "_leak_row"
    rows = _numbered(docs, row)
    found = leaks(rows, benchmark, row, text, item=item).select(F.col("row").alias(row)).distinct()
    return rows.join(found, row, "left_anti").select(*docs.columns)
