"""Removal of long repeated byte strings by a hash-compared suffix sort.

Every string of ``MATCH`` bytes that starts in two places of the corpus is removed wherever
it stands.  Sorting all suffixes of a corpus in one order would shuffle every byte many
times over, so suffixes are dealt to tasks by an anchor: of the ``GRAM``-byte strings
inside a ``MATCH``-byte window the one of least hash (leftmost of equals).  Equal windows
have equal anchors at equal offsets, so both reach the same group.

1. Each text gives its anchors (one in about ``(MATCH - GRAM) / 2`` bytes) with the context
   that their windows span and its hash.  Anchors whose hash occurs once are dropped.
2. Equal contexts (of equal polynomial hash and equal XXH3 of their bytes, 128 bits of two kinds) are
   counted, combined before the shuffle: a context that occurs twice is
   repeated as a whole and needs no sorting; one of its copies stays to be compared.
3. The distinct contexts of an anchor meet in a task, which sorts the suffixes that start
   their windows.  Prefix polynomial hashes and a binary search give the common extension
   of two suffixes, so one comparison takes a logarithmic number of steps; a mergesort
   orders all classes of the task at once; neighbours with a common extension of ``MATCH``
   are repeats, once their bytes have been compared, too.
4. Anchors with many distinct contexts are split into lanes of about ``LANE``; each lane
   is sorted by itself and passes one strong digest of each distinct window on, so that
   windows which repeat across lanes are found by a combined count.
5. Repeated spans come together by text and are cut out.

Texts stay compressed in a table bucketed by row number, which the joins of steps 3 and 5 read without
shuffling it again.

Defined cases: null counts as the empty text; texts under ``MATCH`` bytes lose nothing;
repeated rows are copies of each other and lose everything from ``MATCH`` bytes on; strings
never run across texts; an empty table gives no rows; columns that have the name of a result are replaced.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import PrefixHash, as_bytes, map_arrow, mix64, runs_to_positions, shared_dir, shuffle_partitions, slices, stored

#: Bytes of a match; bytes of an anchor; contexts of one lane.
MATCH, GRAM, LANE = 200, 48, 8192
_CHUNK, _SUFFIXES = 1 << 20, 200_000
_POSITION = np.uint64((1 << 24) - 1)
_ORDER = ~_POSITION


# anchors ------------------------------------------------------------------------------------


def _sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours: prefix and suffix minima of blocks of that width."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts that stand one after the other: (text, start of context, its length, offset of the anchor in it, anchor hash, context hash, check)."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < match:
        return none, none, none, none, *[none.astype(np.uint64)] * 3
    hashes = PrefixHash(data)
    at = np.arange(len(data) - gram + 1)
    grams = mix64(hashes.of(at, at + gram))
    least = _sliding_minimum((grams & _ORDER) | at.astype(np.uint64), match - gram + 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    window = np.arange(len(least))
    inside = window + match <= (starts + sizes)[owner[: len(least)]]
    window, spot = window[inside], (least[inside] & _POSITION).astype(np.int64)
    # windows of one anchor follow one another
    new = np.concatenate(([True], (spot[1:] != spot[:-1]) | (owner[window[1:]] != owner[window[:-1]])))
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none, none, *[none.astype(np.uint64)] * 3
    last = np.append(first[1:], len(window)) - 1
    spot, begin, end = spot[first], window[first], window[last] + match
    context = mix64(hashes.of(begin, end) + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (spot - begin).astype(np.uint64))
    text = owner[begin]
    whole = memoryview(data)
    check = np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)), dtype=np.uint64, count=len(begin))
    return text, begin - starts[text], end - begin, spot - begin, grams[spot], context, check


ANCHOR_SCHEMA = "row bigint, at bigint, size int, offset int, gram bigint, context bigint, check bigint"


def _anchor_rows(texts: DataFrame, match: int, gram: int) -> DataFrame:
    def batch(rows: np.ndarray, found: tuple[np.ndarray, ...], shift: int = 0) -> pa.RecordBatch:
        text, at, size, offset, grams, context, check = found
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[text]), pa.array(at + shift), pa.array(size.astype(np.int32)), pa.array(offset.astype(np.int32)), *(pa.array(h.view(np.int64)) for h in (grams, context, check))],
            ["row", "at", "size", "offset", "gram", "context", "check"],
        )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            for part in slices(one, "n_bytes", _CHUNK):
                rows = part.column("row").to_numpy()
                data = [unpack(p, n) for p, n in zip(part.column("packed").to_pylist(), part.column("n_bytes").to_pylist(), strict=True)]
                if len(data) == 1 and len(data[0]) > 2 * _CHUNK:
                    # a long text goes piece by piece; pieces share match - 1 bytes, so each window is in exactly one
                    for at in range(0, len(data[0]) - match + 1, _CHUNK):
                        piece = np.frombuffer(data[0][at : at + _CHUNK + match - 1], dtype=np.uint8)
                        yield batch(rows, _anchors(piece, np.zeros(1, np.int64), np.array([len(piece)]), match, gram), at)
                    continue
                sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
                yield batch(rows, _anchors(np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes, match, gram))

    return map_arrow(texts.where(F.col("n_bytes") >= match).select("row", "packed", "n_bytes"), apply, ANCHOR_SCHEMA)


# suffix sort --------------------------------------------------------------------------------


def common_extension(hashes: PrefixHash, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix, up to ``limit``, of the suffixes at x and y: a binary search over prefix hashes."""
    low, high = np.zeros(len(x), dtype=np.int64), np.full(len(x), limit, dtype=np.int64)
    sx, sy, ix, iy = hashes.sums[x], hashes.sums[y], hashes.inverse[x], hashes.inverse[y]
    for _ in range(int(limit).bit_length()):
        middle = (low + high + 1) >> 1
        same = (hashes.sums[x + middle] - sx) * ix == (hashes.sums[y + middle] - sy) * iy
        low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
    return low


def _compare(data: np.ndarray, hashes: PrefixHash, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
    """Below, at or over zero as the suffix at x comes before, with or after the one at y."""
    out = np.zeros(len(x), dtype=np.int16)
    open_ = np.flatnonzero(hashes.of(x, x + limit) != hashes.of(y, y + limit))
    x, y = x[open_], y[open_]
    shared = np.minimum(common_extension(hashes, x, y, limit), limit - 1)
    out[open_] = data[x + shared].astype(np.int16) - data[y + shared]
    return out


def suffix_order(data: np.ndarray, hashes: PrefixHash, suffixes: np.ndarray, classes: np.ndarray, limit: int) -> np.ndarray:
    """Order that sorts the suffixes of each class (classes stand together) by their first ``limit`` bytes.

    A bottom-up mergesort of all classes at once: every element finds its place in the
    run beside its own by binary search, with one hash-compared suffix comparison a step.
    """
    n = len(suffixes)
    order = np.arange(n)
    if not n:
        return order
    begin = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
    sizes = np.diff(np.append(begin, n))
    slot_begin, slot_size = np.repeat(begin, sizes), np.repeat(sizes, sizes)
    width = 1
    while width < sizes.max():
        slot = np.flatnonzero(slot_size > width)
        first, inside = slot_begin[slot], slot - slot_begin[slot]
        run = inside // width
        left = run % 2 == 0
        low = np.where(left, (run + 1) * width, (run - 1) * width)
        beside = first + low
        high = first + np.minimum(low + width, slot_size[slot])
        paired = beside < high
        slot, left, first, run, beside, low, high = (v[paired] for v in (slot, left, first, run, beside, beside.copy(), high))
        own = suffixes[order[slot]]
        open_ = np.arange(len(slot))
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            sign = _compare(data, hashes, suffixes[order[middle]], own[open_], limit)
            before = np.where(left[open_], sign < 0, sign <= 0)  # stable: equals of the left run stay first
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        target = np.where(left, slot, slot - width) + (low - beside)
        # a right run starts at the end of its left run, which is always full
        merged = order.copy()
        merged[target] = order[slot]
        order = merged
        width *= 2
    return order


def repeated_windows(contexts: list[bytes], offsets: np.ndarray, group: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffix-sort the windows of the contexts of each group.

    Returns, per window: its context, its start in it, whether it repeats within the group,
    and the number of its run of equal windows.
    """
    sizes = np.fromiter(map(len, contexts), dtype=np.int64, count=len(contexts))
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    base = np.cumsum(sizes) - sizes
    counts = sizes - match + 1
    owner = np.repeat(np.arange(len(contexts)), counts)
    start = runs_to_positions(np.zeros(len(contexts), np.int64), counts)
    # windows can be equal only where the anchor lies at the same place in them
    place = offsets[owner] - start
    by_class = np.lexsort((place, group[owner]))
    owner, start, place = owner[by_class], start[by_class], place[by_class]
    classes = group[owner] * (match + 1) + place
    suffixes = base[owner] + start
    hashes = PrefixHash(data)
    order = suffix_order(data, hashes, suffixes, classes, match)
    owner, start, classes, suffixes = owner[order], start[order], classes[order], suffixes[order]
    same = np.zeros(len(suffixes), dtype=bool)  # as the one before
    beside = np.flatnonzero(classes[1:] == classes[:-1]) + 1
    equal = beside[common_extension(hashes, suffixes[beside], suffixes[beside - 1], match) >= match]
    span = np.arange(match)
    for at in range(0, len(equal), 8192):  # equal hashes are confirmed by the bytes
        some = equal[at : at + 8192]
        same[some] = (data[suffixes[some][:, None] + span] == data[suffixes[some - 1][:, None] + span]).all(axis=1)
    repeated = same.copy()
    repeated[:-1] |= same[1:]
    return owner, start, repeated, np.cumsum(~same)


SORT_SCHEMA = "row bigint, begin bigint, end bigint, gram bigint, place int, digest binary, lonely boolean"


def _sorted_groups(contexts: DataFrame, match: int) -> DataFrame:
    """Spans of rows whose context occurs once (``digest`` null), and window digests of groups of several lanes."""
    columns = ["gram", "lane", "lanes", "row", "at", "n", "offset", "bytes"]
    dealt = contexts.select(*columns).repartition("gram", "lane").sortWithinPartitions("gram", "lane")

    def work(batch: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch]:
        gram, lane, lanes, row, at, n, offset = (batch.column(c).to_numpy() for c in columns[:-1])
        group = np.cumsum(np.concatenate(([True], (gram[1:] != gram[:-1]) | (lane[1:] != lane[:-1]))))
        texts = batch.column("bytes").to_pylist()
        owner, start, repeated, run = repeated_windows(texts, offset, group, match)
        # neighbouring windows of contexts that stand once in the corpus make spans
        mine = np.flatnonzero(repeated & (n[owner] == 1))
        mine = mine[np.lexsort((start[mine], owner[mine]))]
        o, s = owner[mine], start[mine]
        new = np.concatenate(([True], (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1))) if len(mine) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(mine))[: len(first)] - 1
        begin, end = at[o[first]] + s[first], at[o[first]] + s[last] + match
        empty = pa.nulls(len(first), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[o[first]]), pa.array(begin), pa.array(end), pa.array(gram[o[first]]), pa.nulls(len(first), pa.int32()), empty, pa.nulls(len(first), pa.bool_())],
            [c.split()[0] for c in SORT_SCHEMA.split(", ")],
        )
        # one of each run of equal windows speaks for its lane
        heads = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.zeros(0, np.int64)
        heads = heads[lanes[owner[heads]] > 1]
        if len(heads):
            o, s = owner[heads], start[heads]
            digests = [hashlib.blake2b(texts[a][b : b + match], digest_size=16).digest() for a, b in zip(o.tolist(), s.tolist(), strict=True)]
            lonely = ~repeated[heads] & (n[o] == 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[o]), pa.array(at[o] + s), pa.array(at[o] + s + match), pa.array(gram[o]), pa.array((offset[o] - s).astype(np.int32)), pa.array(digests, pa.binary()), pa.array(lonely)],
                [c.split()[0] for c in SORT_SCHEMA.split(", ")],
            )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        step = max(1, _SUFFIXES // 100)
        for batch in batches:
            for k in range(0, batch.num_rows, step):
                table = pa.Table.from_batches([batch.slice(k, step)])
                table = table if rest is None else pa.concat_tables([rest, table])
                gram, lane = table.column("gram").to_numpy(), table.column("lane").to_numpy()
                cut = int(np.argmax((gram == gram[-1]) & (lane == lane[-1])))
                if cut:
                    yield from work(table.slice(0, cut).combine_chunks())
                rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from work(rest.combine_chunks())

    return map_arrow(dealt, apply, SORT_SCHEMA)


# texts --------------------------------------------------------------------------------------


def pack(text: bytes) -> bytes:
    return pa.compress(text, codec="zstd", asbytes=True) if text else b""


def unpack(packed: bytes, n_bytes: int) -> bytes:
    return pa.decompress(packed, decompressed_size=n_bytes, codec="zstd", asbytes=True) if n_bytes else b""


def _bucketed(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Texts, compressed, in a table bucketed by a row number: later joins on it shuffle their small side only."""
    spark = docs.sparkSession

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data = as_bytes(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *(part.column(f"kept{k}") for k in range(len(keep))), pa.array([len(b) for b in data], pa.int64()), pa.array([pack(b) for b in data], pa.binary())],
                    ["row", *(f"kept{k}" for k in range(len(keep))), "n_bytes", "packed"],
                )

    source = docs.select(F.monotonically_increasing_id().alias("row"), *(F.col(c).alias(f"kept{k}") for k, c in enumerate(keep)), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), *(T.StructField(f"kept{k}", docs.schema[c].dataType) for k, c in enumerate(keep)), T.StructField("n_bytes", T.LongType()), T.StructField("packed", T.BinaryType())])
    name = f"llm_texts_{uuid.uuid4().hex}"
    parts = shuffle_partitions(spark)
    path = f"{shared_dir(spark)}/{name}"
    map_arrow(source, apply, schema).repartition(parts, "row").write.bucketBy(parts, "row").option("path", path).option("compression", "uncompressed").saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved: the files stay, the name is not needed any more
    spark.sql(f"DROP TABLE {name}")
    return table


def _contexts(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """The bytes of each wanted context, cut out of the text that holds it."""
    fields = ["at", "size", "offset", "n", "gram", "lane", "lanes"]
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("wanted"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", *fields, "bytes"]
        for batch in batches:
            for part in slices(batch, "n_bytes", 3 * _CHUNK):
                wanted = part.column("wanted")
                rows = np.repeat(part.column("row").to_numpy(), np.asarray(wanted.value_lengths()))
                flat = wanted.flatten()
                values = {f: flat.field(f).to_numpy() for f in fields}
                cut, at = [], 0
                for packed, n, many in zip(part.column("packed").to_pylist(), part.column("n_bytes").to_pylist(), wanted.value_lengths().to_pylist(), strict=True):
                    text = unpack(packed, n)
                    cut += [text[a : a + s] for a, s in zip(values["at"][at : at + many].tolist(), values["size"][at : at + many].tolist(), strict=True)]
                    at += many
                yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(values[f]) for f in fields), pa.array(cut, pa.binary())], names)

    schema = "row bigint, at bigint, size int, offset int, n bigint, gram bigint, lane bigint, lanes bigint, bytes binary"
    return map_arrow(texts.select("row", "packed", "n_bytes").join(lists, "row"), apply, schema)


def repeated_spans(texts: DataFrame, match: int = MATCH, gram: int = GRAM, lane: int = LANE) -> DataFrame:
    """(row, begin, end): byte spans, which may overlap, that cover exactly what repeated strings of ``match`` bytes cover."""
    if not 0 < gram <= match or match - gram > 32_000:
        raise ValueError("the anchor must fit into the match")
    anchors = stored(_anchor_rows(texts, match, gram))
    # written first: a join with an aggregate of the same stage could not split a hot anchor
    often = stored(anchors.groupBy("gram").agg(F.count("*").alias("often")).where("often > 1").select("gram"))
    shared = stored(anchors.join(often, "gram"))
    own = F.struct("row", "at", "size", "offset")
    contexts = stored(shared.groupBy("gram", "context", "check").agg(F.count("*").alias("n"), F.min(own).alias("own")))
    copied = contexts.where("n > 1").select("gram", "context", "check")
    whole = shared.join(copied, ["gram", "context", "check"]).select("row", F.col("at").alias("begin"), (F.col("at") + F.col("size")).alias("end"))
    several = stored(contexts.groupBy("gram").agg(F.count("*").alias("distinct")).where("distinct > 1"))
    lanes = F.ceil(F.col("distinct") / lane)
    wanted = contexts.join(several, "gram").select("gram", "n", "own.*", lanes.alias("lanes"), F.pmod(F.xxhash64("context"), lanes).alias("lane"))
    found = stored(_sorted_groups(_contexts(wanted, texts), match))
    single = found.where("digest IS NULL").select("row", "begin", "end")
    # across the lanes of one anchor: windows whose digest two lanes have
    windows = found.where("digest IS NOT NULL")
    agreed = windows.groupBy("gram", "place", "digest").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("lonely"), F.struct("row", "begin", "end"))).alias("alone"))
    across = agreed.where("n > 1").select(F.explode("alone").alias("one")).select("one.*")
    return whole.union(single).union(across)


def _merged(spans: list[dict] | None, n_bytes: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["begin"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, text: str = "text", keep: list[str] | None = None, match: int = MATCH, gram: int = GRAM, lane: int = LANE) -> DataFrame:
    """The columns ``keep`` (default: all others), n_bytes, removed (spans of bytes) and kept (the remaining bytes)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, "n_bytes", "removed", "kept")]
    texts = _bucketed(docs, text, keep)
    spans = repeated_spans(texts, match, gram, lane).groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "n_bytes", 3 * _CHUNK):
                removed, kept = [], []
                for packed, n, found in zip(part.column("packed").to_pylist(), part.column("n_bytes").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    gone = _merged(found, n)
                    removed.append([{"begin": a, "end": b} for a, b in gone])
                    data = unpack(packed, n)
                    edges = [0, *(x for pair in gone for x in pair), n]
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays([*(part.column(f"kept{k}") for k in range(len(keep))), part.column("n_bytes"), pa.array(removed, kind), pa.array(kept, pa.binary())], [*keep, "n_bytes", "removed", "kept"])

    schema = T.StructType([*(docs.schema[c] for c in keep), *T._parse_datatype_string("n_bytes bigint, removed array<struct<begin:bigint,end:bigint>>, kept binary").fields])
    return map_arrow(texts.join(spans, "row", "left"), apply, schema)
