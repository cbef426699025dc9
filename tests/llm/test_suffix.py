"""Suffix-array dedup against a set of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import queries, suffix
from tillwise.llm.common import PrefixHash


def masks(texts, match):
    seen = Counter(t[k : k + match] for t in texts for k in range(len(t) - match + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - match + 1):
            if seen[t[k : k + match]] > 1:
                gone[k : k + match] = True
        out.append(gone)
    return out


def spans(gone):
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def check(df, match, **options):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in df.collect()]
    want = Counter((i, len(t), tuple(spans(g)), bytes(np.frombuffer(t, np.uint8)[~g])) for (i, t), g in zip(rows, masks([t for _, t in rows], match), strict=True))
    got = suffix.remove_repeats(df, keep=["doc_id"], match=match, **options).collect()
    assert Counter((r["doc_id"], r["n_bytes"], tuple((s["begin"], s["end"]) for s in r["removed"]), bytes(r["kept"])) for r in got) == want


@pytest.mark.parametrize("gram,lane", [(10, 4096), (16, 3)])
def test_equals_brute_force(spark, gram, lane):
    rng = np.random.default_rng(gram)
    parts = ["".join(rng.choice(list("abcé \n"), 50)) for _ in range(15)]
    rows = [(k, "".join(parts[p] if rng.random() < 0.8 else parts[p][: rng.integers(3, 45)] for p in rng.integers(0, 15, rng.integers(0, 9)))) for k in range(90)]
    rows += [(500, None), (501, ""), (502, "z" * 300), (503, rows[4][1]), (503, rows[4][1]), (None, rows[7][1])]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), 40, gram=gram, lane=lane)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "_CHUNK", 512)
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefgh"), 3000))
    passage = "".join(rng.choice(list("abcdefgh"), 120))
    rows = [(1, text[:1000] + passage + text[1000:] + passage), (2, text[500:700] + "x" * 30 + passage[10:]), (3, text[200:230])]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), 40, gram=12)


def test_query_against_brute_force(spark, data):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in data("documents").collect()]
    want = {}
    for (i, t), gone in zip(docs, masks([t for _, t in docs], 200), strict=True):
        want[i] = (len(t), int(gone.sum()), len(spans(gone)), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
    found = queries.op10_suffix_array_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == want


def test_suffix_order_is_a_sort():
    rng = np.random.default_rng(0)
    data = rng.choice(np.frombuffer(b"aab", np.uint8), 400)
    limit = 12
    classes = np.sort(rng.integers(0, 6, 200))
    starts = rng.integers(0, 400 - limit, 200)
    order = suffix.suffix_order(data, PrefixHash(data), starts, classes, limit)
    keys = [(int(classes[k]), data[starts[k] : starts[k] + limit].tobytes()) for k in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(200))
    x, y = starts[:100], starts[100:]
    shared = suffix.common_extension(PrefixHash(data), x, y, limit)
    for a, b, n in zip(x, y, shared, strict=True):
        assert (data[a : a + n] == data[b : b + n]).all() and (n == limit or data[a + n] != data[b + n])


def test_extra_columns_and_empty_tables(frame):
    docs = frame([(1, "ab" * 300, "en"), (2, "ab" * 300, None), (3, None, None)])
    cut = suffix.remove_repeats(docs)
    assert cut.columns == [*[c for c in docs.columns if c != "text"], "n_bytes", "removed", "kept"]
    assert sorted((r["doc_id"], len(r["kept"])) for r in cut.collect()) == [(1, 0), (2, 0), (3, 0)]
    assert suffix.remove_repeats(docs.where(F.lit(False))).count() == 0
    clash = suffix.remove_repeats(docs.withColumn("kept", F.lit(1)).withColumnRenamed("row", "n_bytes"))
    assert clash.columns == ["doc_id", "lang", "source", "n_chars", "score", "word", "n_bytes", "removed", "kept"]
    assert {len(r["kept"]) for r in clash.collect()} == {0}


def test_contexts_that_collide_are_told_apart():
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("abcdefgh"), 260)) for _ in range(6)]
    gram = texts[0][100:148]
    texts = [t[:100] + gram + t[148:] for t in texts] + [texts[0]]  # one anchor, other contexts

    def same_polynomial(*args):
        found = list(suffix._anchors(*args))
        found[5] = found[5] * np.uint64(0)  # every context hash collides
        return tuple(found)

    starts, sizes = np.cumsum([0, *map(len, texts[:-1])]), np.array(list(map(len, texts)))
    text, *_, grams, context, check = same_polynomial(np.frombuffer("".join(texts).encode(), dtype=np.uint8), starts, sizes, 200, 48)
    keys = {}
    for t, g, c, x in zip(text.tolist(), grams.tolist(), context.tolist(), check.tolist(), strict=True):
        keys.setdefault((g, c, x), set()).add(t)
    assert all(k == {0, 6} or len(k) == 1 for k in keys.values()) and any(k == {0, 6} for k in keys.values())


def test_long_repetitive_text_beside_short_ones(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefgh"), 400)) for _ in range(4)]
    texts = [*texts, texts[1] + "tail", "x" + texts[2][:250]]
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # all texts in one slice
    try:
        rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
        long_ = spark.range(1).select(F.lit(99).cast("bigint").alias("doc_id"), F.expr("repeat('one line that says the same again and again, to the end\n', 310000)").alias("text"))
        got = suffix.remove_repeats(long_.union(rows).coalesce(1)).select("doc_id", "n_bytes", F.col("removed").cast("string").alias("removed")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    size = 310000 * 56
    assert size > 1 << 24
    assert {r["doc_id"]: (r["n_bytes"], r["removed"]) for r in got} == {
        99: (size, f"[{{0, {size}}}]"), 0: (400, "[]"), 1: (400, "[{0, 400}]"), 2: (400, "[{0, 250}]"), 3: (400, "[]"), 4: (404, "[{0, 400}]"), 5: (251, "[{1, 251}]"),
    }
