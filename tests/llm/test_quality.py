"""Quality classifier: held-out accuracy, hashed features, defined cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tillwise.llm import quality, queries


def test_held_out_accuracy(spark, data):
    found = queries.op1_quality_classifier(spark, "/root/testdata/sf0.01").join(data("labels", "0.01"), "doc_id").where("held_out").collect()
    assert found and sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in found) >= 0.93 * len(found)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_features_are_normalised_sparse_vectors():
    texts = [b"", b"a b a", "über %% über".encode(), b"x" * 100_000, b"same same same"]
    ids, values, sizes = quality.features(texts)
    assert sizes[0] == 0 and sizes[1] == 4 and sizes[3] == 1  # a, b, ab, ba
    at = 0
    for size in sizes:
        assert size == 0 or abs(np.square(values[at : at + size]).sum() - 1) < 1e-5
        at += size
    both, _, n = quality.features([b"same same", b"other other"])
    assert set(both[: n[0]]) & set(both[n[0] :])  # a token said twice is one pair for all tokens


def test_leader_separates():
    model = quality.FollowTheRegularisedLeader(4)
    for _ in range(200):
        model.update(np.array([0, 1]), np.array([1.0, 0.5]), 1)
        model.update(np.array([2, 1]), np.array([1.0, 0.5]), 0)
    w = model.weights(np.arange(5))
    assert w[0] > 0.5 and w[2] < -0.5 and w[3] == 0


def test_defined_cases(spark, frame):
    docs = frame([(k, "good words here" if k % 2 else "%% $$ %%", "en") for k in range(1, 41)] + [(50, None, None), (51, "", None), (51, "", None), (None, "good words here " * 9000, None)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 41)] + [(3, None, 0), (None, 1, 0), (5, 7, 0)], "doc_id bigint, quality int, toxic int")
    out = quality.score(docs, quality.fit(docs, labels, train=F.col("doc_id") < 1000))
    assert out.columns[-1] == "score" and out.count() == 44
    by = {}
    for r in out.select("doc_id", "score").collect():
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[1][0] > 0.5 > by[2][0] and by[None][0] > 0.5 and len(by[51]) == 2 and 0 <= by[50][0] <= 1


def test_empty_tables(spark, frame):
    docs = frame([(1, "a", "en")])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, none)
    assert [r["score"] for r in quality.score(docs, model).collect()] == [0.5]
    assert quality.score(docs.where(F.lit(False)), model).count() == 0


def plain_vector(text, bits=quality.BITS):
    """{hashed id: value} of one text, counted token by token."""
    top, base = 2**64, 0x9E3779B97F4A7C15

    def mixed(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> shift)) * factor % top
        return x ^ (x >> 31)

    said = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-\x7f]+", text)
    tokens = [mixed((sum((b + 1) * pow(base, k, top) for k, b in enumerate(t)) + len(t)) % top) for t in said]
    pairs = [0xA5A5A5A5A5A5A5A5 if a == b else mixed((a * 0xC2B2AE3D27D4EB4F + b) % top) for a, b in zip(tokens, tokens[1:], strict=False)]
    counts = Counter(k >> (64 - bits) for k in tokens + pairs)
    norm = math.sqrt(sum(math.log1p(n) ** 2 for n in counts.values()))
    return {k: math.log1p(n) / norm for k, n in counts.items()}


def plain_weight(z, n, l1):
    return 0.0 if abs(z) <= l1 else (math.copysign(l1, z) - z) / ((quality.BETA + math.sqrt(n)) / quality.ALPHA + quality.L2)


def test_query_against_plain_updates_and_scores(spark, data):
    """The whole query, learnt and scored again one coordinate at a time."""
    texts = {r["doc_id"]: plain_vector((r["text"] or "").encode()) for r in data("documents").collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    rows = sorted((r["doc_id"], r["quality"]) for r in data("labels").collect() if r["quality"] in (0, 1) and not held(r["doc_id"]) and r["doc_id"] in texts)
    z, n = Counter(), Counter()
    for epoch in range(quality.EPOCHS):
        for k in np.random.default_rng(42 + epoch).permutation(len(rows)):
            x = {**texts[rows[k][0]], "bias": 1.0}
            w = {i: plain_weight(z[i], n[i], 0.0 if i == "bias" else quality.L1) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - rows[k][1]) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    final = {i: plain_weight(z[i], n[i], 0.0 if i == "bias" else quality.L1) for i in z}
    found = queries.op1_quality_classifier(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(texts) and rows
    for r in found:
        want = 1 / (1 + math.exp(-final.get("bias", 0.0) - sum(final.get(i, 0.0) * v for i, v in texts[r["doc_id"]].items())))
        assert r["held_out"] == held(r["doc_id"]) and abs(r["score"] - want) < 1e-4
