"""Vector codes: codebooks, codes and errors equal plain k-means in Python's integers."""

import hashlib
import math

import numpy as np
import pytest

from tillwise.llm import queries, vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, dim int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows: (vec_id, vector, label) of one length, none null; {position: (code, error)}, label totals, digest."""
    whole = [[math.floor(scale * x) for x in v] for _, v, _ in rows]
    dim = len(whole[0])
    edges, at = [], 0
    for p in range(parts):
        edges.append((at, at := at + dim // parts + (p < dim % parts)))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[whole[i][a:b] for i in order] for a, b in edges]
    near = lambda x, book: min((sum((p - q) ** 2 for p, q in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for book, (a, b) in zip(books, edges, strict=True):
            own = [[] for _ in book]
            for v in whole:
                own[near(v[a:b], book)[1]].append(v[a:b])
            for k, members in enumerate(own):
                if members:
                    book[k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    found = [[near(v[a:b], book) for book, (a, b) in zip(books, edges, strict=True)] for v in whole]
    errors = [sum(d for d, _ in f) for f in found]
    totals = {}
    for (_, _, label), e in zip(rows, errors, strict=True):
        totals[label] = totals.get(label, 0) + e
    told = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((r[0] is not None, r[0] or 0), "".join(f"{k:02x}" for _, k in f), min(e, 2**63 - 1), min(totals[r[2]], 2**63 - 1)) for r, f, e in zip(rows, found, errors, strict=True)), told


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, label, "old", 9) for i, v, label in rows], SCHEMA)
    coded, books = vector_codes.compress(df, **how)
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    return sorted(((r["vec_id"] is not None, r["vec_id"] or 0), r["code"], r["error"], r["label_error"]) for r in coded.collect()), vector_codes.digest(books)


@pytest.mark.parametrize("dim,parts,entries,n", [(16, 8, 16, 300), (11, 4, 5, 90), (8, 8, 100, 150), (6, 2, 16, 9)])
def test_equals_brute_force(spark, dim, parts, entries, n):
    rng = np.random.default_rng(dim)
    rows = [(i, [float(x) for x in rng.normal(size=dim).round(rng.integers(0, 3))], [None, 1, 1, 2][i % 4]) for i in range(n)]
    rows += rows[: n // 5]  # repeated rows, and ties of distance by rounding
    assert run(spark, rows, parts=parts, entries=entries, rounds=3) == brute(rows, parts, entries, 3)


def test_query_against_brute_force(spark, data):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in data("embeddings").collect()]
    want, told = brute(rows)
    got = queries.op11_vector_codes(spark, "/root/testdata/sf0.001").collect()
    assert sorted(((True, r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {told}


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    for scale in (1e4, 1e9, 1e30):
        rows = [(i, [float(x) for x in rng.normal(size=8) * scale], i % 2) for i in range(40)]
        assert run(spark, rows, entries=4, rounds=2) == brute(rows, 8, 4, 2)


def test_candidates_hold_every_entry_in_the_box():
    rng = np.random.default_rng(1)
    book = vector_codes.SlicedCodebook(rng.integers(-9, 9, (130, 3)))
    x, radius = rng.integers(-9, 9, (50, 3)), rng.integers(0, 6, 50)
    masks = book.candidates(x, radius)
    inside = (np.abs(x[:, None] - book.entries[None]) <= radius[:, None, None]).all(axis=2)
    assert [[bool(int(m[k // 64]) >> (k % 64) & 1) for k in range(130)] for m in masks] == inside.tolist()


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(90, None, 1), (91, [1.0, None], 1), (92, [nan, 1.0], 1), (93, [-inf, 1.0], None)]
    rows = [(0, [0.0, 1.0], None), (0, [0.0, 1.0], 3), (7, [0.0, -1.0], None), (None, [0.5, 0.5], 3)]
    assert run(spark, rows + bad, parts=2, entries=3, rounds=2) == brute(rows, 2, 3, 2)
    other = [(5, [1.0, 2.0, 3.0], None), (6, [], 4)]  # lengths apart, labels together
    got, _ = run(spark, rows + other, parts=2, entries=3, rounds=2)
    assert [g[1:3] for g in got if g[0][1] in (5, 6)] == [("0000", 0), ("0000", 0)] and len(got) == 6
    for empty in ([], bad):
        assert run(spark, empty)[0] == []
