"""SimHash near-dedup: fingerprints, bit slices and components against brute force."""

import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brute_force import classes, fingerprint
from tillwise.llm import queries, simhash
from tillwise.llm.components import components


def got(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_slices_equal_popcounts(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = [base ^ sum(np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64) for _ in range(3)) for _ in range(6)]
    values = rng.permutation(np.concatenate([base, *near]))
    far = np.array([[bin(int(a) ^ int(b)).count("1") for b in values] for a in values])
    i, j = simhash.pairs_across(values, values, radius)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(map(tuple, np.argwhere(far <= radius).tolist()))
    group = np.sort(rng.integers(0, 20, len(values)))
    i, j = simhash.pairs_by_shift(values, group, int(np.bincount(group).max()), radius)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, b in np.argwhere(far <= radius).tolist() if a < b and group[a] == group[b]}


def test_query_against_all_pairs(spark, data):
    docs = [(r["doc_id"], r["text"]) for r in data("documents").collect()]
    assert got(queries.op6_simhash_near_dedup(spark, "/root/testdata/sf0.001")) == classes(docs)


@pytest.mark.parametrize("lane", [256, 4])
def test_links_of_a_dense_group(spark, lane):
    """Many fingerprints that share keys, split into lanes: every link survives."""
    rng = np.random.default_rng(1)
    values = {int(rng.integers(0, 1 << 16)) << 40 for _ in range(60)} | {(1 << k) | (1 << j) for k in range(0, 60, 7) for j in range(0, 60, 5)}
    marks = sorted(values)
    df = spark.createDataFrame([(v,) for v in marks], "fp bigint")
    found = {(r["node"], r["root"]) for r in components(simhash.links(df, 2, lane=lane)).collect()}
    label = {v: v for v in marks}
    for _ in marks:
        for a in marks:
            label[a] = min(label[b] for b in marks if bin(a ^ b).count("1") <= 2)
    assert {v: dict(found).get(v, v) for v in marks} == label


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (100, 102), (7, 7), (101, 100)]
    found = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_defined_cases(frame):
    words = " ".join(f"w{zlib.crc32(str(k).encode())}" for k in range(400))
    rows = [(5, words, "en"), (3, words.upper(), "en"), (9, words + " tail", "en"), (1, None, None), (2, "", "x"), (4, " \n\t", "x"), (7, "one", "x"), (8, "one", "x"), (8, "one", "x"), (None, "alone here now", "x")]
    docs = frame(rows)
    assert got(simhash.near_duplicates(docs)) == classes([(i, t) for i, t, _ in rows])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "7", "None"]
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0 == simhash.keep_one(docs.where(F.lit(False))).count()


def test_long_texts_and_short_sequences():
    long = "Word " * 50_000 + "end"
    assert int(simhash.fingerprints([long.encode()])[0]) == fingerprint(long)
    assert int(simhash.fingerprints([b"a b"])[0]) == fingerprint("a b") == xxhash.xxh64_intdigest("a b", 42)
