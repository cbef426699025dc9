"""Exact top-k: equal to a full sort of integer scores."""

import duckdb
import numpy as np
import pytest

from tillwise.llm import queries, topk


def brute(vectors, queries_, k):
    out = []
    for q, x in queries_:
        scored = sorted(((-sum(int(np.floor(256 * a)) * int(np.floor(256 * b)) for a, b in zip(x, y, strict=True)), i) for i, y in vectors if i != q))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def frame(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")


@pytest.mark.parametrize("dim,group,split,lists", [(8, 4096, 4096, 4), (7, 3, 10, 4), (3, 2, 50, 16), (1, 4096, 7, 4)])
def test_equals_brute_force(spark, dim, group, split, lists):
    rng = np.random.default_rng(dim)
    vectors = [(i, [float(v) for v in rng.normal(size=dim).round(1)]) for i in range(120)]
    vectors += [(i + 120, x) for i, x in vectors[:30]]  # ties
    asked = [v for v in vectors if v[0] % 10 == 0]
    assert rows(topk.search(frame(spark, vectors), frame(spark, asked), 5, lists, group, split)) == brute(vectors, asked, 5)


def test_query_against_brute_force(spark, data):
    vectors = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in data("embeddings").collect()]
    assert rows(queries.op4_exact_top_k(spark, "/root/testdata/sf0.001")) == brute(vectors, [v for v in vectors if v[0] % 50 == 0], 5)


def test_large_components_stay_exact(spark):
    vectors = [(0, [1e6, 1.0]), (1, [1e6, 2.0]), (2, [1e6, 2.0]), (3, [-1e6, 5.0]), (4, [3e5, 7.0])]
    assert rows(topk.search(frame(spark, vectors), frame(spark, vectors[:1]), 3)) == brute(vectors, vectors[:1], 3)
    huge = [(0, [1e17, 1.0]), (1, [1e17, 1.0]), (2, [-1e17, 1.0])]
    assert [r[3] for r in rows(topk.search(frame(spark, huge), frame(spark, huge[:1]), 2))] == [2**63 - 1, -(2**63)]


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.0, 1.0]), (None, [1.0, 1.0]), (50, [1.0, 1.0, 1.0]), (6, [])]
    df = frame(spark, vectors)
    assert rows(topk.search(df, df.where("vec_id % 50 = 0"), 5)) == [(0, 1, 5, 512 * 256)]  # fewer than k; other lengths apart
    assert topk.search(df.where("false"), df.where("false"), 5).count() == 0
    assert topk.search(df, df.where("false"), 5).count() == 0
    again = frame(spark, [(0, [1.0]), (7, [1.0]), (7, [1.0]), (0, [1.0])])
    assert rows(topk.search(again, again.where("vec_id = 0"), 5)) == [(0, rank, 7, 65536) for rank in (1, 2, 3, 4)]  # both rows of the query, both candidates


def test_repeated_ids_with_other_vectors_equal_the_sql(spark, tmp_path):
    vectors = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [5.0, 0.0]), (2, [0.0, 7.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0]), (50, [-1.0, 2.0]), (3, [2.0, 2.0]), (3, [2.0, 2.0])]
    df = frame(spark, vectors)
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(queries.oracle_sql()["op4_exact_top_k"]).fetchall()
    assert sorted(map(tuple, queries.op4_exact_top_k(spark, str(tmp_path)).collect())) == sorted(want)
    two = [r for r in rows(topk.search(df.where("vec_id <= 2"), df.where("vec_id = 0"), 5))]
    assert two == [(0, 1, 2, 458752), (0, 2, 1, 327680), (0, 3, 1, 0), (0, 4, 2, 0)]


def test_each_phase_reads_the_table_once(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(400)]
    df = frame(spark, vectors)
    plan = topk.search(df, df, 3, group=20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1  # the second phase; the first ended in the written cutoffs
    assert rows(topk.search(df, df, 3, group=20)) == brute(vectors, vectors, 3)
