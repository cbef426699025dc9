"""Bounded samples and frequent words."""

from tillwise.llm.common import hash_sample, most_frequent


def test_most_frequent(spark):
    words = [(f"w{k}", n) for k, n in enumerate([1] * 50 + [2] * 10 + [7, 7, 100, 10**12])]
    df = spark.createDataFrame(words, "word string, n bigint")
    ranked = sorted(words, key=lambda r: (-r[1], r[0]))
    assert most_frequent(df, 64) == ranked
    assert most_frequent(df, 63) == ranked[:14] == most_frequent(df, 14)  # the words of one count come together
    assert most_frequent(df, 3) == ranked[:2] and most_frequent(df, 0) == []
    assert most_frequent(df.where("false"), 5) == []


def test_hash_sample(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    assert hash_sample(df, ["key"], 5000).count() == 5000
    some = {r["key"] for r in hash_sample(df, ["key"], 1000).collect()}
    assert 850 <= len(some) <= 1000
    assert some == {r["key"] for r in hash_sample(df.repartition(7), ["key"], 1000).collect()}
    same = spark.createDataFrame([(1,)] * 100, "key int")
    assert hash_sample(same, ["key"], 10).count() <= 10
