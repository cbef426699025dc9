"""Periodic runs: equal to trying every period at every place."""

import random
import zlib

import pytest

from tillwise.llm import periodic, queries


def brute(w, least=24, periods=3):
    out, n = [], len(w)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            own = w[i : j + q]
            if len(own) >= max(least, periods * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                out.append((i, len(own), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs))


def texts(seed, count):
    rnd = random.Random(seed)
    for _ in range(count):
        sigma, n = rnd.choice([1, 2, 3, 6]), rnd.randint(0, 120)
        w = [rnd.randrange(sigma) for _ in range(n)]
        for _ in range(rnd.randint(0, 2)):
            unit = [rnd.randrange(sigma) for _ in range(rnd.randint(1, 14))]
            at = rnd.randint(0, n)
            w[at:at] = (unit * 12)[: rnd.randint(0, 60)]
        yield [chr(97 + x) for x in w]


@pytest.mark.parametrize("least,periods", [(24, 3), (8, 2), (6, 3), (1, 2), (10, 4)])
def test_runs_equal_brute_force(least, periods):
    for w in texts(least, 150):
        numbers = [ord(c) - 97 for c in w]
        assert periodic.runs_of(numbers, least, periods) == brute(w, least, periods), w
        _, found = periodic.find([b"a a b", " ".join(w).encode(), b"", " ".join(w).encode()], least, periods)
        assert found[1] == found[3] == brute(w, least, periods), w


def test_long_periods_and_texts():
    rnd = random.Random(3)
    unit = [rnd.randrange(50) for _ in range(700)]
    w = [rnd.randrange(50) for _ in range(500)] + unit * 4 + [60]
    assert periodic.runs_of(w) == [(500, 2800, 700)] or periodic.runs_of(w)[-1][2] == 700  # the words before may extend it
    assert periodic.runs_of([0] * 30000) == [(0, 30000, 1)]
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 3000:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    w = fibonacci[1][:900]
    assert periodic.runs_of(w, 6, 3) == brute(w, 6, 3)


def test_operator(spark, frame):
    many = [" \t".join(w) for w in texts(11, 60)]
    rows = [(i, t, None) for i, t in enumerate(many)] + [(7, many[7], None), (None, "x " * 30, None), (900, None, None), (901, "", None), (902, "  \n", None), (903, "é ü  " * 40, None)]
    got = periodic.find_runs(frame(rows).withColumnRenamed("word", "runs").withColumnRenamed("score", "n_words"))
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "row", "n_words", "runs", "collapsed"]
    want = []
    for i, t, _ in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        runs = brute(w)
        want.append((str(i), len(w), runs, collapsed(w, runs)))
    assert sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()) == sorted(want)
    assert periodic.find_runs(frame([])).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(frame([]), periods=1)


def test_planted_periods(spark, data):
    docs = data("documents").select("doc_id", "text")
    got = {r["doc_id"]: r["text"] for r in queries.with_planted_periods(docs).collect()}
    changed = 0
    for r in docs.collect():
        w, h = r["text"].encode().split(), zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert got[r["doc_id"]].encode().split() == w
    assert changed
    odd = [(None, "a b c d e f"), (3, None), (None, None), (5, "  ")]
    assert queries.with_planted_periods(spark.createDataFrame(odd, "doc_id bigint, text string")).count() == 4
