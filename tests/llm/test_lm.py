"""Language-model scoring: exact unigrams, gradients, gain over unigrams, defined cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import lm, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def unigram_rows(docs, training):
    counts = Counter()
    for t in training:
        counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), None])) for i, t in docs}


def same(found, want):
    for r in found:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)


def test_query_against_plain_counts(spark, data):
    docs = [(r["doc_id"], r["text"]) for r in data("documents").collect()]
    found = queries.op9_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    assert len(found) == len(docs) and all(r["held_out"] == held[r["doc_id"]] for r in found)
    same(found, unigram_rows(docs, [t for i, t in docs if not held[i]]))


def test_model_beats_unigrams_on_held_out_texts(spark):
    found = queries.op9_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_rare_words_come_by_the_join(spark, frame):
    rows = [(1, "a a b c d e", "en"), (2, "b b c zz zz", "en"), (3, "A new word\tq q", "en"), (4, None, None), (5, "", None), (5, "", None), (None, "long " * 30_000, None)]
    docs = frame(rows)
    out, known, model = lm.score_documents(docs, F.coalesce(F.col("doc_id") <= 2, F.lit(False)), rounds=1, stride=1, frequent=4, vocabulary=3)
    assert known.model_words == 1 and set(known.frequent) == {b"a", b"b", b"c", b"zz"}
    found = out.collect()
    assert len(found) == 7
    same(found, unigram_rows([(i, t) for i, t, _ in rows], [t for i, t, _ in rows[:2]]))
    # the model's score is the probability of the exact text
    one = next(r for r in found if r["doc_id"] == 2)
    other_n, other_v = known.other
    counts = Counter("a a b c d e b b c zz zz".split())
    places = known.frequent.of([w.encode() for w in "b b c zz zz".split()])
    spelt = sum(math.log10((counts[w] + 1) / (other_n + other_v + 1)) for w, p in zip("b b c zz zz".split(), places, strict=True) if not 0 <= p < 1)
    assert one["score"] == pytest.approx(lm.score_sequences(model, [np.append(np.where((places >= 0) & (places < 1), places + 2, 1), 0)])[0] + spelt, rel=1e-5)


def test_probabilities_sum_to_one():
    model = lm.Gru.start(np.arange(10.0), units=4, per_class=3)
    state = np.random.default_rng(0).normal(size=(1, 4)).astype(np.float32)
    total = sum(math.exp(model.log_prob(state, np.array([k]))[0][0]) for k in range(2 + len(model.ob)))
    assert total == pytest.approx(1, abs=1e-5)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    model = lm.Gru.start(rng.integers(1, 50, 20).astype(float), units=5, per_class=6)
    inputs, targets = rng.integers(0, 20, (4, 3)), rng.integers(0, 20, (4, 3))
    targets[3, 1] = -1
    keep = np.ones((4, 3), np.float32)
    keep[2, 0] = 0
    h = rng.normal(size=(5, 3)).astype(np.float32)
    grads, spare = lm.Gru(20, 5, 6), lm.Gru(20, 5, 6)
    _, _, n = model.gradients(inputs, keep, targets, h, grads)
    assert n == 11
    for k in rng.choice(len(model.vector), 60, replace=False):
        old, step = model.vector[k], 1e-2
        model.vector[k] = old + step
        up = model.gradients(inputs, keep, targets, h, spare)[1]
        model.vector[k] = old - step
        down = model.gradients(inputs, keep, targets, h, spare)[1]
        model.vector[k] = old
        assert (up - down) / (2 * step) == pytest.approx(grads.vector[k], rel=0.03, abs=0.01)


def plain_log10(model, symbols):
    """The probability of one sequence, symbol by symbol in double precision, from the weights alone."""
    units, per_class = model.units, model.per_class
    x, u, c, cb, o, ob = (getattr(model, k).astype(np.float64) for k in ("x", "u", "c", "cb", "o", "ob"))
    h, before, total = np.zeros(units), 0, 0.0
    for symbol in symbols:
        a, g = x[before], h @ u
        z, r = (1 / (1 + np.exp(-(a[k : k + units] + g[k : k + units]))) for k in (0, units))
        n = np.tanh(a[2 * units :] + r * g[2 * units :])
        h = z * h + (1 - z) * n
        own = symbol if symbol < 2 else 2 + (symbol - 2) // per_class
        logits = h @ c + cb
        total += logits[own] - np.log(np.exp(logits).sum())
        if symbol >= 2:
            first = (own - 2) * per_class
            logits = o[first : first + per_class] @ h + ob[first : first + per_class]
            total += logits[symbol - 2 - first] - np.log(np.exp(logits).sum())
        before = symbol
    return total / math.log(10)


def test_scores_equal_a_plain_model(spark, data):
    docs = data("documents").select("doc_id", "text")
    out, known, model = lm.score_documents(docs, F.lit(True))
    counts = Counter()
    texts = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    for t in texts.values():
        counts.update(t)
    top = [w for w, _ in sorted(counts.items(), key=lambda r: (-r[1], r[0].encode())) if len(w.encode()) <= lm.WORD_BYTES][: lm.VOCABULARY - 2]
    number = {w: k + 2 for k, w in enumerate(top)}
    others = {w: n for w, n in counts.items() if w not in number}
    total = math.log10(sum(others.values()) + len(others) + 1)
    found = {r["doc_id"]: r["score"] for r in out.collect()}
    assert set(found) == set(texts)
    for i in list(texts)[::5]:
        spelt = sum(math.log10(others.get(w, 0) + 1) - total for w in texts[i] if w not in number)
        assert found[i] == pytest.approx(plain_log10(model, [*(number.get(w, 1) for w in texts[i]), 0]) + spelt, rel=1e-4)


def test_a_long_text_beside_short_ones_takes_little_memory():
    import tracemalloc

    model = lm.Gru.start(np.ones(40), units=4, per_class=8)
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 40, 60_000).astype(np.int16), *(rng.integers(0, 40, 20).astype(np.int16) for _ in range(600))]
    tracemalloc.start()
    lm.score_sequences(model, sequences)
    trainer = lm.Trainer(model)
    trainer.learn(sequences)
    assert trainer.tokens == 72_000 and tracemalloc.get_traced_memory()[1] < 40e6
    tracemalloc.stop()


def test_clashing_columns_are_replaced(spark, frame):
    docs = frame([(1, "a b", "en")]).withColumnRenamed("row", "n_tokens")
    out, _, _ = lm.score_documents(docs, F.lit(True))
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "word", *lm.RESULTS] and out.first()["n_tokens"] == 3


def test_state_runs_on_across_windows(monkeypatch):
    model = lm.Gru.start(np.ones(30), units=6, per_class=5)
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 30, n) for n in (200, 5, 1, 77, 64)]
    whole = lm.score_sequences(model, sequences, 2)
    monkeypatch.setattr(lm, "WINDOW", 7)
    assert np.allclose(whole, lm.score_sequences(model, sequences, 3), rtol=1e-5)


def test_training_learns_a_pattern():
    sequences = [np.array(([2, 3, 4, 5] * 20) + [0]) for _ in range(64)]
    counts = np.bincount(np.concatenate(sequences), minlength=8).astype(float)
    model = lm.Gru.start(counts, units=8, per_class=4)
    before = lm.score_sequences(model, sequences[:4]).sum()
    trainer = lm.Trainer(model)
    for _ in range(8):
        trainer.learn(sequences)
    assert lm.score_sequences(model, sequences[:4]).sum() > before / 2


def test_empty_training_and_tables(spark, frame):
    docs = frame([(1, "a b", "en"), (2, None, None)])
    found = lm.score_documents(docs, F.lit(False))[0].collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in found] == [(0, 0, 0.0)] * 2
    assert lm.score_documents(docs.where(F.lit(False)), F.lit(True))[0].count() == 0


def test_rounds_cover_every_training_document(spark, data):
    docs = data("documents").select("doc_id", "text").union(spark.createDataFrame([(None, "x")], "doc_id bigint, text string"))
    known = lm.unigrams(lm.count_words(docs), docs.count())
    learnt = F.coalesce(F.col("doc_id") % 3 > 0, F.lit(True))
    coded = lm.symbolized(docs, known, keep=["doc_id"], training=learnt)
    seen = Counter(r["kept0"] for turn in range(lm.ROUNDS) for r in lm.turn_of(coded, turn).collect())
    assert seen == Counter(r["doc_id"] for r in docs.where(learnt).collect()) and coded.count() == docs.count()
