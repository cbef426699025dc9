"""Language ID: held-out accuracy, brute-force scores, defined cases."""

import math
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tillwise.llm import langid, queries

EN, FR = "the cat and the dog sat on the mat ", "le chat et le chien sont sur la table "


def test_held_out_accuracy(spark, data):
    found = queries.op8_language_id(spark, "/root/testdata/sf0.01").join(data("documents", "0.01").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == data("documents", "0.01").count()
    held = [r for r in found if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_matches_brute_force_counts(frame):
    rows = [(1, EN * 3, "en"), (2, FR * 2, "fr"), (3, "Der Hund!  und", "de"), (4, "Ünd ö", "de")]
    model = langid.fit(frame(rows))

    def grams(text):
        out, blank = "", False
        for c in text.lower():
            out += c if c.isalpha() else "" if blank else " "
            blank = not c.isalpha()
        return [out[k : k + n] for k in range(len(out)) for n in (1, 2, 3) if k + n <= len(out)]

    def bucket(gram):
        value = len(gram)
        for c in gram:
            value = (value * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            value = (value ^ (value >> shift)) * factor % 2**64
        return ((value ^ (value >> 31)) >> 20) % model.buckets

    counts = {lang: Counter(bucket(g) for _, t, own in rows if own == lang for g in grams(t)) for lang in model.languages}
    text = "Le chien und the mat"
    log = {}
    for lang, seen in counts.items():
        total = sum(seen.values()) + langid.SMOOTHING * model.buckets
        log[lang] = math.log(sum(own == lang for _, _, own in rows) / len(rows)) + sum(math.log((seen[bucket(g)] + langid.SMOOTHING) / total) for g in grams(text))
    names, _, total = model[0].judge([text])
    best = max(log, key=log.get)
    assert names.tolist() == [best]
    assert abs(1 / total[0] - 1 / sum(math.exp(v - log[best]) for v in log.values())) < 1e-4


def test_defined_cases(frame):
    model = langid.fit(frame([(1, EN, "en"), (2, FR, "fr"), (3, EN, None), (4, None, "fr"), (5, "", "en")]))
    docs = frame([(1, None, None), (2, "", "x"), (3, "12 !?\n", "x"), (4, EN, "x"), (4, EN, "x"), (None, FR * 2000, None)])
    out = langid.predict(docs, model)
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0.5) for r in out.collect()), key=str)
    assert got == sorted([(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True), (0, "fr", True)], key=str)
    assert out.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score"]


def test_empty_tables(frame):
    none = frame([(1, EN, "en")]).where(F.lit(False))
    model = langid.fit(none)
    assert langid.predict(none, model).count() == 0
    assert [r["lang_pred"] for r in langid.predict(frame([(1, EN, "en")]), model).collect()] == ["und"]


def test_blocks_of_languages_equal_one_matrix(spark, frame):
    rnd = random.Random(0)
    word = lambda k: "".join(rnd.choice("abcdefghijklmnop"[k % 7 : k % 7 + 9]) for _ in range(6))
    labelled = frame([(k, " ".join(word(k) for _ in range(30)), f"l{k % 300:03d}") for k in range(900)])
    docs = frame([(k, " ".join(word(k) for _ in range(20)), None) for k in range(60)] + [(-1, None, None), (-2, "12", None), (-3, "", None)])
    whole, split = langid.fit(labelled, buckets=512, block=1000), langid.fit(labelled, buckets=512, block=128)
    assert (len(whole), len(split)) == (1, 3) and len(whole.languages) == 300
    one, many = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, m).collect()} for m in (whole, split))
    assert set(one) == set(many) and len({n for n, _ in one.values()}) > 10
    assert all(one[k][0] == many[k][0] and abs(one[k][1] - many[k][1]) < 1e-4 for k in one)
    assert one[-1] == one[-2] == one[-3] == ("und", 0.0)
