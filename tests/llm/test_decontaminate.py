"""Decontamination: planted copies and re-parameterised questions, clean documents, brute-force windows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import decontaminate as dec
from tillwise.llm import queries

QUESTION = "Yesterday Alice bought 12 apples and 5 kg of sugar, then Alice sold 12 apples to Bob for profit at market."
CHANGED = "Yesterday Carol bought 30 apples and 7 lb of sugar, then Carol sold 30 apples to Dave for profit at market."
ITEMS = [
    (1, QUESTION),
    (2, "What is the capital of the old northern kingdom near the great river"),
    (3, "yes sir"),
    (4, ""),
    (5, None),
    (None, "a lonely fisherman counted many silver boats along the quiet harbor wall today"),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, kind string")


def found(frame, benchmark, texts):
    docs = frame([(k, t, "en") for k, t in enumerate(texts)])
    return sorted(((r["doc_id"], r["item_id"] or 0, r["kind"]) for r in dec.find_leaks(docs, benchmark).collect()))


def test_planted_cases(frame, benchmark):
    texts = [
        f"Intro here. {QUESTION} And more.",
        f"Some text. {QUESTION.upper()}!!",
        f"Before: {CHANGED} after",
        f"Before: {CHANGED.replace('sold 30', 'sold 31')} after",  # one value became two
        f"Before: {CHANGED.replace('Carol sold', 'Erin sold')} after",  # so did one name
        "Yes, Sir!",
        "oh yes sir indeed",
        "the capital of the old northern kingdom",
        "WHAT, IS the capital of the old northern kingdom near the great river?",
        ("filler words " * 5000) + "a lonely fisherman counted many silver boats along the quiet harbor wall today",
        None,
        "",
        "plain clean text about nothing that any benchmark asks for at all",
    ]
    assert found(frame, benchmark, texts) == [(0, 1, "exact"), (1, 1, "exact"), (2, 1, "reparameterised"), (5, 3, "exact"), (8, 2, "exact"), (9, 0, "exact")]


def test_clean_keeps_columns_and_repeated_rows(frame, benchmark):
    docs = frame([(1, QUESTION, "en"), (2, "clean enough words", None), (2, "clean enough words", None), (2, CHANGED, None), (None, None, None)])
    kept = dec.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, ""), (2, "clean enough words"), (2, "clean enough words")]


def test_empty_tables_and_parts(frame, benchmark, monkeypatch):
    docs = frame([(1, f"x {QUESTION}", "en")])
    assert dec.find_leaks(docs, benchmark.where(F.lit(False))).count() == 0
    assert dec.find_leaks(docs.where(F.lit(False)), benchmark).count() == 0
    rows = docs.withColumn("n", F.lit(0).cast("bigint"))
    assert [r["kind"] for r in dec.leaks(rows, benchmark, "n", broadcast=3).collect()] == ["exact"]  # several passes


def test_query_against_word_windows(spark, data):
    """On prose without numbers an exact leak is a run of an item's words."""
    split = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    items = {r["item_id"]: split(r["text"]) for r in data("benchmark", "0.01").collect()}
    want = set()
    for r in data("documents", "0.01").collect():
        text = f" {' '.join(split(r['text']))} "
        for i, words in items.items():
            need = min(dec.RUN, len(words))
            if any(f" {' '.join(words[k : k + need])} " in text for k in range(len(words) - need + 1)):
                want.add((r["doc_id"], i))
    got = {(r["doc_id"], r["item_id"]) for r in queries.op2_benchmark_decontamination(spark, "/root/testdata/sf0.01").collect()}
    assert want and want <= got and len(got - want) <= 2


def test_tokens_of_both_views():
    tokens = dec.Tokens(["Anna met 1,000.5 people in Rome. Two km on.", "", "km 3 km"])
    assert [tokens.said(k, 1)[0] for k in range(len(tokens.kind))] == ["anna", "met", "1,000.5", "people", "in", "rome", "two", "km", "on", "km", "3", "km"]
    assert tokens.kind.tolist() == [0, 0, 1, 0, 0, 3, 1, 2, 0, 0, 1, 2]
    assert tokens.counts.tolist() == [9, 0, 3]


OPENING = [
    (1, "Alice has 3 apples and buys 4 more today"),
    (2, "Carol slowly walked 5 miles home again. Carol then cooked 7 fine meals there."),
    (3, "The old farmer keeps 12 brown goats behind the barn"),
    (4, "Will packs 9 green boxes"),
]


def test_names_that_open_sentences(spark, frame):
    benchmark = spark.createDataFrame(OPENING, "item_id bigint, text string")
    texts = [
        "Bob has 5 apples and buys 7 more today",
        "Question: Bob has 5 apples and buys 7 more today",
        "Q - Erin slowly walked 8 miles home again. Erin then cooked 2 fine meals there.",
        "Erin slowly walked 8 miles home again. Gina then cooked 2 fine meals there.",  # one name became two
        "Question: The old farmer keeps 30 brown goats behind the barn",
        "we know that the old farmer keeps 30 brown goats behind the barn",
        "Question: Nora packs 2 green boxes",
        "Bob has some apples and buys a few more today",
        "Yes\nNo\nWell\nStop\nHere\nNow\nThen\nThere\nGo\nOn\n" * 50,
    ]
    assert found(frame, benchmark, texts) == [(k, i, "reparameterised") for k, i in ((0, 1), (1, 1), (2, 2), (4, 3), (5, 3), (6, 4))]


def test_variants_of_a_window(monkeypatch):
    text = "Ann sees Bob. Then Cora runs. Dan is at home now"
    whole = [np.concatenate(p) for p in zip(*dec.Tokens([text]).windows(4, dec.TEMPLATE), strict=True)]
    monkeypatch.setattr(dec, "_VARIANTS", 1)
    tokens = dec.Tokens([text])
    parts = [np.concatenate(p) for p in zip(*tokens.windows(4, dec.TEMPLATE), strict=True)]
    told = lambda own: sorted((int(a), int(n), int(h)) for a, h, n in zip(*own, strict=True))
    assert told(whole) == told(parts)
    said = {tokens.canonical(a, 4, dec.TEMPLATE, n): h for a, n, h in told(parts)}
    assert len(said) == len(set(said.values())) == len(parts[0])
    plain = "ann sees <name> then|<name> sees <name> then|ann sees <name> <name>"
    assert {s for s in said if "sees" in s and "runs" not in s and not s.startswith("sees")} == set(plain.split("|"))
