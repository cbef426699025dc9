"""Packing: the library's ids, cut whole, in gapless sequences of about the least number."""

import random
import struct
import zlib
from collections import defaultdict

import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillwise.llm import packing, queries

WHERE = public_tokenizers.path(queries.PACKED_VOCABULARY)


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(WHERE)
    own.encode_special_tokens = True
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


ODD = ["\x0b", "\x1c", "\x85", " ", " ", "　", " ", "\n", "a", "A", "I", "̇", "ab.", "B2,", "Σ", "ς", "İ", "é", "́", "ﬁ", "1", "½", "'s", "'LL", "!", "。", "한", "하", "<|endoftext|>", "\U0001f600", "​", "\x00"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD) | st.text(max_size=3), max_size=30).map("".join))
def test_words_have_the_ids_of_the_text(text):
    text = text.encode("utf-8", "ignore").decode()
    own = packing.word_ids(WHERE)
    whole = own.tokenizer.encode(text, add_special_tokens=False).ids
    assert own.of(text.encode()) == struct.pack(f"<{len(whole)}I", *whole)


def check(rows, documents, size, library):
    """Rows hold every document whole; sequences are gapless and no longer than ``size``; returns their number."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["start"] == r["piece"] * size and len(r["ids"]) == 4 * r["length"]
        pieces[r["doc_id"]].append((r["piece"], r["length"], bytes(r["ids"])))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for at in sequences.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end and length > 0
            end += length
        assert end <= size
    told = []
    for doc_id, own in pieces.items():
        copies = sum(p[0] == 0 for p in own)
        assert all(length == size for p, length, _ in own if (p + 1) * copies < len(own))
        ids = b"".join(b for _, _, b in sorted(own)[::copies])
        told += [(str(doc_id), ids)] * copies
    want = [(str(i), struct.pack(f"<{len(ids)}I", *ids)) for i, t in documents for ids in [[*library(t), packing.END]]]
    assert sorted(told) == sorted(want)
    return len(sequences)


def test_query_on_the_table(spark, data, library):
    docs = data("documents").select("doc_id", "text")
    rows = packing.pack(docs, WHERE).collect()
    used = check(rows, [tuple(r) for r in docs.collect()], packing.LENGTH, library)
    least = -(-sum(r["length"] for r in rows) // packing.LENGTH)
    assert used <= least + 1
    got = queries.op13_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows)
    assert len({r["sequence_id"] for r in got}) == used


@pytest.mark.parametrize("parts,open_bins,buffer,fan_in", [(1, 4, 1, 8), (23, 3, 100, 2), (7, 64, 400, 3)])
def test_levels_and_bounds(spark, library, parts, open_bins, buffer, fan_in):
    rnd = random.Random(parts)
    documents = [(i, " ".join(rnd.choice(["one", "two!", "three"]) for _ in range(rnd.choice([0, 3, 9, 20, 70])))) for i in range(300)]
    df = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(parts)
    rows = packing.pack(df, WHERE, size=32, open_bins=open_bins, buffer=buffer, fan_in=fan_in).collect()
    used = check(rows, documents, 32, library)
    least = -(-sum(r["length"] for r in rows) // 32)
    assert used <= 1.15 * least + 1


def test_best_fit_and_closing():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (4, 7)] == [(0, 0), (1, 0)]  # 6 and 3 free
    assert bins.put(3) == (1, 7)  # the best fit, full now
    assert bins.put(9) == (2, 0)  # second open bin
    assert bins.put(8) == (3, 0)  # closes the fullest: bin 2
    assert sorted(bins.rest()) == [(0, 4), (3, 8)]
    assert bins.put(10) == (4, 0) and sorted(bins.rest()) == [(0, 4), (3, 8)]  # a whole bin closes none


def test_defined_cases(spark, frame, library):
    documents = [(1, None), (2, ""), (2, "again"), (2, "again"), (None, "no id"), (3, "word " * 5000)]
    df = frame([(i, t, None) for i, t in documents]).withColumnRenamed("row", "offset").withColumnRenamed("word", "piece")
    got = packing.pack(df, WHERE)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "score", "piece", "start", "length", "ids", "sequence_id", "offset"]
    rows = got.collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["length"]) for r in rows) == [("1", 0, 1), ("2", 0, 1), ("2", 0, 2), ("2", 0, 2), ("3", 0, 4096), ("3", 1, 905), ("None", 0, 3)]
    assert packing.pack(frame([]), WHERE).count() == 0


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "HELD_WORDS", 50)
    own = packing.WordIds(WHERE)
    fresh = packing.word_ids(WHERE)
    for k in range(400):
        text = f"w{k} w{k % 7} {'x' * 100}".encode()
        assert own.of(text) == fresh.of(text) and len(own) <= 50 and len(own.older) <= 50
