"""Byte-level BPE: equal to the reference library on any text, exact round trip."""

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute_force import LIBRARY, WHERE
from tillwise.llm import bpe, queries

TOKENIZER = bpe.tokenizer(WHERE, public_tokenizers.PATTERN)


def same(texts):
    flat, sizes = TOKENIZER.encode(texts)
    ends = np.cumsum(sizes)
    for text, end, size in zip(texts, ends, sizes, strict=True):
        ids = flat[end - size : end]
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        assert TOKENIZER.decode(ids) == text.encode()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_equals_the_library(texts):
    same(texts)


def test_odd_texts():
    same(["", " ", "\n\n  x", "<|endoftext|>", "a" * 5000, "ab" * 700, "\x1c\x1d a\x85b c", "日本語テスト" * 90, "I'll WE'VE 123,456", "é" * 300])


def test_long_pieces_merge_as_short_ones_do():
    for piece in ("thethethe" * 14, "aab" * 40, "ünïcödé" * 12):
        data = piece.encode()
        assert TOKENIZER._merge_long(data).tolist() == TOKENIZER._merge_matrix([data[:128]] if len(data) <= 128 else [data])[0].tolist()


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    same([" ".join(f"w{k}x" for k in range(50)), "once more"])
    same(["again " * 30])


def test_query_against_the_library(spark, data):
    docs = {r["doc_id"]: r["text"] or "" for r in data("documents").collect()}
    found = queries.op3_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(docs)
    for r in found:
        ids = LIBRARY.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_defined_cases(frame):
    docs = frame([(1, None, "en"), (2, "", "en"), (3, "one text", None), (3, "one text", None), (None, "x y" * 20_000, None)]).withColumn("ids", F.lit("clash"))
    encoded = bpe.encode(docs, WHERE, public_tokenizers.PATTERN)
    assert encoded.columns[-1] == "ids" and encoded.columns.count("ids") == 1
    decoded = bpe.decode(encoded, WHERE, public_tokenizers.PATTERN)
    assert all((r["text"] or "").encode() == bytes(r["decoded"]) for r in decoded.collect())
    assert bpe.digests(encoded, ["doc_id"], WHERE, public_tokenizers.PATTERN).where("doc_id = 3").distinct().count() == 1
    assert bpe.encode(docs.where(F.lit(False)), WHERE, public_tokenizers.PATTERN).count() == 0
