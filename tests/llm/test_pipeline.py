"""The corpus pipeline: each stage against the brute force of its own input."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as entry
from tillwise.llm.common import stored

from brute_force import LIBRARY, classes

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, data):
    docs = data("documents").unionByName(spark.createDataFrame([(-1, None, None, None, None), (-2, "12 34", "en", None, 5), (-3, 'Die Katze und token = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6" hier', "de", None, 0)], data("documents").schema))
    out = [stored(docs)]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF)))
    return [{r["doc_id"]: r for r in df.collect()} | {"columns": df.columns, "n": df.count()} for df in out]


def test_stages_keep_columns(steps):
    assert [s["columns"] for s in steps[:5]] == [COLUMNS] * 5
    assert [s["n"] for s in steps] == sorted([s["n"] for s in steps], reverse=True)


def ids(step):
    return {k for k in step if not isinstance(k, str)}


def test_language_stage_drops_only_what_has_no_language(steps):
    assert ids(steps[0]) - ids(steps[1]) == {i for i in ids(steps[0]) if not re.search(r"[^\W\d_]", steps[0][i]["text"] or "")}


def test_simhash_stage_keeps_one_of_each_class(steps):
    docs = [(i, steps[1][i]["text"]) for i in sorted(ids(steps[1]))]
    assert ids(steps[2]) == {c for *_, c in classes(docs)}


def test_leaks_go_and_clean_documents_stay(steps, data):
    gone = ids(steps[2]) - ids(steps[3])
    items = [" ".join(re.findall(r"[^\W\d_]+", r["text"].lower())) for r in data("benchmark").collect()]
    for i in ids(steps[2]):
        text = " ".join(re.findall(r"[^\W\d_]+", (steps[2][i]["text"] or "").lower()))
        assert (i in gone) == any(item in text for item in items), i


def test_secrets_are_masked(steps):
    assert ids(steps[3]) == ids(steps[4])
    for i in ids(steps[4]):
        before, after = steps[3][i]["text"], steps[4][i]["text"]
        assert not re.search(r'(?i)token = "[0-9a-f]{40}"', after)
        if not re.search(r'(?i)token = "[0-9a-f]{40}"', before):
            assert before == after
        else:
            assert steps[4][i]["n_chars"] == len(after)


def test_encoding(steps):
    assert ids(steps[4]) == ids(steps[5])
    for i in ids(steps[5]):
        tokens = LIBRARY.encode_ordinary(steps[4][i]["text"] or "")
        assert steps[5][i]["n_tokens"] == len(tokens)
        assert steps[5][i]["ids_sha256"] == hashlib.sha256(np.array(tokens, dtype="<u4").tobytes()).hexdigest()


def test_run_and_empty_table(spark, data):
    assert entry.queries()["pipeline"](spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    docs = data("documents").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
    assert len(corpus_pipeline.STAGES) == 5
