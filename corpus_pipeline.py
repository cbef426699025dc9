"""The corpus pipeline: five operators in a row, each on the documents that its predecessor kept.

Language ID drops documents without a recognisable language, SimHash keeps one of each group
of near copies, decontamination drops documents that leak a benchmark item, the secret scan
masks secrets in the texts, and byte-level BPE encodes what is left and decodes it again.

Every stage is written as Parquet into the shared folder of ``spark.checkpoint.dir`` and read
again, so a lost executor costs work of one stage only.

Defined cases, the same in every stage: an empty table gives an empty table; rows that repeat are rows of their own, except
where the second stage keeps one of equal copies; nulls in columns other than the text stay null; extra columns
stay as they are up to the last stage, which returns its own; texts of any length are read whole.  What a stage does
with null and empty texts, ties and repeated rows is said at the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import bpe, decontaminate, langid, secret_scan, simhash
from tillwise.llm.common import read_table, stored
from tillwise.llm.queries import RANKS

#: Least posterior of the predicted language; texts mixed so evenly that it is lower are rejected.
LEAST_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier recognises; it learns from all that carry a label.

    A null or empty text, or one without a letter, has no language and goes.  Repeated rows share their fate.  Of
    languages that are equally likely the first by name counts; a text whose likeliest language has less than ``LEAST_SCORE``
    goes.  Without any labelled document nothing can be recognised and nothing stays.
    """
    model = langid.fit(docs)
    name, score = "_predicted_lang", "_predicted_score"
    told = langid.predict(docs, model, "text", name, score)
    return told.where((F.col(name) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints reach each other by steps of at most two bits.

    The row of smallest doc_id stays, of repeated rows one; a null id comes last.  Null and empty texts have the fingerprint
    zero and are one group.  Two bits of 64 are strict: an edited copy whose fingerprint moves further is not a copy
    here, so exact copies go without exception and near copies only as far as that reaches.
    """
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, literally or with other numbers, names and units.

    Null and empty texts leak nothing and stay; repeated rows share their fate; an empty benchmark drops nothing.
    """
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them replaced by a mark; n_chars follows changed texts.

    Null and empty texts stay as they are; a secret that occurs again is masked again.
    """
    return secret_scan.mask_secrets(docs, secret_scan.default_scanner(docs))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the bytes they decode to.

    A null text counts as empty: no tokens, and the digests of nothing.  Repeated rows are encoded each.
    """
    where = public_tokenizers.path(RANKS)
    encoded = bpe.encode(docs, where, public_tokenizers.PATTERN, keep=["doc_id"])
    return bpe.digests(encoded, ["doc_id"], where, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode_and_decode),
]

#: Fitted models and token merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
