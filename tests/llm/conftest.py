import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, row bigint, score string, word string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with extra columns whose names the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, "s", len(t or ""), 7, "old", "x") for i, t, lang in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def data(spark):
    return lambda name, size="0.001": spark.read.parquet(f"/root/testdata/sf{size}/{name}.parquet")
