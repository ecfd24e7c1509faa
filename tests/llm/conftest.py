import pytest


@pytest.fixture
def docs(spark):
    """Makes a documents table with clashing further columns."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n string, rep string, p string, ids string, key string"
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "x", "x", "x", "x", "x") for i, t in rows], schema)

    return make
