import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_df(spark):
    def make(rows, extra="", more=()):
        """rows: (doc_id, text, lang, source); extra: more columns as DDL with the values ``more``."""
        full = [(i, t, lang, src, None if t is None else len(t), *more) for i, t, lang, src in rows]
        return spark.createDataFrame(full, DOC_SCHEMA + extra)
    return make
