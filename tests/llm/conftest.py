import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string"


@pytest.fixture
def docs(spark):
    """Makes a documents table: texts or (doc_id, text) pairs, with an extra column whose name clashes."""

    def make(texts):
        rows = [x if isinstance(x, tuple) else (k, x) for k, x in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 2}", None if t is None else len(t), "x") for i, t in rows], SCHEMA)

    return make
