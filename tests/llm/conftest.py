import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) -> a documents table with a clashing extra column."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, uid string"

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in rows], schema
        )

    return make


@pytest.fixture(scope="session")
def rows_of():
    """A frame's rows as sorted tuples."""

    def get(df):
        return sorted(map(tuple, df.collect()), key=repr)

    return get
