import pytest

#: Columns with names that operators use inside.
CLASH = "band string, rep int, n int, salt int, component string, shard int, chunk string, key string, vec string, count string"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Documents of (doc_id, text) rows with more columns whose names may clash."""
        data = [(i, t, "en", "s", 0, "x", 1, 2, 3, "y", 4, "z", "k", "v", "c") for i, t in rows]
        return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")

    return make
