import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """documents from (doc_id, text[, source]) rows, over a few partitions, with columns whose names clash."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 1, "x") for r in rows]
        schema = DOCS + ", size long, `fp` string"
        return spark.createDataFrame(full, schema).repartition(parts)
    return make
