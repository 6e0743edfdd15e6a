import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, **extra):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        out = spark.createDataFrame(full, DOCS)
        for name, value in extra.items():
            out = out.withColumn(name, value)
        return out
    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
