import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    def make(texts, schema=DOCS, parts=3):
        rows = [(i, t, "en", "s", len(t) if t else None) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns named like the operators' own intermediate and output columns."""
    names = ["component_id", "token", "cls", "region", "sig", "n_words", "score", "ids", "spans", "marks", "key", "_text"]

    def make(texts):
        rows = [(i, t, "en", *range(len(names))) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{n} int" for n in names))
    return make
