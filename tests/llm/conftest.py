import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from texts, or from (doc_id, text) pairs; extra columns clash."""

    def make(rows, **extra):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, None, "s", None if t is None else len(t), *extra.values()) for i, t in rows]
        kinds = "".join(f", {name} string" for name in extra)
        return spark.createDataFrame(full, DOCS + kinds)

    return make


@pytest.fixture(scope="session")
def table(spark):
    def read(name, folder="/root/testdata/sf0.001"):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return read


@pytest.fixture(scope="session")
def model():
    from arrears.llm.catalog import piece_model

    return piece_model()


def by_id(df):
    return {r.doc_id: r for r in df.collect()}
