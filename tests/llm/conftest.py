import pandas as pd
import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def stored_table(spark, tmp_path):
    """Write rows as a Parquet table and read it again, as the operators expect."""
    made = []

    def write(rows, schema):
        path = str(tmp_path / f"table{len(made)}")
        made.append(path)
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture
def docs(stored_table):
    """Documents from (doc_id, text) pairs."""

    def write(pairs):
        rows = [(d, t, "en", "src", None if t is None else len(t)) for d, t in pairs]
        return stored_table(rows, DOC_SCHEMA)

    return write


@pytest.fixture(scope="session")
def sample():
    """Real documents: (doc_id, text, lang)."""
    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    return list(table[["doc_id", "text", "lang"]].itertuples(index=False, name=None))
