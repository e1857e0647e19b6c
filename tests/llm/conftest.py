import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def build(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return build


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables as Parquet and returns the folder, as queries take it."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
