import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]) rows, several partitions."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def sf(tmp_path_factory):
    """A folder of tables for a query: writes the given frames, returns the folder."""
    def write(**tables):
        d = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(str(d / f"{name}.parquet"))
        return str(d)
    return write
