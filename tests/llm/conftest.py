from __future__ import annotations

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, tmp_path_factory):
    """Write small tables; returns their folder."""

    def write(**named):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, (rows, schema) in named.items():
            spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")
        return folder

    return write


@pytest.fixture
def documents(tables):
    """A folder with documents of the given (doc_id, text), and more tables if named."""

    def write(rows, **more):
        full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        return tables(documents=(full, DOCUMENTS), **more)

    return write
