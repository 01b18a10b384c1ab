import pytest
from cases import EXTRA, edge_rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "en", "s", 1, "x", "x", "x", "x", "x", "x", "x", "x") for r in edge_rows()]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {EXTRA}").repartition(5).cache()


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.limit(0)
