import os

import pytest
from texts import awkward_texts

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, node string, key long, block string"


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [
        (i, t, lang, src, None if t is None else len(t), "x", k, "y")
        for k, (i, t, lang, src) in enumerate(awkward_texts())
    ]
    return spark.createDataFrame(rows, SHAPE).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return spark.read.parquet(f"{SF}/documents.parquet")
