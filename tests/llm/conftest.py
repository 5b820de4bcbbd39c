import sys
import pathlib

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

DOCS = "doc_id bigint, text string, spans string, n_words int, row string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with columns that are named like the operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, "s", 1, "r") for i, t in rows], DOCS)

    return make
