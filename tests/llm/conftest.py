import pytest

from .rows import SMALL, awkward_rows


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, "en", None if i == 2 else "src", None if t is None else len(t)) for i, t in awkward_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")
