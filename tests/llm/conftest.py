import pytest

from llm_rows import CLASH, EDGES
from strata.llm.common import ship

@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source) with extra columns of clashing names."""

    def build(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in CLASH)
        full = [(i, t, lang, s, None if t is None else len(t), *["x"] * len(CLASH)) for i, t, lang, s in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture()
def edges(make):
    return make(EDGES)


@pytest.fixture()
def nothing(make):
    return make([])
