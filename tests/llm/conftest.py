import pytest

from tallygrid.llm.common import ship


@pytest.fixture(scope="session")
def cluster(spark):
    """The session, with the package importable in its Python workers."""
    ship(spark)
    return spark


DOCS = "doc_id long, text string, digest string, id long, node string, score string, ids string"


@pytest.fixture
def documents(cluster):
    """Documents with extra columns whose names clash with internal ones."""
    def make(rows):
        return cluster.createDataFrame([(i, t, "x", 7, None, "y", "z") for i, t in rows], DOCS)
    return make
