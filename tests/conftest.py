import pytest

from tidemark.session import local_session
from tidemark.sources.store import TableStore


@pytest.fixture(scope="session")
def spark():
    session = local_session("tidemark-tests", 4, **{"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.enabled": "false"})
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))
