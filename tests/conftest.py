import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strandweave.session import local_session  # noqa: E402
from strandweave.tables import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark):
    return Workspace(spark)


@pytest.fixture
def tight_workspace(spark):
    """Nothing fits a broadcast: every lookup takes the shuffled path."""
    return Workspace(spark, max_rows=0)
