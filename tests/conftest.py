import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tandemtext.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Any cluster setting wins; tests bring their own folder.
    session = local_session(4, 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A one-column frame of texts with running ids."""
    return lambda values: spark.createDataFrame(list(enumerate(values)), "doc_id BIGINT, text STRING")
