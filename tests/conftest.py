import os

os.environ.setdefault("TZ", "UTC")

import pytest

from tallyspark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
