from __future__ import annotations

import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("millrace-tests", cores="8", memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
