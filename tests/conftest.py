from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tidemill-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left(spark):
    """Drop the session's temporary views behind each module; a listing of any database would show them."""
    yield
    for view in spark.sql("SHOW VIEWS").collect():
        if view.isTemporary:
            spark.catalog.dropTempView(view.viewName)
