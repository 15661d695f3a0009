import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from codeloom.session import build_session, release  # noqa: E402

TESTDATA = os.environ.get("CODELOOM_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)


@pytest.fixture(scope="session")
def sf():
    return TESTDATA


def rows(df, *order):
    """Rows as tuples, sorted for comparison."""
    shown = df.select(*order) if order else df
    return sorted((tuple(r) for r in shown.collect()), key=repr)
