import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from planlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", **{
        "spark__master": "local[8]",
        "spark__sql__shuffle__partitions": "8",
        "spark__driver__memory": "8g",
        "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false",
        "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample(spark):
    """A small set of extracts, one row per branch of every rule."""
    from fixtures import sample_pipeline

    return sample_pipeline(spark)
