import datetime as dt

import pytest

from meterlake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        4,
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def day():
    """Days of August 2025 by number."""
    return lambda n: dt.date(2025, 8, n)
