import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from storelake.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "storelake-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_ts():
    return datetime(2024, 7, 1, 12, 30, tzinfo=timezone.utc)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def set_options(**options):
        for key, value in {k.replace("__", "."): v for k, v in options.items()}.items():
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_options
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
