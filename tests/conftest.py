from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from almanack.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "4",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, ordered for comparison."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r)) if not order else found
