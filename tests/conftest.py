import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from saltmarsh.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", 8,
        {
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.log.level": "ERROR",
            "spark.sql.streaming.noDataMicroBatches.enabled": "true",
        },
    )
    yield session
    session.stop()


def rows(df, *columns):
    """Sorted tuples of a frame, for order-free comparison."""
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=lambda t: tuple((x is None, str(x)) for x in t))
