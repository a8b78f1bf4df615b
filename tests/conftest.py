from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vidlake.schemas import CANONICAL  # noqa: E402
from vidlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "8",
        "vidlake-tests",
        **{
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            # Plans are read as text.
            "spark.sql.maxMetadataStringLength": "2000",
            # Test tables are tiny, yet have thousands of day partitions.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


VIDEO = {
    "video_id": "v1",
    "extraction_date": "2024-02-01",
    "title": "t",
    "channel_title": "c",
    "channel_id": "ch",
    "published_date": "2024-01-05T00:00:00Z",
    "views": "100",
    "likes": "10",
    "comments": "5",
    "description": "d",
}


@pytest.fixture(scope="session")
def videos(spark):
    """Text rows in canonical shape, from what differs from VIDEO."""

    def make(*changes: dict, repeat: int = 1):
        rows = [tuple({**VIDEO, **change}[c] for c in CANONICAL) for change in changes] * repeat
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CANONICAL))

    return make


@pytest.fixture(scope="session")
def plan():
    """The plan that ran, as text."""

    def text(df) -> str:
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    return text
