from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetmeter.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "fleetmeter-tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Whole plans in text, for the plan tests.
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shared(tmp_path_factory) -> str:
    """Stands in for the cluster's shared folder."""
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


def rows(df, *order: str) -> list[tuple]:
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
