from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        "tiermill-tests",
        **{
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(warehouse),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def values(spark):
    """Values of one column after an operator was applied to a one-column frame."""

    def run(items, step, kind="string", shown="x"):
        df = spark.createDataFrame([(i, item) for i, item in enumerate(items)], f"i int, x {kind}")
        rows = step(df).orderBy("i").collect()
        return [row[shown] for row in rows]

    return run
