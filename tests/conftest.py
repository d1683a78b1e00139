import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgermill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("sql")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
