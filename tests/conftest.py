import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from faremill.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        "tests", cpus=8, partitions=4, **{"spark.sql.warehouse.dir": str(warehouse)}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
