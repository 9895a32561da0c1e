import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wattline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cpus=8, memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    yield session
    session.stop()
