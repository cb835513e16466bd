import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tapeworks.session import local_session

    folder = str(tmp_path_factory.mktemp("spark"))
    session = local_session(
        os.environ.get("TEST_CPUS", "8"), "tests",
        **{"spark.checkpoint.dir": f"{folder}/shared", "spark.sql.warehouse.dir": f"{folder}/warehouse"},
    )
    yield session
    session.stop()
