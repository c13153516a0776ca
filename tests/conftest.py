import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from textloom.session import get_session, ship

    s = get_session("tests", cpus="4")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    ship(s)
    yield s
    s.stop()
