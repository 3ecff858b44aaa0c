import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lanewise.session import BROADCAST_ROWS, ROWS_PER_SPLIT, local_session, run_folder  # noqa: E402

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = local_session("lanewise-tests", os.environ.get("TEST_CPUS", "8"))
    session.conf.set("spark.sql.shuffle.partitions", "3")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new folder name, under this application's own scratch folder."""
    return f"{run_folder(spark)}/test-{uuid.uuid4().hex[:12]}"


@pytest.fixture
def no_broadcast(spark):
    """Make every table too large to broadcast and every key of two rows hot."""
    settings = {
        BROADCAST_ROWS: "-1",
        ROWS_PER_SPLIT: "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
