import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kindred import build_session

    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


RATINGS = "user_id bigint, item_id bigint, rating double"

TRAIN = [
    (1, 10, 5.0), (1, 11, 3.0), (1, 12, 1.0),
    (2, 10, 4.0), (2, 11, 2.0), (2, 13, 5.0),
    (3, 10, 1.0), (3, 12, 5.0), (3, 13, 3.0),
    (4, 11, 4.0), (4, 12, 4.0),
]
TEST = [(1, 13, 4.0), (2, 12, 2.0), (3, 11, 4.0), (4, 10, 3.0), (1, 14, 3.0)]


@pytest.fixture(scope="session")
def tiny(spark):
    """A zero-norm user (4), a cold item (14), a test row without a usable neighbour."""
    return spark.createDataFrame(TRAIN, RATINGS), spark.createDataFrame(TEST, RATINGS)
