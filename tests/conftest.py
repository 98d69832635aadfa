import pytest

from claimwright.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[4]", shuffle_partitions=4, **{"spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
