import pytest

from trainlake.session import get_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    session = get_session("tests", "local[*]", conf=conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
