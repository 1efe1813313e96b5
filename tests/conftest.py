import pytest

from spanforge.session import session


@pytest.fixture(scope="session")
def spark():
    made = session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
