import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clientele.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    built = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.sql.debug.maxToStringFields": "200",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
