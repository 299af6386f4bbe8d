import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from skyflux.session import get_session

    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 6g --master local[4] pyspark-shell")
    s = get_session("tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.maxMetadataStringLength": "2000"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
