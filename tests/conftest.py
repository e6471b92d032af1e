import os
import tempfile

import pytest

from palletrail.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "palletrail-tests", f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="palletrail-tests-"), "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
