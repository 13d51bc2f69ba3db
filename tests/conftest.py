import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from dialoom.session import get_spark
    from dialoom.streaming.segments import STATE_STORE

    session = get_spark("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g",
                        **{"spark__sql__streaming__stateStore__providerClass": STATE_STORE, "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return TESTDATA
